import random
import zlib
from collections import Counter, defaultdict

import cases
import numpy as np
import pytest

from tillpanel.llm import sharding
from tillpanel.llm.sharding import SHARDS, SLOTS, SlotMap, even_map, grown, rebalanced, sharding_query


def checked(frame, rows):
    """The rows of a result, after everything its contract says."""
    found = frame.collect()
    assert frame.columns[:7] == ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    kinds = dict(frame.dtypes)
    assert (kinds["shard"], kinds["slot"], kinds["grown_shard"], kinds["size"]) == ("int", "bigint", "int", "bigint")
    bytes_of = [(d, (t or "").encode()) for d, t in rows]
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in found) == Counter(
        (d, len(t) + 16, zlib.crc32(t)) for d, t in bytes_of
    )
    slots = defaultdict(list)
    for r in found:
        assert r.law == "bytes" and 0 <= r.shard < SHARDS and r.grown_shard is None and 0 <= r.virtual_slot < SLOTS
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    return found


def loads(found):
    load = Counter({s: 0 for s in range(SHARDS)})
    for r in found:
        load[r.shard] += r.size
    return load


def corpus(seed, n):
    pick = random.Random(seed)
    return [(k, cases.prose(k, pick.choice([1, 20, 200, 900]))) for k in range(n)]


@pytest.mark.parametrize("seed", [1, 2])
def test_shards_have_nearly_equal_bytes(spark, seed):
    rows = corpus(seed, 2000)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    found = checked(sharding_query(docs), rows)
    load = loads(found)
    assert max(load.values()) - min(load.values()) <= 0.001 * sum(load.values()) / SHARDS + 64
    again = sharding_query(docs.repartition(3)).collect()
    assert sorted(found, key=str) == sorted(again, key=str)


def test_a_record_that_is_repeated_is_spread(spark):
    rows = corpus(3, 400) + [(7, "the same record")] * 3000 + [(None, None)] * 300
    found = checked(sharding_query(spark.createDataFrame(rows, "doc_id long, text string")), rows)
    of_one = Counter(r.shard for r in found if r.size == 31 and r.doc_id == 7)
    assert len(of_one) > 10 and max(loads(found).values()) < 1.1 * min(loads(found).values())


def test_odd_rows(spark):
    checked(sharding_query(cases.frame(spark)), [(r[0], r[1]) for r in cases.odd_rows()])
    assert sharding_query(cases.frame(spark, [])).collect() == []


def brute_loads(shard_of, weights, n):
    load = [0] * n
    for s, w in zip(shard_of.tolist(), weights.tolist(), strict=True):
        load[s] += w
    return load


@pytest.mark.parametrize("seed", range(4))
def test_rebalancing_moves_few_slots_and_growing_moves_to_new_shards_only(seed):
    pick = np.random.default_rng(seed)
    weights = pick.pareto(2, SLOTS).__mul__(1000).astype(np.int64) * (pick.random(SLOTS) < 0.9)
    before = even_map(SHARDS)
    assert np.ptp(np.bincount(before)) <= 1
    after = rebalanced(before, weights, SHARDS)
    load = brute_loads(after, weights, SHARDS)
    assert max(load) - min(load) <= 0.001 * sum(load) / SHARDS + 1
    assert (after != before).mean() < 0.3
    assert (rebalanced(after, weights, SHARDS) != after).sum() <= 40

    more = grown(after, weights, SHARDS + 1)
    moved = more != after
    assert set(more[moved].tolist()) == {SHARDS}
    load = brute_loads(more, weights, SHARDS + 1)
    assert max(load) < 1.05 * sum(load) / (SHARDS + 1) and min(load) > 0.9 * sum(load) / (SHARDS + 1)


def test_versions_of_a_map_stay(spark):
    slot_map = SlotMap(spark, 4, slots=64)
    weights = np.arange(64)
    assert slot_map.version == 0 and slot_map.shard_of().tolist() == even_map(4, 64).tolist()
    assert (slot_map.rebalance(weights), slot_map.grow(weights, 5)) == (1, 2)
    assert slot_map.shard_of(0).tolist() == even_map(4, 64).tolist()
    assert slot_map.shard_of(1).tolist() == rebalanced(even_map(4, 64), weights, 4).tolist()
    assert slot_map.n_shards == 5 and set(slot_map.shard_of().tolist()) == set(range(5))
    assert set(slot_map.shard_of()[slot_map.shard_of() != slot_map.shard_of(1)].tolist()) == {4}


def test_no_python_in_tasks(spark):
    plan = sharding_query(spark.createDataFrame([(1, "a")], "doc_id long, text string"))
    assert "Python" not in plan._jdf.queryExecution().executedPlan().toString()


def test_a_heavy_slot_does_not_empty_the_others():
    weights = np.ones(64, np.int64)
    weights[5] = 1000
    load = brute_loads(rebalanced(even_map(4, 64), weights, 4), weights, 4)
    assert sorted(load)[0] >= 20 and max(load) <= 1001
    assert sharding.rebalanced(even_map(4, 64), np.zeros(64, np.int64), 4).tolist() == even_map(4, 64).tolist()
