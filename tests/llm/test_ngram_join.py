import random
import re

import cases
import numpy as np
import pytest

from tillpanel.llm import ngram_join
from tillpanel.llm.graph import connected_components
from tillpanel.llm.ngram_join import bitmap, bound, enough, folded, ngram_groups, ngram_query


def brute(rows):
    """Set sizes and groups, by comparing all texts."""
    sets = []
    for _, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        size = min(3, len(words))
        sets.append({tuple(words[i : i + size]) for i in range(len(words) - size + 1)} if words else set())
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= 90 * len(a | b):
                parent[root(i)] = root(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        least[root(i)] = min(least.get(root(i), doc_id), doc_id)
    return sorted((rows[i][0], len(sets[i]), least[root(i)]) for i in range(len(rows)))


def edited(pick, words, edits):
    words = list(words)
    for _ in range(edits):
        at = pick.randrange(len(words))
        words[at] = pick.choice([words[at].upper(), f"new{pick.randrange(10**6)}"])
    return " ".join(words)


def corpus(seed, families=12, size=14):
    """Families of near copies around the threshold, chains, copies, and texts that share a passage."""
    pick = random.Random(seed)
    rows = []
    passage = cases.prose(77, 25)
    for f in range(families):
        base = cases.prose(seed * 1000 + f, pick.choice([2, 3, 9, 10, 40, 120, 200])).split()
        text = base
        for _ in range(pick.randint(1, size)):
            if pick.random() < 0.3:
                text = edited(pick, text, pick.randint(0, 2)).split()  # a chain
            rows.append(edited(pick, text, pick.choice([0, 0, 1, 1, 2, 4])))
        rows.append(passage + " " + cases.prose(seed * 1000 + 500 + f, 30))
    pick.shuffle(rows)
    return [(i * 3 + 1, text) for i, text in enumerate(rows)]


@pytest.mark.parametrize(("seed", "block", "late"), [(1, 1024, 3), (2, 2, 3), (3, 3, 10**9), (4, 1, 2)])
def test_groups_match_brute_force(spark, monkeypatch, seed, block, late):
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    monkeypatch.setattr(ngram_join, "LATE_COUNT", late)
    rows = corpus(seed)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert sorted(tuple(r) for r in ngram_query(docs).collect()) == brute(rows)


def test_tiles_alone_find_every_group(spark, monkeypatch):
    """Without any comparison with hubs, the tiles still connect what belongs together."""
    rows = corpus(6, families=8)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    first = []

    def no_hubs(pairs, sets, percent, links=ngram_join._links):
        first.append(pairs)
        return links(pairs.limit(0) if len(first) == 1 else pairs, sets, percent)

    def unseen(tiles, percent, pairs=ngram_join._tile_pairs):
        return pairs(tiles, percent)

    monkeypatch.setattr(ngram_join, "_links", no_hubs)
    monkeypatch.setattr(ngram_join, "_close_in_size", lambda a, b, percent: a < 0)
    monkeypatch.setattr(ngram_join, "_tile_pairs", unseen)
    assert sorted(tuple(r) for r in ngram_query(docs).collect()) == brute(rows)


def test_bitmaps_bound_the_overlap():
    pick = np.random.default_rng(3)
    for _ in range(200):
        a = np.unique(pick.integers(0, 2**64, pick.integers(1, 90), dtype=np.uint64))
        b = np.unique(np.concatenate((a[: pick.integers(0, len(a) + 1)], pick.integers(0, 2**64, 20, dtype=np.uint64))))
        x, y = (np.frombuffer(bitmap(s), np.uint64) for s in (a, b))
        width = min(len(x), len(y))
        assert bound(folded(x, width), folded(y, width), len(a), len(b)) >= len(np.intersect1d(a, b))


def test_threshold_is_whole_numbers():
    assert enough(9, 9, 10, 90) and not enough(8, 9, 9, 90)
    for n in range(1, 200):
        # A partner can lack at most n - ceil(0.9 n) shingles.
        assert ngram_join.prefix_length(n, 90) == n - -(-9 * n // 10) + 1


def test_odd_rows(spark):
    rows = ngram_query(cases.frame(spark)).collect()
    assert len(rows) == len(cases.odd_rows())
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in rows}
    assert found[1] == (0, 1) and found[3] == (0, 3) and found[4] == (1, 4)
    assert found[5][1] == found[6][1] == 5
    assert found[None] == (58, None)
    assert ngram_query(cases.frame(spark, [])).count() == 0


def test_other_lengths_and_thresholds(spark):
    docs = spark.createDataFrame([(1, "a b c d e f"), (2, "a b c d e g"), (3, "p q")], "doc_id long, text string")
    found = {r.doc_id: r.component_id for r in ngram_groups(docs, n_words=2, percent=60).collect()}
    assert found == {1: 1, 2: 1, 3: 3}


@pytest.mark.parametrize("seed", range(3))
def test_components(spark, seed):
    pick = random.Random(seed)
    edges = [(pick.randrange(60), pick.randrange(60)) for _ in range(45)] + [(k, k + 1) for k in range(100, 130)]
    parent = {n: n for e in edges for n in e}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in edges:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    found = connected_components(spark.createDataFrame(edges, "a long, b long")).collect()
    loose = {n for n in parent if all(n not in e or e[0] == e[1] for e in edges)}
    assert {r.node: r.component for r in found} == {n: root(n) for n in parent if n not in loose}
