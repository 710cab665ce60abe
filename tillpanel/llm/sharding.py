"""Shards by fixed virtual slots: a record's slot never changes, and a versioned map says whose it is.

1. Every record falls into one of ``SLOTS`` virtual slots by a hash of its id and text. Equal records
   (same id, same text) are one row with a count from here on, so a record that is repeated millions
   of times costs one row; every ``SPREAD`` copies of it have a slot of their own.
2. Bytes and rows are aggregated per slot. That is all the map needs to know, whatever the input.
3. The slot map is a table (version, slot, shard) in the shared folder. Version 0 deals the slots out
   evenly. Rebalancing makes a new version: a shard above the mean gives slots away, the smallest
   last, and each goes to the lightest shard; single slots then change places while that brings two
   shards closer. Only slots that move get another shard. Growing adds shards to the map, which take
   slots from the others and give none.
4. A record's place in its shard is the start of its slot there plus its rank in the slot; slots are
   ranked in parallel.

Law of ``sharding_query``: ``bytes``, that is, shards hold nearly the same number of bytes.

Defined results: a null text has no bytes. Rows without an id are records like others. An empty table
has an even map and no rows. Extra columns are ignored.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillpanel.llm.common import stored
from tillpanel.storage.shared import new_folder

SLOTS = 8192
SHARDS = 40
#: Bytes of a record besides its text.
RECORD_BYTES = 16
#: Copies of one record that share a slot.
SPREAD = 64


# ---- the slot map --------------------------------------------------------------------------------


def even_map(n_shards: int, slots: int = SLOTS) -> np.ndarray:
    """The shard of each slot in version 0."""
    return np.arange(slots) * n_shards // slots


def grown(shard_of: np.ndarray, weights: np.ndarray, n_shards: int) -> np.ndarray:
    """The map with more shards: new ones take slots from those above the mean, old ones take none."""
    return _moved(shard_of, weights, n_shards, takers=range(int(shard_of.max()) + 1, n_shards))


def rebalanced(shard_of: np.ndarray, weights: np.ndarray, n_shards: int) -> np.ndarray:
    """The map with shards of nearly equal weight."""
    moved = _moved(shard_of, weights, n_shards, takers=range(n_shards))
    return _exchanged(moved, weights, n_shards)


def _moved(shard_of, weights, n_shards, takers) -> np.ndarray:
    shard_of, mean = shard_of.copy(), weights.sum() / n_shards
    load = np.zeros(n_shards, np.int64)
    np.add.at(load, shard_of, weights)
    free = []
    for shard in np.flatnonzero(load > mean).tolist():
        own = np.flatnonzero(shard_of == shard)
        # Large slots stay as long as they fit; what is given away is small and easy to place.
        kept = 0
        for slot in own[np.argsort(-weights[own], kind="stable")].tolist():
            if kept and kept + weights[slot] > mean:
                free.append(slot)
                load[shard] -= weights[slot]
            else:
                kept += weights[slot]
    free.sort(key=lambda s: (-weights[s], s))
    lightest = [(int(load[s]), s) for s in takers]
    heapq.heapify(lightest)
    for slot in free if lightest else []:
        held, shard = heapq.heappop(lightest)
        shard_of[slot] = shard
        heapq.heappush(lightest, (held + int(weights[slot]), shard))
    return shard_of


def _exchanged(shard_of, weights, n_shards, rounds: int = 400) -> np.ndarray:
    """Between the heaviest and the lightest shard, the move or exchange of slots that closes the gap best."""
    shard_of = shard_of.copy()
    load = np.zeros(n_shards, np.int64)
    np.add.at(load, shard_of, weights)
    for _ in range(rounds):
        heavy, light = int(load.argmax()), int(load.argmin())
        gap = int(load[heavy] - load[light])
        own = np.flatnonzero((shard_of == heavy) & (weights > 0))
        other = np.flatnonzero((shard_of == light) & (weights > 0))
        # No slot in return counts as a slot of weight 0.
        back = np.concatenate(([0], weights[other]))
        order = np.argsort(back, kind="stable")
        sorted_back = back[order]
        at = np.searchsorted(sorted_back, weights[own] - gap / 2)
        best = (gap, -1, -1)
        for near in (np.maximum(at - 1, 0), np.minimum(at, len(back) - 1)):
            left = np.abs(gap - 2 * (weights[own] - sorted_back[near]))
            if len(left) and left.min() < best[0]:
                i = int(left.argmin())
                best = (int(left[i]), int(own[i]), int(order[near[i]]) - 1)
        if best[1] < 0:
            break
        _, given, taken = best
        shard_of[given] = light
        moved = int(weights[given])
        if taken >= 0:
            shard_of[other[taken]] = heavy
            moved -= int(weights[other[taken]])
        load[heavy] -= moved
        load[light] += moved
    return shard_of


class SlotMap:
    """The versions of a slot map, each a table (slot, shard) below one folder of the shared file system."""

    def __init__(self, spark: SparkSession, n_shards: int, path: str | None = None, slots: int = SLOTS):
        self.spark, self.slots = spark, slots
        self.path = path or new_folder(spark, "slot-map")
        self.version, self.n_shards = -1, n_shards
        self._store(even_map(n_shards, slots), n_shards)

    def _store(self, shard_of: np.ndarray, n_shards: int) -> None:
        rows = pa.table({"slot": pa.array(np.arange(self.slots), pa.int32()), "shard": pa.array(shard_of, pa.int32())})
        # A version is complete or absent: readers go by the version in the path.
        self.spark.createDataFrame(rows).coalesce(1).write.parquet(f"{self.path}/version={self.version + 1}")
        self.version, self.n_shards = self.version + 1, n_shards

    def read(self, version: int | None = None) -> DataFrame:
        number = self.version if version is None else version
        return self.spark.read.schema("slot int, shard int").parquet(f"{self.path}/version={number}")

    def shard_of(self, version: int | None = None) -> np.ndarray:
        rows = self.read(version).toArrow().sort_by("slot")
        return rows["shard"].to_numpy().astype(np.int64)

    def rebalance(self, weights: np.ndarray) -> int:
        """A new version with shards of nearly equal weight; returns its number."""
        self._store(rebalanced(self.shard_of(), weights, self.n_shards), self.n_shards)
        return self.version

    def grow(self, weights: np.ndarray, n_shards: int) -> int:
        """A new version with more shards; slots move to new shards only."""
        self._store(grown(self.shard_of(), weights, n_shards), n_shards)
        return self.version


# ---- records -------------------------------------------------------------------------------------


def slotted(docs: DataFrame, text_column: str = "text", slots: int = SLOTS) -> DataFrame:
    """(doc_id, size, text_crc32, mark, virtual_slot, copies): equal records of a slot are one row."""
    text = F.coalesce(F.col(text_column), F.lit(""))
    records = docs.select(
        F.col("doc_id").cast("long"),
        (F.octet_length(text) + F.lit(RECORD_BYTES)).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64(text).alias("mark"),
    ).groupBy("doc_id", "size", "text_crc32", "mark").agg(F.count("*").alias("n"))
    shares = F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(n - 1) div {SPREAD}"))).alias("share")
    return records.select("*", shares).select(
        "doc_id", "size", "text_crc32", "mark",
        F.pmod(F.xxhash64("doc_id", "mark", "share"), F.lit(slots)).cast("int").alias("virtual_slot"),
        F.least(F.lit(SPREAD), F.col("n") - F.col("share") * SPREAD).alias("copies"),
    )


def slot_loads(records: DataFrame, slots: int = SLOTS) -> tuple[np.ndarray, np.ndarray]:
    """Rows and bytes of every slot; as many numbers as there are slots."""
    found = records.groupBy("virtual_slot").agg(
        F.sum("copies").alias("n"), F.sum(F.col("copies") * F.col("size")).alias("bytes")
    ).toArrow()
    rows, size = np.zeros(slots, np.int64), np.zeros(slots, np.int64)
    rows[found["virtual_slot"].to_numpy()] = found["n"].to_numpy()
    size[found["virtual_slot"].to_numpy()] = found["bytes"].to_numpy()
    return rows, size


def placed(records: DataFrame, shard_of: np.ndarray, n_rows: np.ndarray) -> DataFrame:
    """The records with ``shard`` and ``slot``, their place in it: gapless from 0 in each shard."""
    spark = records.sparkSession
    start = np.zeros(len(shard_of), np.int64)
    for shard in range(int(shard_of.max()) + 1):
        own = np.flatnonzero(shard_of == shard)
        start[own] = np.cumsum(n_rows[own]) - n_rows[own]
    starts = spark.createDataFrame(
        pa.table({
            "virtual_slot": pa.array(np.arange(len(shard_of)), pa.int32()),
            "shard": pa.array(shard_of, pa.int32()), "start": start,
        })
    )
    # Shares of one record in the same slot tie; each counts its own copies.
    order = Window.partitionBy("virtual_slot").orderBy("doc_id", "mark", "copies").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    ranked = records.withColumn("after", F.sum("copies").over(order))
    first = F.col("start") + F.col("after") - F.col("copies")
    # One row per slot of the map: a fixed number.
    return (
        ranked.join(F.broadcast(starts), "virtual_slot")
        .select("*", F.explode(F.sequence(first, F.col("start") + F.col("after") - 1)).alias("slot"))
        .select("doc_id", "size", "text_crc32", "shard", "slot", "virtual_slot")
    )


def shards(docs: DataFrame, n_shards: int = SHARDS, text_column: str = "text") -> tuple[DataFrame, SlotMap]:
    """The placed records of ``docs`` in shards of nearly equal bytes, and the map they follow."""
    records = stored(slotted(docs, text_column), "slotted")
    n_rows, n_bytes = slot_loads(records)
    slot_map = SlotMap(docs.sparkSession, n_shards)
    slot_map.rebalance(n_bytes)
    return placed(records, slot_map.shard_of(), n_rows), slot_map


def sharding_query(docs: DataFrame) -> DataFrame:
    found, _ = shards(docs)
    return found.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "virtual_slot",
    )
