"""Exact Jaccard join of word n-gram sets, and the groups that its links form.

1. Each text becomes a sorted array of 64-bit shingle hashes. Texts with equal sets are one class,
   known by a 128-bit digest, so a group of copies costs one member from here on.
2. A set of n with more than n - ceil(t n) shingles that no other class has cannot reach the
   threshold t with any. The classes of every shingle in a fixed share (``PROBED``) of the hash
   range are counted, which rules out most texts at the price of one aggregate; the rest are
   candidates.
3. Prefix index of the candidates: two sets within the threshold share one of the first n - ceil(t
   n) + 1 shingles of any common order. Shingles that stand in many texts of a batch come last in
   that order, the rest goes by hash. Which shingles come last only steers the work (at most
   ``LATE_SHINGLES``); every order finds every link.
4. Per index key and size band all classes, and those of the next bands, are compared with one of
   them: the one with the fewest index keys of its own. An original shares all its keys with its
   near copies, so most groups are connected after that, at a cost linear in their size.
5. Where a key still holds classes of several components, tiles finish the job: classes of one size
   band and the next above, in blocks of bounded size. In a tile, hashed bitmaps bound the overlap
   from above: |A n B| <= |A| - bits only in A. Only pairs of different components that pass the
   bound get the exact sorted-array intersection, so no link between components is missed.
6. Components by star contraction; the result names each by its smallest id.

Defined results: a null text or one without words has an empty set and links with nothing; fewer
words than n form one shingle. Rows that repeat an id each get a row. A null id takes part like any
other; a component of null ids only has a null component.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillpanel.llm.common import arrow_fields, discard, in_batches, ship_package, stored
from tillpanel.llm.graph import connected_components
from tillpanel.operators.membership import possible_members

WORDS = 3
PERCENT = 90
#: Share of the hash range whose shingles are counted over all classes.
PROBED = 0.25
#: Shingles seen in this many texts of one batch are put late in the order.
LATE_COUNT = 3
LATE_SHINGLES = 1 << 17
#: Members per block of a tile.
BLOCK = 1024
CACHED_WORDS = 200_000
MIN_BITS, MAX_BITS = 64, 1 << 17

_K = [np.uint64(k) for k in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]


class _WordHashes(dict):
    def __missing__(self, word):
        if len(self) >= CACHED_WORDS:
            self.clear()
        found = self[word] = xxhash.xxh3_64_intdigest(word)
        return found


def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def shingles(text: str | None, hashes: dict[bytes, int], n_words: int = WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's shingles."""
    # bytes.lower() changes A-Z alone, bytes.split() parts at \\x20 and \\x09-\\x0D alone.
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    each = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    size = min(n_words, len(words))
    rolled = np.full(len(words) - size + 1, size, np.uint64)
    for k in range(size):
        rolled = _mixed(rolled * _K[k % 3] + each[k : k + len(rolled)])
    return np.unique(rolled)


def digest_of(found: np.ndarray) -> bytes:
    return hashlib.blake2b(found.tobytes(), digest_size=16).digest()


def bitmap(found: np.ndarray) -> bytes:
    """Bit ``hash mod width`` of each shingle; the width is a power of two, 4 to 8 times the set."""
    width = max(MIN_BITS, min(MAX_BITS, 1 << (4 * len(found) - 1).bit_length()))
    bits = np.zeros(width, np.uint8)
    bits[(found & np.uint64(width - 1)).astype(np.int64)] = 1
    return np.packbits(bits, bitorder="little").tobytes()


def folded(bits: np.ndarray, width: int) -> np.ndarray:
    """A bitmap (64-bit words) narrowed to ``width`` words."""
    while len(bits) > width:
        bits = bits[: len(bits) // 2] | bits[len(bits) // 2 :]
    return bits


def enough(overlap, size_a, size_b, percent: int):
    """overlap / union >= percent / 100, in whole numbers."""
    return (100 + percent) * overlap >= percent * (size_a + size_b)


# ---- passes over the texts ---------------------------------------------------------------------


def prefix_length(n, percent: int):
    """Shingles of which a set of n shares at least one with any set within the threshold."""
    return n - (percent * n + 99) // 100 + 1


def _classes_and_common(docs: DataFrame, n_words: int) -> DataFrame:
    """Rows of two kinds: each document's set size, digest and probed shingles; shingles common in a batch.

    ``class`` is the first half of the digest.
    """
    probed = np.uint64(int(PROBED * 2**64))

    def start():
        hashes = _WordHashes()

        def work(columns):
            sets = [shingles(text, hashes, n_words) for text in columns["text"]]
            digests = [digest_of(s) if len(s) else None for s in sets]
            n = len(sets)
            common, seen = np.unique(np.concatenate(sets), return_counts=True)
            late = seen >= LATE_COUNT
            common, seen = common[late].view(np.int64), seen[late]
            rest = len(common)
            return {
                "is_doc": [True] * n + [False] * rest,
                "doc_id": columns["doc_id"] + [None] * rest,
                "n": [len(s) for s in sets] + seen.tolist(),
                "digest": digests + [None] * rest,
                "class": [
                    None if d is None else int.from_bytes(d[:8], "little", signed=True) for d in digests
                ] + common.tolist(),
                "probes": [s[: np.searchsorted(s, probed)].view(np.int64) for s in sets] + [None] * rest,
            }

        return work

    schema = "is_doc boolean, doc_id long, n long, digest binary, class long, probes array<long>"
    return in_batches(docs, schema, start)


def _late_shingles(common: DataFrame) -> np.ndarray:
    """The shingles seen most often, sorted: at most ``LATE_SHINGLES``; they steer the order of the index only."""
    seen = common.groupBy("class").agg(F.sum("n").alias("n"))
    level = F.floor(F.log2("n") * 8)
    # The cut comes from a histogram of a few hundred rows, so that no more shingles are collected.
    left, cut = LATE_SHINGLES, None
    for row in sorted(seen.groupBy(level.alias("level")).count().collect(), reverse=True):
        left -= row["count"]
        if left < 0:
            break
        cut = row.level
    if cut is None:
        return np.zeros(0, np.uint64)
    found = seen.filter(level >= cut).select("class").toPandas()
    return np.sort(found["class"].to_numpy(np.int64).view(np.uint64))


def _candidates(rows: DataFrame, percent: int) -> DataFrame:
    """All classes; ``is_member`` tells those with too few shingles of their own to be ruled out."""
    owners = (
        rows.select("class", F.explode("probes").alias("probe"))
        .groupBy("probe").agg(F.min("class").alias("class"), F.max("class").alias("other"))
        .filter(F.col("class") == F.col("other"))
        .groupBy("class").agg(F.count("*").alias("own"))
    )
    classes = rows.filter("n > 0").groupBy("digest").agg(
        F.min("doc_id").alias("doc_id"), F.max("n").alias("n"), F.max("class").alias("class")
    )
    prefix = F.col("n") - F.floor((F.col("n") * percent + 99) / 100) + 1
    is_member = F.coalesce("own", F.lit(0)) < prefix
    return classes.join(owners, "class", "left").select("digest", "doc_id", is_member.alias("is_member"))


def _sets(docs: DataFrame, members: DataFrame, late: np.ndarray, n_words: int, percent: int) -> DataFrame:
    """Shingles, bitmap and index keys of the classes in ``members`` (doc_id, digest)."""
    # Most texts are no members; few of these are shuffled.
    near = possible_members(docs, F.col("doc_id"), members, F.col("doc_id"))
    texts = near.join(
        members.select(F.col("doc_id").alias("member_id"), F.col("digest").alias("member")),
        F.col("doc_id").eqNullSafe(F.col("member_id")),
    ).select("text", "member")
    shared = docs.sparkSession.sparkContext.broadcast(late)

    def start():
        hashes, late = _WordHashes(), shared.value

        def keys(found):
            prefix = prefix_length(len(found), percent)
            if len(late):
                is_late = late[np.minimum(np.searchsorted(late, found), len(late) - 1)] == found
                found = np.concatenate((found[~is_late], found[is_late]))
            return found[:prefix].view(np.int64)

        def work(columns):
            sets = [shingles(text, hashes, n_words) for text in columns["text"]]
            # An id that repeats with another text is not this class.
            rows = [
                (m, s) for m, s in zip(columns["member"], sets, strict=True)
                if len(s) and digest_of(s) == m
            ]
            return {
                "digest": [m for m, _ in rows],
                "n": [len(s) for _, s in rows],
                "shingles": [s.tobytes() for _, s in rows],
                "bits": [bitmap(s) for _, s in rows],
                "keys": [keys(s) for _, s in rows],
            }

        return work

    schema = "digest binary, n long, shingles binary, bits binary, keys array<long>"
    return in_batches(texts, schema, start, chunk_rows=256).dropDuplicates(["digest"])


# ---- pairs --------------------------------------------------------------------------------------


def size_band(n: Column, percent: int) -> Column:
    """Number of the size band; sets within the threshold are in one band or in neighbouring ones."""
    step = float(np.log(100 / percent)) + 0.0005
    return F.floor(F.log(n.cast("double")) / step)


def _hub_pairs(entries: DataFrame, percent: int) -> DataFrame:
    """Each class with the hub of its key in its own and the neighbouring size bands, as (a, b)."""
    hubs = (
        entries.groupBy("key", F.col("band").alias("at"))
        .agg(F.min(F.struct("own", "n", "digest")).alias("hub"))
        .select("key", "at", F.col("hub.digest").alias("hub"), F.col("hub.n").alias("hub_n"))
    )
    near = F.explode(F.array(F.col("band") - 1, F.col("band"), F.col("band") + 1)).alias("at")
    return (
        entries.select("key", "digest", "n", near).join(hubs, ["key", "at"])
        .filter((F.col("digest") != F.col("hub")) & _close_in_size(F.col("n"), F.col("hub_n"), percent))
        .select(F.least("digest", "hub").alias("a"), F.greatest("digest", "hub").alias("b")).distinct()
    )


def _close_in_size(size_a: Column, size_b: Column, percent: int) -> Column:
    return F.least(size_a, size_b) * 100 >= F.greatest(size_a, size_b) * percent


def bound(bits_a: np.ndarray, bits_b: np.ndarray, n_a, n_b):
    """Upper bound of the overlap of two sets, from bitmaps of one width (rows may be stacked)."""
    only_a = np.bitwise_count(bits_a & ~bits_b).sum(axis=-1, dtype=np.int64)
    only_b = np.bitwise_count(bits_b & ~bits_a).sum(axis=-1, dtype=np.int64)
    return np.minimum(n_a - only_a, n_b - only_b)


def _links(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets reach the threshold."""
    side = lambda name: sets.select(
        F.col("digest").alias(name), F.col("shingles").alias(f"set_{name}"), F.col("bits").alias(f"bits_{name}")
    )
    joined = pairs.select("a", "b").join(side("a"), "a").join(side("b"), "b")

    def linked(set_a, bits_a, set_b, bits_b):
        a, b = np.frombuffer(set_a, np.uint64), np.frombuffer(set_b, np.uint64)
        bits_a, bits_b = np.frombuffer(bits_a, np.uint64), np.frombuffer(bits_b, np.uint64)
        width = min(len(bits_a), len(bits_b))
        most = bound(folded(bits_a, width), folded(bits_b, width), len(a), len(b))
        if not enough(most, len(a), len(b), percent):
            return False
        short, long = (a, b) if len(a) <= len(b) else (b, a)
        at = np.minimum(np.searchsorted(long, short), len(long) - 1)
        return bool(enough(int((long[at] == short).sum()), len(a), len(b), percent))

    def start():
        def work(columns):
            names = ("set_a", "bits_a", "set_b", "bits_b")
            kept = [linked(*row) for row in zip(*(columns[n] for n in names), strict=True)]
            return {
                n: [v for v, keep in zip(columns[n], kept, strict=True) if keep] for n in ("a", "b")
            }

        return work

    return in_batches(joined, "a binary, b binary", start, chunk_rows=256)


def _tile_pairs(tiles: DataFrame, percent: int) -> DataFrame:
    """Pairs of different components in one tile that pass the bitmap bound.

    ``tiles`` is sorted by tile within its partitions; a tile has at most two blocks of members.
    """
    schema = "a binary, b binary"
    fields = arrow_fields(schema)
    ship_package(tiles.sparkSession)
    names = ("tile", "digest", "n", "component", "side", "bits")

    def pairs_of(rows):
        rows = sorted(rows, key=lambda r: (r[2], r[1]))
        width = min(len(r[5]) for r in rows) // 8
        bits = np.stack([folded(np.frombuffer(r[5], np.uint64), width) for r in rows])
        n = np.array([r[2] for r in rows])
        side = np.array([r[4] for r in rows])
        numbers: dict[bytes, int] = {}
        component = np.array([numbers.setdefault(r[3], len(numbers)) for r in rows])
        # Sides are bit sets: a pair counts in this tile if its members are on sides 1 and 2.
        for i in range(len(rows) - 1):
            ahead = slice(i + 1, np.searchsorted(n, n[i] * 100 // percent, side="right"))
            other = (component[ahead] != component[i]) & ((side[ahead] & side[i] == 0) | (side[i] == 3))
            at = np.flatnonzero(other) + i + 1
            if len(at):
                most = bound(bits[at], bits[i], n[at], n[i])
                for j in at[enough(most, n[at], n[i], percent)]:
                    yield min(rows[i][1], rows[j][1]), max(rows[i][1], rows[j][1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made(found):
            return pa.RecordBatch.from_arrays(
                [pa.array([p[k] for p in found], pa.binary()) for k in (0, 1)], schema=fields
            )

        current, held, found = None, [], []
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in names), strict=True):
                if row[0] != current:
                    if held:
                        found.extend(pairs_of(held))
                    current, held = row[0], []
                    if len(found) > 10_000:
                        yield made(found)
                        found = []
                held.append(row)
        if held:
            found.extend(pairs_of(held))
        yield made(found)

    return tiles.select(*names).mapInArrow(run, schema)


def _tiles(entries: DataFrame, bits: DataFrame, percent: int) -> DataFrame:
    """Size-banded tiles of the keys that hold several components, cut into blocks.

    A band is narrower than the size ratio of a link, so links lie within a band or reach the next.
    Large tiles are split by a hash of the digest into k blocks; each two blocks form a tile of their own.
    """
    open_keys = (
        entries.groupBy("key")
        .agg(F.min("component").alias("low"), F.max("component").alias("high"))
        .filter("low <> high").select("key")
    )
    # Side 3: own band, linked among themselves and with the band above (side 2).
    banded = entries.join(open_keys, "key").select(
        "*", F.inline(F.array(
            F.struct(F.col("band").alias("at"), F.lit(3).alias("role")),
            F.struct((F.col("band") - 1).alias("at"), F.lit(2).alias("role")),
        )),
    )
    sizes = (
        banded.groupBy("key", "at")
        .agg(F.count("*").alias("members"), F.max("role").alias("top"),
             F.min("component").alias("low"), F.max("component").alias("high"))
        .filter("top = 3 AND low <> high")
        .select("key", "at", F.ceil(F.col("members") / BLOCK).alias("blocks"))
    )
    block = F.pmod(F.xxhash64("digest"), F.col("blocks"))
    partner = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    cut = (
        banded.join(sizes, ["key", "at"])
        .withColumn("block", block)
        .withColumn("partner", partner)
        .join(bits, "digest")
    )
    within = F.col("block") == F.col("partner")
    # In a tile of two blocks only pairs across count: the lower block is side 1, the upper side 2. In a
    # tile of one block the role decides.
    side = (
        F.when(within, F.col("role"))
        .when(F.col("block") < F.col("partner"), F.lit(1)).otherwise(F.lit(2))
    )
    return cut.select(
        F.concat_ws("/", "key", "at", F.least("block", "partner"), F.greatest("block", "partner"))
        .alias("tile"),
        "digest", "n", "component", side.alias("side"), "bits",
    ).repartition("tile").sortWithinPartitions("tile")


# ---- the join -----------------------------------------------------------------------------------


def ngram_groups(
    docs: DataFrame, n_words: int = WORDS, percent: int = PERCENT, text_column: str = "text"
) -> DataFrame:
    """Per document: set size, class digest, and the smallest id of its component."""
    docs = docs.select(F.col("doc_id").cast("long"), F.col(text_column).alias("text"))
    first = stored(_classes_and_common(docs, n_words), "ngram-classes")
    late = _late_shingles(first.filter(~F.col("is_doc")))
    classes = stored(_candidates(first.filter("is_doc"), percent), "ngram-candidates")
    rows = stored(first.filter("is_doc").select("doc_id", "n", "digest"), "ngram-rows")
    # Tables go with their last reader; the probes are the largest.
    discard(first)
    members = classes.filter("is_member").select("digest", "doc_id")
    sets = stored(_sets(docs, members, late, n_words, percent), "ngram-sets")

    index = sets.select(
        "digest", "n", size_band(F.col("n"), percent).alias("band"),
        F.size("keys").alias("n_keys"), F.explode("keys").alias("key"),
    )
    keys = (
        index.groupBy("key")
        .agg(F.min("digest").alias("least"), F.max("digest").alias("most"))
        .filter("least <> most").select("key")
    )
    shared = stored(index.join(keys, "key"), "ngram-entries")
    own = shared.groupBy("digest").agg((F.max("n_keys") - F.count("*")).alias("own"))
    entries = shared.join(own, "digest")
    stars = stored(_hub_pairs(entries, percent), "ngram-stars")
    edges = stored(_links(stars, sets, percent), "ngram-links")
    labels = connected_components(edges)

    open_entries = entries.select("key", "digest", "n", "band").join(
        labels.withColumnRenamed("node", "digest"), "digest", "left"
    ).withColumn("component", F.coalesce("component", "digest"))
    tiles = _tiles(open_entries, sets.select("digest", "bits"), percent)
    more = _tile_pairs(tiles, percent).distinct().join(stars, ["a", "b"], "left_anti")
    late_edges = stored(_links(more, sets, percent), "ngram-links")
    if late_edges.limit(1).count():
        labels = connected_components(edges.union(late_edges))
    discard(sets, shared, stars, edges, late_edges)

    named = classes.join(labels.withColumnRenamed("node", "digest"), "digest", "left").select(
        "digest", "doc_id", F.coalesce("component", "digest").alias("component")
    )
    least = named.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    by_class = named.select("digest", "component").join(least, "component").select("digest", "component_id")
    return rows.join(by_class, "digest", "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        "digest",
    )


def ngram_query(docs: DataFrame) -> DataFrame:
    return ngram_groups(docs).select("doc_id", "n_shingles", "component_id")


def ngram_sql() -> str:
    """The same groups in DuckDB SQL, by a plain self join on shared shingles."""
    return r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(string_split_regex(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i+1] || ' ' || w[i+2]))
    END AS s
  FROM words
), sized AS (SELECT doc_id, s, len(s)::BIGINT AS n FROM sets),
classes AS (SELECT min(doc_id) AS c, any_value(s) AS s, any_value(n) AS n
            FROM sized WHERE n > 0 GROUP BY list_sort(s)),
grams AS (SELECT c, n, unnest(s) AS g FROM classes),
pairs AS (
  SELECT a.c AS a, b.c AS b FROM grams a JOIN grams b ON a.g = b.g AND a.c <> b.c
  WHERE 100 * least(a.n, b.n) >= 90 * greatest(a.n, b.n)
  GROUP BY a.c, b.c, a.n, b.n HAVING 190 * count(*) >= 90 * (a.n + b.n)
), reach AS (
  SELECT a, b FROM pairs UNION SELECT r.a, p.b FROM reach r JOIN pairs p ON r.b = p.a
), named AS (
  SELECT c, least(c, coalesce((SELECT min(b) FROM reach WHERE a = c), c)) AS component_id FROM classes
)
SELECT d.doc_id, d.n AS n_shingles, CASE WHEN d.n = 0 THEN d.doc_id ELSE k.component_id END AS component_id
FROM sized d LEFT JOIN classes c ON d.n > 0 AND list_sort(d.s) = list_sort(c.s)
LEFT JOIN named k ON k.c = c.c"""
