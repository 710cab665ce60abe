"""Exact ranked search over hashed max-sketches.

A document's terms have impacts: weight times saturated frequency, in whole numbers. A sketch folds
them into coordinates: a term's hash names the coordinate, which holds the largest impact of all terms
that fall on it. It does so in ``ROWS`` rows with hashes of their own. A query looks up its terms: the
least of a term's coordinates is at least its impact, and mostly 0 where the document lacks it. So the
sum over its terms is never below the query's score.

1. One pass counts, per term, the documents that hold it: each task sums its own counts before the
   shuffle. Weights follow from these counts over all documents.
2. Sketches need the weight of every term of a document. The ``FREQUENT`` most common terms have
   theirs exactly; the others the largest weight of their slot in a table of ``SLOTS``. Both have a
   fixed size, whatever the vocabulary, and both are never below the true weight. Only bounds use them.
3. In a task, documents are sketched in blocks (rows of ``LOAD`` to twice as many coordinates per term,
   one byte each, rounded up) and all queries of a batch are looked up in them at once. Per query the documents are
   scored exactly in the order of descending bounds, until the next bound is below the score of the
   k-th best so far. That threshold is carried from block to block.
4. A first scan over about ``SEED_ROWS`` documents gives thresholds to start with: the k-th best
   score among any documents is at most the k-th best among all. They steer the work only.
5. Each task returns its k best per query; a ranked window over those gives the result.

Queries go through the documents in batches of about ``BATCH_TERMS`` terms.

Defined results: a null text has no terms. Rows of documents that repeat an id rank each by itself; a
null id comes after all others of its score. Rows of queries that repeat an id (null included) are one
query with the terms of all. Extra columns are ignored.
"""

from __future__ import annotations

import heapq
import math
import zlib
from collections import Counter
from dataclasses import dataclass, field
from functools import reduce
from itertools import chain

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillpanel.llm.common import in_batches, stored

K = 10
FREQUENT = 1 << 16
SLOTS = 1 << 18
SEED_ROWS = 8192
BATCH_TERMS = 1 << 15
#: Distinct terms that a task counts or remembers at a time.
HELD_TERMS = 500_000
ROWS, LOAD = 4, 4
MAX_BITS = 20
#: Documents sketched together, and distinct terms of them.
BLOCK_ROWS, BLOCK_TERMS = 512, 1 << 19
_LAST_ID = 2**63
# Odd numbers, one per row of a sketch.
_ROW_FACTORS = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F], np.uint64)

# Everything in ASCII but digits and letters parts terms; only A-Z change.
_FOLD = bytes(
    c | 0x20 if 0x41 <= c <= 0x5A else c if c >= 0x80 or chr(c).isalnum() else 0x20 for c in range(256)
)


def terms_of(text: str | None) -> list[bytes]:
    """All terms of a text in order, repeats included."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_FOLD).split()


def weight(n_docs: int, docs: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * docs + 1)))


def impact(term_weight, tf, norm):
    """A term's share of a score; whole numbers or arrays of them."""
    return term_weight * ((1_000_000_000 * tf) // (1000 * tf + 8 * norm))


# ---- statistics of the corpus --------------------------------------------------------------------


class _Counts:
    """Documents per term of one task, handed on whenever there are many; totals under the null term."""

    def __init__(self):
        self.docs, self.n_docs, self.n_terms = Counter(), 0, 0

    def __call__(self, columns):
        for text in columns["text"]:
            if found := terms_of(text):
                self.n_docs += 1
                self.n_terms += len(found)
                self.docs.update(set(found))
        return self._handed_on() if len(self.docs) > HELD_TERMS else None

    def _handed_on(self):
        columns = {
            "term": [None, *self.docs],
            "docs": [self.n_docs, *self.docs.values()],
            "terms": [self.n_terms] + [0] * len(self.docs),
        }
        self.__init__()
        return columns

    def finish(self):
        yield self._handed_on()


def term_statistics(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """(term, docs, terms): documents per term; under the null term all documents and terms."""
    partial = in_batches(
        docs.select(F.col(text_column).alias("text")), "term binary, docs long, terms long", _Counts, "finish"
    )
    return stored(partial.groupBy("term").agg(F.sum("docs").alias("docs"), F.sum("terms").alias("terms")), "terms")


@dataclass
class Corpus:
    """What sketches need of the corpus; of fixed size."""

    n_docs: int
    n_terms: int
    frequent: dict[bytes, int] = field(default_factory=dict)
    slots: np.ndarray | None = None

    def norm(self, n: int) -> int:
        """Length norm m of a document of n terms."""
        return 10 + (90 * n * self.n_docs) // self.n_terms


def corpus_of(statistics: DataFrame) -> Corpus:
    totals = statistics.filter("term IS NULL").first()
    if totals is None or not totals.docs:
        return Corpus(0, 0)
    n = totals.docs
    terms = statistics.filter("term IS NOT NULL")
    # The cut comes from a histogram of at most a few hundred rows, so that no more rows are collected.
    level = F.floor(F.log2("docs") * 8)
    left, cut = FREQUENT, None
    for row in sorted(terms.groupBy(level.alias("level")).count().collect(), reverse=True):
        left -= row["count"]
        if left < 0:
            break
        cut = row.level
    is_frequent = level >= cut if cut is not None else F.lit(False)
    frequent = {bytes(r.term): weight(n, r.docs) for r in terms.filter(is_frequent).select("term", "docs").collect()}
    # A slot's largest weight is that of its rarest term.
    rarest = (
        terms.filter(~is_frequent).groupBy((F.crc32("term") % SLOTS).alias("slot")).agg(F.min("docs").alias("docs"))
    ).toArrow()
    slots = np.zeros(SLOTS, np.int64)
    weights = {d: weight(n, d) for d in set(rarest["docs"].to_pylist())}
    slots[rarest["slot"].to_numpy()] = [weights[d] for d in rarest["docs"].to_pylist()]
    return Corpus(n, totals.terms, frequent, slots)


# ---- sketches ------------------------------------------------------------------------------------


class TermKeys(dict):
    """Weight bound (upper bits) and hash (lower 32 bits) of a term; the memory is bounded."""

    def __init__(self, corpus: Corpus):
        super().__init__()
        self.corpus = corpus

    def __missing__(self, term):
        if len(self) >= HELD_TERMS:
            self.clear()
        h = zlib.crc32(term)
        w = self.corpus.frequent.get(term)
        found = self[term] = (int(self.corpus.slots[h % SLOTS]) if w is None else w) << 32 | h
        return found


def coordinates(hashes: np.ndarray, bits) -> np.ndarray:
    """The coordinate of each hash (columns) in each row of a sketch that has ``2 ** bits``."""
    mixed = (hashes.astype(np.uint64)[None, :] * _ROW_FACTORS[:, None]) & np.uint64(0xFFFFFFFF)
    return (mixed >> np.asarray(32 - bits, np.uint64)).astype(np.int64)


@dataclass
class Sketches:
    """Sketches of a block of documents: those of one width are the rows of one matrix."""

    widths: list[tuple[int, np.ndarray, np.ndarray]]  # bits, numbers of the documents, matrix
    units: np.ndarray


def sketches(counts: list[dict[bytes, int]], norms: list[int], keys: TermKeys) -> Sketches:
    """Coordinatewise maxima of the impacts of each document, as bytes in units of its own, rounded up."""
    n = np.array([len(c) for c in counts])
    total = int(n.sum())
    found = np.fromiter(map(keys.__getitem__, chain.from_iterable(counts)), np.int64, total)
    tf = np.fromiter(chain.from_iterable(c.values() for c in counts), np.int64, total)
    impacts = impact(found >> 32, tf, np.repeat(np.array(norms, np.int64), n))
    units = np.maximum(1, -(-np.maximum.reduceat(impacts, np.cumsum(n) - n) // 255))
    codes = (-(-impacts // np.repeat(units, n))).astype(np.uint8)
    bits = np.minimum(MAX_BITS, np.ceil(np.log2(LOAD * n)).astype(np.int64))

    order = np.argsort(codes, kind="stable")  # the largest is written last
    owner = np.repeat(np.arange(len(n)), n)[order]
    hashes, codes, owner_bits = found[order] & 0xFFFFFFFF, codes[order], bits[owner]
    at = coordinates(hashes, owner_bits)
    widths = []
    for b in np.unique(bits).tolist():
        docs = np.flatnonzero(bits == b)
        place = np.zeros(len(n), np.int64)
        place[docs] = np.arange(len(docs))
        mine = owner_bits == b
        matrix = np.zeros((len(docs), ROWS << b), np.uint8)
        for row in range(ROWS):
            matrix[place[owner[mine]], (row << b) + at[row, mine]] = codes[mine]
        widths.append((b, docs, matrix))
    return Sketches(widths, units)


@dataclass
class Batch:
    """Queries that go through the documents together."""

    ids: list[int | None]
    terms: list[list[tuple[bytes, int]]]
    least: list[int]

    def __post_init__(self):
        self.hashes = np.array([zlib.crc32(t) for terms in self.terms for t, _ in terms], np.int64)
        self.starts = np.cumsum([0, *map(len, self.terms)])[:-1]


def bounds(batch: Batch, folded: Sketches) -> np.ndarray:
    """Upper bound of each query's score (columns) in each document (rows)."""
    found = np.zeros((len(folded.units), len(batch.ids)), np.int64)
    for bits, docs, matrix in folded.widths:
        at = coordinates(batch.hashes, bits)
        # So many documents that what is looked up stays below 32 MB.
        step = max(1, (1 << 23) // len(batch.hashes))
        for k in range(0, len(docs), step):
            part = matrix[k : k + step]
            least = part[:, at[0]]
            for row in range(1, ROWS):
                np.minimum(least, part[:, (row << bits) + at[row]], out=least)
            found[docs[k : k + step]] = np.add.reduceat(least.astype(np.int32), batch.starts, axis=1)
    return found * folded.units[:, None]


def exact_score(terms: list[tuple[bytes, int]], counts: dict[bytes, int], norm: int) -> int:
    score = 0
    for term, term_weight in terms:
        if tf := counts.get(term):
            score += impact(term_weight, tf, norm)
    return score


class _Scan:
    """The k best documents of each query among those of a task."""

    def __init__(self, corpus: Corpus, batch: Batch, k: int):
        self.corpus, self.batch, self.k = corpus, batch, k
        self.keys = TermKeys(corpus)
        self.best = [[] for _ in batch.ids]
        self.least = np.array(batch.least, np.int64)

    def __call__(self, columns):
        block, held = [], 0
        for doc_id, text in zip(columns["doc_id"], columns["text"], strict=True):
            if found := terms_of(text):
                block.append((doc_id, Counter(found), self.corpus.norm(len(found))))
                held += len(block[-1][1])
            if held > BLOCK_TERMS:
                self._scan(block)
                block, held = [], 0
        if block:
            self._scan(block)

    def _scan(self, block):
        folded = sketches([counts for _, counts, _ in block], [norm for *_, norm in block], self.keys)
        above = bounds(self.batch, folded)
        for q in np.flatnonzero((above >= self.least).any(axis=0)).tolist():
            self._rescore(q, above[:, q], block)

    def _rescore(self, q, above, block):
        best, terms = self.best[q], self.batch.terms[q]
        at = np.flatnonzero(above >= self.least[q])
        for i in at[np.argsort(-above[at], kind="stable")].tolist():
            if above[i] < self.least[q]:
                break
            doc_id, counts, norm = block[i]
            score = exact_score(terms, counts, norm)
            if score < self.least[q]:
                continue
            entry = (score, -(_LAST_ID if doc_id is None else doc_id))
            if len(best) < self.k:
                heapq.heappush(best, entry)
            else:
                heapq.heappushpop(best, entry)
            if len(best) == self.k:
                self.least[q] = max(self.least[q], best[0][0])

    def finish(self):
        rows = [(q, -negated, score) for q, best in zip(self.batch.ids, self.best, strict=True)
                for score, negated in best]
        yield {
            "item_id": [q for q, _, _ in rows],
            "doc_id": [None if d == _LAST_ID else d for _, d, _ in rows],
            "score": [s for _, _, s in rows],
        }


def _scanned(docs: DataFrame, corpus: Corpus, batch: Batch, k: int) -> DataFrame:
    """(item_id, rank, doc_id, score): the k best of each query."""
    shared = docs.sparkSession.sparkContext.broadcast((corpus, batch))

    def start():
        return _Scan(*shared.value, k)

    found = in_batches(docs, "item_id long, doc_id long, score long", start, "finish", BLOCK_ROWS)
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return (
        found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
        .select("item_id", "rank", "doc_id", "score")
    )


# ---- the search ----------------------------------------------------------------------------------


def _query_terms(items: DataFrame, statistics: DataFrame) -> DataFrame:
    """(item_id, term, docs) of the queries' distinct terms that some document holds."""

    def start():
        def work(columns):
            rows = [(i, t) for i, text in zip(columns["item_id"], columns["text"], strict=True)
                    for t in dict.fromkeys(terms_of(text))]
            return {"item_id": [i for i, _ in rows], "term": [t for _, t in rows]}

        return work

    terms = in_batches(items, "item_id long, term binary", start).distinct()
    return stored(terms.join(statistics.select("term", "docs"), "term"), "query-terms")


def search(docs: DataFrame, items: DataFrame, k: int = K, text_column: str = "text") -> DataFrame:
    """(item_id, rank, doc_id, score): per query of ``items`` its k best documents with a score above 0."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long"), F.col(text_column).alias("text"))
    items = items.select(F.col("item_id").cast("long"), F.col(text_column).alias("text"))
    statistics = term_statistics(docs)
    corpus = corpus_of(statistics)
    queries = _query_terms(items, statistics)
    n_batches = -(-queries.count() // BATCH_TERMS)
    found = []
    for number in range(n_batches):
        mine = F.pmod(F.xxhash64("item_id"), F.lit(n_batches)) == number
        terms: dict[int | None, list] = {}
        for row in queries.filter(mine).collect():
            terms.setdefault(row.item_id, []).append((bytes(row.term), weight(corpus.n_docs, row.docs)))
        if not terms:
            continue
        batch = Batch(list(terms), list(terms.values()), [1] * len(terms))
        if corpus.n_docs > 2 * SEED_ROWS:
            share = int(2**32 * SEED_ROWS / corpus.n_docs)
            some = docs.filter(F.xxhash64("doc_id").bitwiseAND(F.lit(2**32 - 1)) < share)
            seeds = {r.item_id: r.score for r in _scanned(some, corpus, batch, k).filter(F.col("rank") == k).collect()}
            batch = Batch(batch.ids, batch.terms, [seeds.get(i, 1) for i in batch.ids])
        found.append(_scanned(docs, corpus, batch, k))
    if not found:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    return reduce(DataFrame.union, found)


def search_query(docs: DataFrame, items: DataFrame) -> DataFrame:
    return search(docs, items)


def search_sql() -> str:
    """The same ranking in DuckDB SQL, by a plain join on terms."""
    return r"""
WITH terms AS (
  SELECT doc_id, row_number() OVER () AS row_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t
  FROM documents
), totals AS (
  SELECT count(*)::HUGEINT AS n_docs, sum(len(t))::HUGEINT AS n_terms FROM terms WHERE len(t) > 0
), postings AS (
  SELECT row_id, doc_id, n, term, count(*)::HUGEINT AS tf
  FROM (SELECT row_id, doc_id, len(t) AS n, unnest(t) AS term FROM terms) GROUP BY ALL
), weighted AS (
  SELECT DISTINCT item_id, q.term, w FROM (
    SELECT item_id, unnest(regexp_extract_all(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark) q
  JOIN (SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::HUGEINT AS w
        FROM postings, totals GROUP BY term, n_docs) d ON d.term = q.term
), scored AS (
  SELECT item_id, row_id, doc_id,
    sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * n_docs) // n_terms)))) AS score
  FROM weighted JOIN postings USING (term), totals GROUP BY item_id, row_id, doc_id
), ranked AS (
  SELECT item_id, doc_id, score,
    row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS rank
  FROM scored WHERE score > 0
)
SELECT item_id, rank::INTEGER AS rank, doc_id, score::BIGINT AS score FROM ranked WHERE rank <= 10"""
