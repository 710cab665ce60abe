"""Toxic passages as maximum-scoring segments over token log-odds.

1. From labelled rows, the documents that hold a token are counted per class, in ``BUCKETS`` hashed
   buckets (each word, and its first letters, so that inflected forms share evidence). Log-odds take
   an informative Dirichlet prior of ``PRIOR`` pseudo-documents split by the class shares.
2. A text becomes a sequence of log-odds less a drift. One linear scan (Ruzzo-Tompa) finds all its
   maximal segments.
3. In clean text the best of n tokens' segments follows an extreme-value law: E = K n exp(-lambda S)
   are expected by chance. Lambda solves the Karlin-Altschul equation of the clean token scores, K
   is fitted on clean rows kept apart from the counts. Segments with E <= ``SIGNIFICANT`` are
   reported.
4. A document's evidence pools its segments by the Karlin-Altschul sum statistic: the r best have
   calibrated scores -ln E that add up to T, which clean text reaches with a probability of about
   exp(-T) T^(r-1) / (r! (r-1)!); the least likely r counts. The score is a logistic function of the
   logarithm of that evidence, fitted on those same rows.

Segments are those of all tokens, repeats included. Only where they are pooled does a word count once,
in the best segment that has it; its repeats carry the drift there.

The fit takes at most ``TRAINING_ROWS`` labelled rows (those with the smallest hash of the id), so
the list of ids joined to the texts is bounded; every text is then scored. Counts and the broadcast
table have ``BUCKETS`` entries whatever the corpus.

Defined results: a null or empty text has no segment and the score of E = 1 or above, which is low.
Repeated rows each get their row. With no labelled rows of both classes every score is 0.
"""

from __future__ import annotations

import string
import zlib
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillpanel.llm.common import id_bucket, in_batches, kept_columns, kept_schema, kept_values, stored

BUCKETS = 1 << 18
STEMS = (4, 5, 6)
PRIOR = 4.0
DRIFT = 1.0
SIGNIFICANT = 0.01
TRAINING_ROWS = 50_000
CACHED_TOKENS = 200_000
EULER = 0.5772156649

_STRIPPED = string.punctuation + "«»“”„’‘…¡¿"


def features(token: str) -> tuple[int, ...]:
    """Buckets of a token: the word itself, and its stems (first letters) where it is longer."""
    word = token.strip(_STRIPPED)
    if not word:
        return ()
    names = [word, *(f"^{word[:n]}" for n in STEMS if len(word) > n)]
    return tuple(zlib.crc32(name.encode("utf-8", "surrogatepass")) % BUCKETS for name in names)


class _Cache(dict):
    """Token -> value, forgotten as a whole when it has grown to ``CACHED_TOKENS``."""

    def __init__(self, value):
        super().__init__()
        self.value = value

    def __missing__(self, token):
        if len(self) >= CACHED_TOKENS:
            self.clear()
        found = self[token] = self.value(token)
        return found


def tokens_of(text: str | None) -> list[str]:
    return (text or "").lower().split()


class _Counter:
    def __init__(self):
        self.cache = _Cache(features)
        self.counts = np.zeros((2, BUCKETS), np.int64)
        self.rows = [0, 0]

    def __call__(self, columns):
        for text, toxic in zip(columns["text"], columns["toxic"], strict=True):
            present = {b for token in set(tokens_of(text)) for b in self.cache[token]}
            self.counts[toxic, np.fromiter(present, np.int64, len(present))] += 1
            self.rows[toxic] += 1

    def rest(self):
        found = np.flatnonzero(self.counts.any(axis=0))
        yield {"bucket": found, "clean": self.counts[0, found], "toxic": self.counts[1, found]}
        yield {"bucket": [-1], "clean": [self.rows[0]], "toxic": [self.rows[1]]}


def maximal_segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (start, end, score), end exclusive, in text order; linear time."""
    positive = np.flatnonzero(scores > 0)
    if not len(positive):
        return []
    total = np.concatenate(([0.0], np.cumsum(scores, dtype=np.float64)))
    kept: list[tuple[int, int, float, float]] = []  # start, end, total before, total after
    link: list[int] = []  # nearest earlier segment with a smaller total before it
    for at in positive.tolist():
        start, end, low, high = at, at + 1, float(total[at]), float(total[at + 1])
        while True:
            j = len(kept) - 1
            while j >= 0 and kept[j][2] >= low:
                j = link[j]
            if j < 0 or kept[j][3] >= high:
                kept.append((start, end, low, high))
                link.append(j)
                break
            start, low = kept[j][0], kept[j][2]
            del kept[j:], link[j:]
    return [(start, end, high - low) for start, end, low, high in kept]


@dataclass
class ToxicityModel:
    """Token log-odds by bucket, the extreme-value parameters, and the logistic calibration."""

    log_odds: np.ndarray
    rate: float = 1.0  # lambda
    log_k: float = 0.0
    slope: float = 0.0
    intercept: float = -50.0

    def token_score(self, token: str) -> float:
        found = [float(self.log_odds[b]) for b in features(token)]
        return (max(found, key=abs) if found else 0.0) - DRIFT

    def calibrated(self, scores: np.ndarray, n_tokens: int) -> np.ndarray:
        """-ln E of segment scores among ``n_tokens``."""
        return self.rate * scores - self.log_k - np.log(max(1, n_tokens))

    def pooled(self, scores: np.ndarray, n_tokens: int) -> float:
        """ln(1 + evidence) of all segments of a text together."""
        best = np.sort(self.calibrated(scores, n_tokens))[::-1]
        sums = np.cumsum(best[best > 0])
        if not len(sums):
            return 0.0
        r = np.arange(1, len(sums) + 1)
        factorials = np.cumsum(np.log(r))
        evidence = sums + factorials + (factorials - np.log(r)) - (r - 1) * np.log(sums)
        return float(np.log1p(max(0.0, evidence.max())))

    def probability(self, pooled: float) -> float:
        return float(1.0 / (1.0 + np.exp(-np.clip(self.slope * pooled + self.intercept, -50, 50))))


def _solve_rate(scores: np.ndarray, weights: np.ndarray) -> float:
    """The positive root of sum p(s) exp(lambda s) = 1, by bisection."""
    share = weights / weights.sum()

    def excess(rate):
        return float((share * np.exp(rate * scores)).sum()) - 1.0

    if not (scores > 0).any() or float((share * scores).sum()) >= 0:
        return 1.0
    low, high = 0.0, 1.0
    while excess(high) < 0 and high < 64:
        low, high = high, high * 2
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if excess(middle) < 0 else (low, middle)
    return high


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3) -> tuple[float, float]:
    """Slope and intercept of a one-variable logistic regression, by damped Newton steps."""
    mean, scale = x.mean(), x.std() or 1.0
    design = np.column_stack(((x - mean) / scale, np.ones_like(x)))
    beta = np.zeros(2)
    for _ in range(100):
        p = 1.0 / (1.0 + np.exp(-np.clip(design @ beta, -30, 30)))
        gradient = design.T @ (y - p) - ridge * len(x) * beta * (1, 0)
        hessian = (design * (p * (1 - p))[:, None]).T @ design + np.diag((ridge * len(x) + 1e-9, 1e-9))
        step = np.linalg.solve(hessian, gradient)
        beta += step * min(1.0, 2.0 / (np.abs(step).max() + 1e-12))
        if np.abs(step).max() < 1e-8:
            break
    return float(beta[0] / scale), float(beta[1] - beta[0] * mean / scale)


def training_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Texts of at most ``TRAINING_ROWS`` labelled ids; ``apart`` marks the rows for calibration."""
    labelled = (
        labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1))
        .groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    )
    # The share of the hash range that holds the least hashes with a margin: not much more than
    # TRAINING_ROWS rows go on to be sorted, however many there are.
    share = min(1.0, 1.05 * TRAINING_ROWS / max(1, labelled.count()))
    last = min(2**63 - 1, int(share * 2**64) - 2**63)
    chosen = (
        labelled.filter(F.xxhash64("doc_id") <= F.lit(last))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(TRAINING_ROWS)
        .withColumn("apart", F.xxhash64(F.lit("apart"), "doc_id") % 3 == 0)
    )
    # Bounded: TRAINING_ROWS rows of an id and two flags.
    return docs.select(F.col("doc_id").cast("long"), "text").join(F.broadcast(chosen), "doc_id")


def train(docs: DataFrame, labels: DataFrame) -> ToxicityModel:
    """Fit on the labelled rows given; the caller holds rows out by filtering ``labels``."""
    rows = stored(training_rows(docs, labels), "toxicity")
    counted = in_batches(
        rows.filter(~F.col("apart")).select("text", "toxic"),
        "bucket int, clean long, toxic long", _Counter, finish="rest",
    )
    # At most BUCKETS + 1 rows.
    found = counted.groupBy("bucket").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")).toPandas()
    totals = found[found["bucket"] == -1][["clean", "toxic"]].sum()
    model = ToxicityModel(np.zeros(BUCKETS, np.float32))
    if min(totals) == 0:
        return model
    share = totals["toxic"] / totals.sum()
    found = found[found["bucket"] >= 0]
    clean, toxic = found["clean"].to_numpy(float), found["toxic"].to_numpy(float)
    odds = np.log((toxic + PRIOR * share) / (clean + PRIOR * (1 - share))) - np.log(share / (1 - share))
    model.log_odds[found["bucket"].to_numpy()] = odds
    model.rate = _solve_rate(model.log_odds[found["bucket"].to_numpy()].astype(float) - DRIFT, clean + 1e-9)

    # At most TRAINING_ROWS rows of three numbers.
    apart = evidence(rows.filter("apart"), model).toPandas()
    best, n, y = (apart[c].to_numpy(float) for c in ("best", "n_tokens", "toxic"))
    usual = (y == 0) & (best > 0)
    if usual.any():
        model.log_k = float((model.rate * best[usual] - np.log(n[usual])).mean() - EULER)
    if 0 < y.sum() < len(y):
        apart = evidence(rows.filter("apart"), model).toPandas()
        model.slope, model.intercept = _logistic(apart["pooled"].to_numpy(float), apart["toxic"].to_numpy(float))
    return model


def _token_scores(cache: _Cache, text: str | None) -> tuple[list[str], np.ndarray]:
    tokens = tokens_of(text)
    return tokens, np.fromiter(map(cache.__getitem__, tokens), np.float64, len(tokens))


def _scan(model: ToxicityModel, cache: _Cache, text: str | None) -> tuple[int, list[tuple[int, int, float]]]:
    tokens, scores = _token_scores(cache, text)
    return len(tokens), maximal_segments(scores)


def counted_once(
    tokens: list[str], scores: np.ndarray, segments: list[tuple[int, int, float]]
) -> np.ndarray:
    """Segment scores, best segment first, with every repeat of a word at the drift; those above 0."""
    seen, found = set(), []
    for a, b, _ in sorted(segments, key=lambda segment: (-segment[2], segment[0])):
        total = 0.0
        for token, value in zip(tokens[a:b], scores[a:b].tolist(), strict=True):
            total += -DRIFT if token in seen else value
            seen.add(token)
        found.append(total)
    found = np.array(found)
    return found[found > 0]


def _judged(model: ToxicityModel, cache: _Cache, text: str | None) -> tuple[int, list[tuple[int, int, float]], float]:
    """Token count, all segments, and the pooled evidence."""
    tokens, scores = _token_scores(cache, text)
    segments = maximal_segments(scores)
    return len(tokens), segments, model.pooled(counted_once(tokens, scores, segments), len(tokens))


def evidence(rows: DataFrame, model: ToxicityModel) -> DataFrame:
    """Token count, best segment score and pooled evidence per row, beside its label."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def start():
        model = shared.value
        cache = _Cache(model.token_score)

        def one(text):
            n, segments, pooled = _judged(model, cache, text)
            return n, max((s for _, _, s in segments), default=0.0), pooled

        def work(columns):
            found = [one(text) for text in columns["text"]]
            return {
                "n_tokens": [n for n, _, _ in found],
                "best": [best for _, best, _ in found],
                "pooled": [pooled for _, _, pooled in found],
                "toxic": columns["toxic"],
            }

        return work

    return in_batches(
        rows.select("text", "toxic"), "n_tokens long, best double, pooled double, toxic int", start
    )


def score(
    docs: DataFrame, model: ToxicityModel, text_column: str = "text", keep: tuple[str, ...] = ()
) -> DataFrame:
    """Id, score, and the significant passages as token ranges with their E-values, beside ``keep``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def start():
        model = shared.value
        cache = _Cache(model.token_score)

        def one(text):
            n, segments, pooled = _judged(model, cache, text)
            scores = np.array([s for _, _, s in segments])
            expected = np.exp(-model.calibrated(scores, n)).tolist()
            told = [
                (a, b, e) for (a, b, _), e in zip(segments, expected, strict=True) if e <= SIGNIFICANT
            ]
            return model.probability(pooled), told

        def work(columns):
            found = [one(text) for text in columns["text"]]
            return {
                "doc_id": columns["doc_id"],
                "score": [p for p, _ in found],
                "passage_starts": [[a for a, _, _ in told] for _, told in found],
                "passage_ends": [[b for _, b, _ in told] for _, told in found],
                "passage_e_values": [[e for _, _, e in told] for _, told in found],
            } | kept_values(columns, keep, text_column)

        return work

    return in_batches(
        docs.select(
            F.col("doc_id").cast("long"), F.col(text_column).alias("text"), *kept_columns(keep, text_column)
        ),
        "doc_id long, score double, passage_starts array<int>, passage_ends array<int>, "
        "passage_e_values array<double>" + kept_schema(docs, keep),
        start,
    )


def held_out():
    return F.coalesce(id_bucket("doc_id", 5) == 0, F.lit(False))


def toxicity_query(docs: DataFrame, labels: DataFrame) -> DataFrame:
    model = train(docs, labels.filter(~held_out()))
    return score(docs, model).select(
        "doc_id", held_out().alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        F.size("passage_starts").alias("n_passages"),
    )
