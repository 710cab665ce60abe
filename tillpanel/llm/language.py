"""Language identification: multinomial naive Bayes over hashed character n-grams.

Training counts hashed n-grams per language over every labelled text (no sample): each task adds up
its own counts, so one row per language, bucket and task is shuffled. The log-probability matrix has
one row per language and ``BUCKETS`` columns whatever the corpus; it goes to the tasks as a
broadcast variable. Languages are label values, limited to ``MAX_LANGUAGES``, more is an error. A
text is scored as a sparse product of its bucket counts and the matrix, many texts at a time.

Defined results: a null text, or one without letters, is ``und`` with score 0. With no labelled text
at all every text is ``und``. Ties go to the first language in text order. Repeated rows each get
their row.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillpanel.llm.common import id_bucket, in_batches, kept_columns, kept_schema, kept_values

BUCKETS = 1 << 16
ORDERS = (1, 2, 3)
MAX_LANGUAGES = 512
SMOOTHING = 0.5
UNDETERMINED = "und"
#: Texts longer than this are hashed in pieces, so the arrays in memory stay small.
PIECE = 1 << 16
#: Letters of texts that are scored together.
BATCH_LETTERS = 1 << 15

_MIX = np.uint64(0x9E3779B97F4A7C15)
_SHIFT = np.uint64(48)
_SEEDS = [np.uint64(k * 0xD6E8FEB86659FD93 % 2**64) for k in range(max(ORDERS) + 1)]


def letters_of(text: str) -> np.ndarray:
    """Lower-cased code points; each run of anything but letters is one space, at both ends too."""
    points = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _is_letter(points)
    before = np.concatenate(([True], letter[:-1]))
    return np.where(letter, points, 32)[letter | before]


def _letter_table() -> np.ndarray:
    return np.frombuffer(bytes(chr(c).isalpha() for c in range(0x110000)), np.bool_)


_LETTERS: list[np.ndarray] = []


def _is_letter(points: np.ndarray) -> np.ndarray:
    if not _LETTERS:
        _LETTERS.append(_letter_table())
    return _LETTERS[0][points]


def has_letters(points: np.ndarray) -> bool:
    return bool((points != 32).any())


def buckets_of(points: np.ndarray) -> np.ndarray:
    """Bucket numbers of the n-grams of every order."""
    points = points.astype(np.uint64)
    found = []
    rolling = np.zeros(len(points), np.uint64)
    for order in range(1, max(ORDERS) + 1):
        if len(points) < order:
            break
        rolling = rolling[: len(points) - order + 1] * np.uint64(1 << 21) + points[order - 1 :]
        if order in ORDERS:
            mixed = (rolling + _SEEDS[order]) * _MIX
            mixed ^= mixed >> np.uint64(29)
            found.append(((mixed * _MIX) >> _SHIFT).astype(np.int64))
    return np.concatenate(found) if found else np.zeros(0, np.int64)


def count_buckets(points: np.ndarray) -> np.ndarray:
    """Counts of all buckets; pieces overlap by the longest order less one, counted once."""
    total = np.zeros(BUCKETS, np.int64)
    overlap = max(ORDERS) - 1
    for start in range(0, max(1, len(points)), PIECE):
        piece = points[max(0, start - overlap) : start + PIECE]
        total += np.bincount(buckets_of(piece), minlength=BUCKETS)
        if start:
            total -= np.bincount(buckets_of(piece[:overlap]), minlength=BUCKETS)
    return total


class _Counter:
    def __init__(self):
        self.by_language: dict[str, np.ndarray] = {}

    def __call__(self, columns):
        for text, lang in zip(columns["text"], columns["lang"], strict=True):
            points = letters_of(text)
            if has_letters(points):
                if lang not in self.by_language:
                    if len(self.by_language) >= MAX_LANGUAGES:
                        raise ValueError(f"more than {MAX_LANGUAGES} languages in the labels")
                    self.by_language[lang] = np.zeros(BUCKETS, np.int64)
                if len(points) <= PIECE:
                    found, n = np.unique(buckets_of(points), return_counts=True)
                    self.by_language[lang][found] += n
                else:
                    self.by_language[lang] += count_buckets(points)

    def rest(self):
        for lang, counts in self.by_language.items():
            found = np.flatnonzero(counts)
            yield {"lang": [lang] * len(found), "bucket": found, "n": counts[found]}


class LanguageModel:
    """Languages in text order and their log-probability matrix (buckets x languages)."""

    def __init__(self, languages: list[str], matrix: np.ndarray):
        self.languages, self.matrix = languages, matrix

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        """Language and posterior of each text; texts of moderate length are scored together."""
        found = [(UNDETERMINED, 0.0)] * len(texts)
        held: list[tuple[int, np.ndarray]] = []
        n_letters = 0
        for i, text in enumerate(texts):
            points = letters_of(text or "")
            if not self.languages or not has_letters(points):
                continue
            if len(points) > PIECE:
                found[i] = self._judged((count_buckets(points) @ self.matrix)[None])[0]
                continue
            held.append((i, points))
            n_letters += len(points)
            if n_letters > BATCH_LETTERS:
                self._judge(held, found)
                held, n_letters = [], 0
        self._judge(held, found)
        return found

    def _judge(self, held, found) -> None:
        """Bucket counts of the texts as one sparse matrix, times the log-probabilities."""
        if not held:
            return
        buckets = [buckets_of(points) for _, points in held]
        row = np.repeat(np.arange(len(held)), [len(b) for b in buckets])
        cells, n = np.unique(row * BUCKETS + np.concatenate(buckets), return_counts=True)
        starts = np.searchsorted(cells, np.arange(len(held)) * BUCKETS)
        scores = np.add.reduceat(n[:, None] * self.matrix[cells % BUCKETS].astype(np.float64), starts, axis=0)
        for (i, _), judged in zip(held, self._judged(scores), strict=True):
            found[i] = judged

    def _judged(self, scores: np.ndarray) -> list[tuple[str, float]]:
        best = scores.argmax(axis=1)
        # Equal priors. Neighbouring n-grams share letters, so the evidence is spread over the orders.
        odds = np.exp((scores - scores.max(axis=1, keepdims=True)) / len(ORDERS))
        return [(self.languages[k], float(s)) for k, s in zip(best, 1.0 / odds.sum(axis=1), strict=True)]


def train(docs: DataFrame, text_column: str = "text", lang_column: str = "lang") -> LanguageModel:
    """Fit on every row of ``docs`` that has a text and a language."""
    labelled = docs.select(
        F.col(text_column).alias("text"), F.col(lang_column).alias("lang")
    ).filter(F.col("text").isNotNull() & F.col("lang").isNotNull())
    counted = in_batches(labelled, "lang string, bucket int, n long", _Counter, finish="rest")
    # At most MAX_LANGUAGES x BUCKETS rows, whatever the corpus.
    rows = counted.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    languages = sorted(rows["lang"].unique())
    if len(languages) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages in the labels")
    counts = np.zeros((BUCKETS, len(languages)))
    column = {lang: i for i, lang in enumerate(languages)}
    counts[rows["bucket"].to_numpy(), rows["lang"].map(column).to_numpy(dtype=int)] = rows["n"]
    smoothed = counts + SMOOTHING
    return LanguageModel(languages, (np.log(smoothed) - np.log(smoothed.sum(axis=0))).astype(np.float32))


def predict(
    docs: DataFrame, model: LanguageModel, text_column: str = "text", keep: tuple[str, ...] = ()
) -> DataFrame:
    """``docs`` ids with ``lang_pred`` and ``score``, beside the columns to ``keep``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def start():
        def work(columns):
            found = shared.value.predict(columns["text"])
            return {
                "doc_id": columns["doc_id"],
                "lang_pred": [lang for lang, _ in found],
                "score": [score for _, score in found],
            } | kept_values(columns, keep, text_column)

        return work

    slim = docs.select(
        F.col("doc_id").cast("long"), F.col(text_column).alias("text"), *kept_columns(keep, text_column)
    )
    return in_batches(
        slim, "doc_id long, lang_pred string, score double" + kept_schema(docs, keep), start
    )


def held_out():
    return F.coalesce(id_bucket("doc_id", 3) == 1, F.lit(False))


def language_query(docs: DataFrame) -> DataFrame:
    model = train(docs.filter(~held_out()))
    scored = predict(docs, model)
    return scored.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
