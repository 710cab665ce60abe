"""Rows that every operator must take: nulls, empty and long texts, repeated rows, clashing columns."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
# Columns whose names operators use for their own results or inside.
CLASHING = (
    "n_words", "sequence_id", "offset", "score", "lang_pred", "bucket", "digest", "component_id", "rank",
    "kept_text", "drops", "length", "n_dropped_lines", "fingerprint", "class",
)

VOCABULARY = [a + b for a in "ba de fi go lu ma ne po ra si".split() for b in "ban dor fil mun rit sal tev".split()]


def prose(seed: int, words: int) -> str:
    pick = random.Random(seed)
    return " ".join(pick.choice(VOCABULARY) for _ in range(words))


def odd_rows() -> list[tuple]:
    long = prose(1, 30_000)
    rows = [
        (1, None, None, None, None),
        (2, "", "en", "s", 0),
        (3, " \t\n \r\n", "en", None, 5),
        (4, "one", "en", "s", 3),
        (5, prose(2, 80), "en", "s", 1),
        (6, prose(2, 80), "en", "s", 1),
        (6, prose(2, 80), "en", "s", 1),
        (7, long, "en", "s", len(long)),
        (8, "x" * 50_000, None, "s", 50_000),
        (9, "日本語 😀 é ▁ <|endoftext|>\x00\x1f", "en", "s", 1),
        (None, prose(3, 60), "en", "s", 1),
        (11, "a\nb\n\na", "en", "s", 7),
    ]
    return rows


def frame(spark, rows=None):
    """The rows as documents, with the clashing columns."""
    from pyspark.sql import functions as F

    made = spark.createDataFrame(odd_rows() if rows is None else rows, SCHEMA)
    return made.withColumns({name: F.lit("clash") for name in CLASHING})
