"""A training corpus from ``documents``: five stages, each on all that the one before it kept.

Each stage takes (spark, docs, sf_dir). All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillpanel.llm import language, line_templates, ngram_join, packing, toxicity
from tillpanel.llm.common import DOCUMENT_COLUMNS, stored, table
from tillpanel.operators.membership import told_apart

#: Least posterior of a text's language; texts without letters have none.
LEAST_LANGUAGE_SCORE = 0.5
TOXIC_SCORE = 0.5
#: Near copies share this percentage of their shingles of so many words; op6 has its own contract.
NEAR_WORDS = 5
NEAR_PERCENT = 80

_PASSED = DOCUMENT_COLUMNS[1:]


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Language ID, learned from the labelled documents; texts of no certain language go."""
    scored = language.predict(docs, language.train(docs), keep=_PASSED)
    kept = (F.col("lang_pred") != language.UNDETERMINED) & (F.col("score") >= LEAST_LANGUAGE_SCORE)
    return scored.filter(kept).select(*DOCUMENT_COLUMNS)


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Toxicity, learned from ``labels``; documents at the threshold or above go."""
    scored = toxicity.score(docs, toxicity.train(docs, table(spark, sf_dir, "labels")), keep=_PASSED)
    return scored.filter(F.col("score") < TOXIC_SCORE).select(*DOCUMENT_COLUMNS)


def without_recurring_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Line dedup; a document that has no line of its own left goes."""
    cleaned = line_templates.drop_recurring_lines(docs.select(*DOCUMENT_COLUMNS))
    changed = F.col("n_dropped_lines") > 0
    return cleaned.filter(~changed | F.col("text").rlike(r"[^\x20\x09-\x0D]")).select(
        *[
            F.when(changed, F.length("text").cast("long")).otherwise(F.col(c)).alias(c)
            if c == "n_chars" else F.col(c)
            for c in DOCUMENT_COLUMNS
        ]
    )


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """N-gram Jaccard join; of each linked group the document with the smallest id stays.

    Rows that repeat an id are one document; of these the row with the least hash of its columns stays.
    Rows without an id cannot be named and stay.
    """
    groups = ngram_join.ngram_groups(docs, n_words=NEAR_WORDS, percent=NEAR_PERCENT)
    is_first = F.col("doc_id") == F.col("component_id")
    ids = stored(
        groups.filter(F.col("doc_id").isNotNull()).groupBy("doc_id")
        .agg(F.max(is_first).alias("is_first"), F.count("*").alias("n_rows")),
        "group-ids",
    )
    docs = docs.select(*DOCUMENT_COLUMNS)
    # Most documents are alone in their group and of an id of their own; their texts are not shuffled.
    affected = ids.filter("n_rows > 1 OR NOT is_first")
    unsure, alone = told_apart(
        docs.filter(F.col("doc_id").isNotNull()), F.col("doc_id").cast("long"), affected, F.col("doc_id")
    )
    first = ids.filter("is_first").select("doc_id")
    marked = unsure.withColumn("mark", F.xxhash64(*DOCUMENT_COLUMNS))
    marks = marked.select("doc_id", "mark").join(first, "doc_id").groupBy("doc_id").agg(F.min("mark").alias("mark"))
    # Rows of one mark are equal, and an id has one mark: what the join has brought together stays there.
    kept = marked.join(marks, ["doc_id", "mark"], "left_semi").dropDuplicates(["doc_id", "mark"])
    return alone.union(kept.select(*DOCUMENT_COLUMNS)).union(docs.filter(F.col("doc_id").isNull()))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Best-fit packing of the token ids into sequences."""
    return packing.packing_query(docs)


STAGES = [
    ("language id", known_language),
    ("toxicity", not_toxic),
    ("line dedup", without_recurring_lines),
    ("n-gram Jaccard join", one_of_each_group),
    ("best-fit packing", packed),
]

#: Trained models and a tokenizer are beyond SQL; tests/llm holds a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; each result is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
