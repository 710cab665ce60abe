"""Document fingerprints by consistent weighted sampling, in DataFrame operations only.

A text is a weighted set: its words, hashed to ``TERMS`` terms, weighted by their counts S. Sample i
draws, per term, r and c from Gamma(2, 1) and b from the uniform distribution, all fixed by a hash
of term and i:

    t = floor(ln S / r + b),   ln a = ln c - r (t - b + 1)

and keeps the (term, t) with the least a. Two texts agree in a sample with the probability of their
generalised Jaccard similarity, sum of min weights over sum of max weights, so the share of equal
samples estimates it. The draws are a table of ``TERMS`` rows, whatever the corpus, and are looked
up.

Order of documents: rows are dealt to ranges of ids ("buckets", at most ``MAX_BUCKETS``) by
quantiles; the first document of the next bucket visits the one before it, so that each bucket knows
all successors. Texts are shuffled once; everything per term happens where they then are.

Defined results: a null text is an empty one; texts without words share one fingerprint. Rows that
repeat an id follow each other in text order. Rows without an id come first; the last row is
followed by that with the least id. A single row follows itself.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

SAMPLES = 32
TERMS = 1 << 16
ROWS_PER_BUCKET = 500
MAX_BUCKETS = 1 << 16
#: Characters of a fingerprint per sample.
DIGITS = 6

#: Words are runs of anything but \\x20 and \\x09-\\x0D.
BLANKS = r"[\x20\x09-\x0D]+"


def term_of(word: Column) -> Column:
    return F.pmod(F.xxhash64(word), F.lit(TERMS)).cast("int")


def draws(spark: SparkSession, samples: int = SAMPLES) -> DataFrame:
    """(term, r, b, ln_c): the draws of every sample, as arrays."""
    uniform = lambda i, j: (
        (F.xxhash64(F.lit(i), F.lit(j), F.col("term")).bitwiseAND(F.lit((1 << 52) - 1)) + 0.5) / 2.0**52
    )
    gamma = lambda i, j: -F.log(uniform(i, j) * uniform(i, j + 1))
    each = range(samples)
    return spark.range(TERMS).select(F.col("id").cast("int").alias("term")).select(
        "term",
        F.array(*[gamma(i, 0).cast("float") for i in each]).alias("r"),
        F.array(*[uniform(i, 2).cast("float") for i in each]).alias("b"),
        F.array(*[F.log(gamma(i, 3)).cast("float") for i in each]).alias("ln_c"),
    )


def sample_key(i: int) -> Column:
    """ln a in the high bits, to be minimised; then term (16 bits) and t (8 bits)."""
    t = f"floor(ln_weight / r[{i}] + b[{i}])"
    ln_a = f"(ln_c[{i}] - r[{i}] * ({t} - b[{i}] + 1.0D))"
    # -100 < ln a < 100: c and r are draws of a fixed table, and counts are below e^40.
    return F.expr(
        f"shiftleft(cast(({ln_a} + 128.0D) * 1073741824.0D as bigint), 24)"
        f" + shiftleft(cast(term as bigint), 8) + pmod(cast({t} as bigint), 256L)"
    )


def _bucket_of(bounds: list[int]) -> Column:
    """Number of bounds that an id reaches; ``bounds`` is sorted, 2^k - 1 of them. Bisection in k steps."""
    steps = (len(bounds) + 1).bit_length() - 1
    if not steps:
        return F.lit(0)
    table = F.from_json(F.lit(json.dumps(bounds)), "array<bigint>")
    reached = lambda low, step: F.when(
        F.get(table, low + step - 1) <= F.col("doc_id"), low + step
    ).otherwise(low)
    halves = F.array(*[F.lit(1 << k) for k in reversed(range(steps))])
    return F.aggregate(halves, F.lit(0), reached)


def _bounds(ids: DataFrame) -> list[int]:
    """Quantiles of the ids; at most MAX_BUCKETS - 1."""
    n = ids.count()
    buckets = 1
    while buckets < MAX_BUCKETS and buckets * ROWS_PER_BUCKET < n:
        buckets *= 2
    if buckets == 1:
        return []
    shares = [k / buckets for k in range(1, buckets)]
    return [int(q) for q in ids.approxQuantile("doc_id", shares, 1 / (4 * buckets))]


def _in_order(docs: DataFrame) -> DataFrame:
    """(bucket, place, guest, doc_id, text, next_text), all rows of a bucket in one partition."""
    ids = docs.select("doc_id").filter(F.col("doc_id").isNotNull())
    bounds = _bounds(ids)
    bucket = _bucket_of(bounds)
    # One row per bucket in use, so at most MAX_BUCKETS.
    firsts = [
        (r.bucket, r.first)
        for r in ids.groupBy(bucket.alias("bucket")).agg(F.min("doc_id").alias("first"))
        .orderBy("bucket").collect()
    ]
    guests = [
        (first, firsts[k - 1][0]) for k, (_, first) in enumerate(firsts)
    ]  # the very first visits the last bucket
    visits = docs.sparkSession.createDataFrame(guests, "guest_id long, visited int")
    own = F.struct(bucket.alias("bucket"), F.lit(0).alias("guest"))
    visit = F.struct(F.col("visited").alias("bucket"), F.lit(1).alias("guest"))
    placed = (
        docs.join(F.broadcast(visits), F.col("doc_id") == F.col("guest_id"), "left")
        .select(
            "doc_id", "text",
            F.inline(F.when(F.col("visited").isNull(), F.array(own)).otherwise(F.array(own, visit))),
        )
    )
    order = Window.partitionBy("bucket").orderBy("guest", "doc_id", "text")
    return placed.select(
        "bucket", "guest", "doc_id", "text",
        F.row_number().over(order).alias("place"), F.lead("text").over(order).alias("next_text"),
    )


def edited_text() -> Column:
    quarter = F.floor(F.length("text") / 4).cast("int")
    return F.concat(
        F.substring("text", F.lit(1), F.length("text") - quarter),
        F.substring(F.coalesce("next_text", F.lit("")), F.lit(1), quarter),
    )


def signatures(terms: DataFrame, keys: list[str], samples: int = SAMPLES) -> DataFrame:
    """The samples of each group of ``terms`` (keys, term, n), as an array of (term, t) numbers."""
    table = F.broadcast(draws(terms.sparkSession, samples))  # TERMS rows
    weighted = terms.select(*keys, "term", F.log(F.col("n").cast("double")).alias("ln_weight"))
    least = weighted.join(table, "term").groupBy(*keys).agg(
        *[F.min(sample_key(i)).alias(f"s{i}") for i in range(samples)]
    )
    low = (1 << 24) - 1
    return least.select(
        *keys, F.array(*[F.col(f"s{i}").bitwiseAND(F.lit(low)) for i in range(samples)]).alias("signature")
    )


def likeness(one: Column, other: Column, samples: int = SAMPLES) -> Column:
    """Share of equal samples; the empty signature (null) is like itself alone."""
    equal = F.aggregate(
        F.zip_with(one, other, lambda a, b: (a == b).cast("int")), F.lit(0), lambda n, x: n + x
    )
    return F.when(one.isNull() | other.isNull(), (one.isNull() & other.isNull()).cast("double")).otherwise(
        equal / F.lit(float(samples))
    )


def hex_signature(signature: Column, samples: int = SAMPLES) -> Column:
    """Fixed-width text; texts without words get all f, which no sample has."""
    parts = F.transform(signature, lambda s: F.lpad(F.lower(F.hex(s)), DIGITS, "0"))
    return F.coalesce(F.array_join(parts, ""), F.lit("-" * DIGITS * samples))


def fingerprints(docs: DataFrame, samples: int = SAMPLES, text_column: str = "text") -> DataFrame:
    """Per document: fingerprint, that of the edited text, and likeness to it and to the next document."""
    slim = docs.select(
        F.col("doc_id").cast("long"), F.coalesce(F.col(text_column), F.lit("")).alias("text")
    )
    # The filter is in both uses of the ordered rows, which then share their shuffle.
    ordered = _in_order(slim).filter(F.col("bucket").isNotNull())
    versions = F.when(
        F.col("guest") == 0,
        F.array(F.struct(F.lit(0).alias("version"), F.col("text").alias("body")),
                F.struct(F.lit(1).alias("version"), edited_text().alias("body"))),
    ).otherwise(F.array(F.struct(F.lit(0).alias("version"), F.col("text").alias("body"))))
    words = (
        ordered.select("bucket", "place", F.inline(versions))
        .select("bucket", "place", "version", F.explode(F.split("body", BLANKS)).alias("word"))
        .filter("word <> ''")
    )
    terms = words.groupBy("bucket", "place", "version", term_of(F.col("word")).alias("term")).agg(
        F.count("*").alias("n")
    )
    sampled = signatures(terms, ["bucket", "place", "version"], samples)
    both = sampled.groupBy("bucket", "place").agg(
        F.max(F.when(F.col("version") == 0, F.col("signature"))).alias("own"),
        F.max(F.when(F.col("version") == 1, F.col("signature"))).alias("edited"),
    )
    known = ordered.select(
        "bucket", "place", "guest", "doc_id", F.length("text").cast("long").alias("n_chars"),
        F.when(F.col("guest") == 0, F.sha2(edited_text().cast("binary"), 256)).alias("edited_sha256"),
    )
    order = Window.partitionBy("bucket").orderBy("place")
    rows = known.join(both, ["bucket", "place"], "left").withColumn("next", F.lead("own").over(order))
    return rows.filter("guest = 0").select(
        "doc_id", "n_chars", "edited_sha256",
        hex_signature(F.col("own"), samples).alias("fingerprint"),
        hex_signature(F.col("edited"), samples).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("edited"), samples).alias("near_edited"),
        likeness(F.col("own"), F.col("next"), samples).alias("near_next"),
    )


def fingerprint_query(docs: DataFrame) -> DataFrame:
    return fingerprints(docs)
