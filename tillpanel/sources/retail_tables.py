"""Invoice lines derived from the order tables, as two overlapping raw batches.

The order tables have no cancellations, service codes, anonymous buyers or overlapping deliveries, so
fixed rules derive them: a returned line becomes a cancellation, some part keys become service codes,
some customers lose their id, May 1998 is delivered in both batches, and some lines of the second
batch are repeated within it.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

FIRST_BATCH, SECOND_BATCH = "S1", "S2"
SOURCE_FILE = "retail_lines"
LOADED_AT = datetime(2026, 6, 12)

# First batch ends, second batch starts; between the two the batches overlap.
FIRST_BATCH_END = "1998-06-01"
SECOND_BATCH_START = "1998-05-01"

# The invoice_date window of these tables, end exclusive.
RETAIL_WINDOW = (datetime(1995, 1, 1), datetime(2002, 1, 1))

# Ids grow past the usual widths on large tables, so here the widths are minimums.
RETAIL_INVOICE_PATTERN = r"^C?[0-9]{6,}\z"
RETAIL_CUSTOMER_ID_PATTERN = r"^[0-9]{5,}\z"
RETAIL_PRODUCT_CODE_PATTERN = r"^[0-9]{5,}[A-Za-z]*\z"


#: Lines that one task sorts for a join; more lines take more tasks than the session's number of partitions.
JOINED_LINES = 1_000_000


def _join_parts(lineitem: DataFrame) -> int | None:
    """Partitions of the joins with ``lineitem``, where the session's own number is too small for its rows.

    The rows are counted from the footers of the files.
    """
    parts = -(-lineitem.count() // JOINED_LINES)
    own = int(lineitem.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return parts if parts > own else None


def _padded(number: Column, width: int) -> Column:
    """``number`` as text with at least ``width`` digits; ``lpad`` alone would cut longer numbers."""
    text = number.cast("string")
    return F.lpad(text, F.greatest(F.length(text), F.lit(width)), F.lit("0"))


def raw_lines(spark: SparkSession, tables_dir: str) -> DataFrame:
    """Every order line once, in the raw source columns plus its order key."""
    read = lambda name: spark.read.parquet(f"{tables_dir}/{name}.parquet")
    lineitem = read("lineitem")
    parts = _join_parts(lineitem)

    def dealt(table: DataFrame, key: str) -> DataFrame:
        # The smaller side of a join; the lines follow it, unless it is small enough to be broadcast.
        return table.repartition(parts, key) if parts else table

    nation = read("nation").select("n_nationkey", "n_name").alias("n")
    buyer_nation = (F.col("c_nationkey") + F.col("o_orderkey") % 3) % 25
    # Orders meet their customer before the lines come in; the lines are then shuffled by order and
    # by part only.
    buyers = (
        read("orders")
        .join(dealt(read("customer"), "c_custkey"), F.col("o_custkey") == F.col("c_custkey"))
        # One row per nation, 25 at every scale.
        .join(F.broadcast(nation), F.col("n_nationkey") == buyer_nation)
    )
    lines = (
        lineitem.join(dealt(buyers, "o_orderkey"), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(dealt(read("part"), "p_partkey"), F.col("l_partkey") == F.col("p_partkey"))
    )
    returned = F.col("l_returnflag") == "R"
    part_key = F.col("l_partkey")
    merchandise = F.concat(
        _padded(part_key, 5), F.when(part_key % 7 == 0, "A").otherwise("")
    )
    return lines.select(
        F.concat(F.when(returned, "C").otherwise(""), _padded(F.col("l_orderkey"), 6)).alias("Invoice"),
        F.when(part_key % 40 == 0, "POST").when(part_key % 40 == 1, "M").otherwise(merchandise)
        .alias("StockCode"),
        F.col("p_name").alias("Description"),
        (F.col("l_quantity").cast("bigint") * F.when(returned, -1).otherwise(1)).alias("Quantity"),
        F.col("o_orderdate").alias("InvoiceDate"),
        F.when(part_key % 97 == 0, 0.0).otherwise(F.col("p_retailprice")).alias("Price"),
        F.when(F.col("o_custkey") % 10 != 9, F.col("o_custkey") + 10000).cast("double")
        .alias("Customer ID"),
        F.col("n_name").alias("Country"),
        F.col("l_orderkey").alias("order_key"),
    )


def raw_deliveries(spark: SparkSession, tables_dir: str) -> DataFrame:
    """The raw lines of both batches, each line as often as it is delivered, with its ``batch``.

    Batch names are in text order = time order of their rows.
    """
    date = F.col("InvoiceDate")
    end = F.lit(FIRST_BATCH_END).cast("timestamp_ntz")
    start = F.lit(SECOND_BATCH_START).cast("timestamp_ntz")
    second = F.lit(SECOND_BATCH)
    deliveries = (
        F.when(date < start, F.array(F.lit(FIRST_BATCH)))
        .when(date < end, F.array(F.lit(FIRST_BATCH), second))
        .when(F.col("order_key") % 50 == 0, F.array(second, second))
        .otherwise(F.array(second))
    )
    return (
        raw_lines(spark, tables_dir)
        .withColumn("batch", F.explode(deliveries))
        .drop("order_key")
    )
