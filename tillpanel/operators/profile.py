"""Column profiles and the data dictionary.

Distinct counts of many columns in one aggregate copy every row once per column and keep all the
column's values in one grouping. Here each row is turned into one (column, value) pair per column and
equal pairs are folded before the shuffle, so a value that fills a third of the table costs one row
per task; counting the folded pairs then gives distinct and null counts, and their smallest and largest
values the bounds, all from one read.

Values keep their types on the way. Whole numbers, dates and flags are folded further, 64 neighbours to
a row: a 64-bit word has a bit for each value seen, and the set bits are counted in the end. Dense
numbers such as ids then shuffle a row for 64 of them, sparse ones a row each as before.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillpanel.functions.money import double_text
from tillpanel.schemas import BRONZE_TABLE, GOLD_TABLE, SILVER_TABLE

# Names under which types appear in the dictionary.
TYPE_NAMES = {
    "string": "VARCHAR",
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
    "date": "DATE",
}

TABLE_DESCRIPTIONS = {
    BRONZE_TABLE: "Invoice lines as delivered, one row per line, with their lineage; nothing removed.",
    SILVER_TABLE: "Invoice lines of known customers without the overlap between batches, "
    "with revenue and flags; published only when its contract holds.",
    GOLD_TABLE: "One row per customer and cutoff date, from lines strictly before the cutoff.",
}

_LINE_DESCRIPTIONS = {
    "invoice": "Number printed on the invoice; those of cancellations begin with 'C'.",
    "stock_code": "Code of the article or service.",
    "description": "Name of the article.",
    "quantity": "Units on the line; negative on cancellations.",
    "invoice_date": "Time of the invoice.",
    "unit_price": "Price of one unit, in GBP.",
    "customer_id": "Who bought, as text; not known for anonymous sales.",
    "country": "Country of the customer.",
    "source_file": "Lineage: name of the delivered file.",
    "source_sheet": "Lineage: name of the batch.",
    "loaded_at": "Lineage: time of the load, UTC.",
}

COLUMN_DESCRIPTIONS = {
    BRONZE_TABLE: _LINE_DESCRIPTIONS,
    SILVER_TABLE: _LINE_DESCRIPTIONS
    | {
        "customer_id": "Who bought, as text; known on every line of this table.",
        "line_revenue": "Value of the line: units times price of one; below zero when goods come back.",
        "is_cancellation": "True on lines of cancellation invoices.",
        "is_product": "Whether the stock code is merchandise rather than a service or adjustment.",
    },
    GOLD_TABLE: {
        "customer_id": "The customer the row is about.",
        "as_of_date": "Cutoff; only earlier lines count.",
        "first_purchase_date": "Date of the first line of any kind; tenure starts here.",
        "last_activity_date": "Date of the last line of any kind; recency starts here.",
        "last_purchase_date": "Date of the last product line with a positive quantity; "
        "null without one.",
        "recency_days": "Days from last_activity_date to the cutoff.",
        "tenure_days": "Days from first_purchase_date to the cutoff.",
        "order_count": "How many different sales invoices the customer had.",
        "cancelled_order_count": "How many different cancellation invoices the customer had.",
        "total_net_revenue": "Product revenue to date, net of cancellations.",
        "trailing_12m_net_revenue": "Product revenue of the trailing window.",
        "cancelled_revenue": "Revenue of all cancelled lines; never positive.",
        "run_rate_90d": "Product revenue expected over the run-rate horizon.",
        "country": "Country of the latest line before the cutoff.",
    },
}


def type_name(dtype: T.DataType) -> str:
    return TYPE_NAMES.get(dtype.simpleString(), dtype.simpleString().upper())


_WHOLE = (T.LongType, T.IntegerType, T.ShortType, T.ByteType, T.BooleanType, T.DateType)
_EPOCH = date(1970, 1, 1)


def _kind(dtype: T.DataType) -> str:
    """The field of a pair that holds values of this type."""
    if isinstance(dtype, _WHOLE):
        return "whole"
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return "real"
    return "at" if isinstance(dtype, T.TimestampNTZType) else "text"


def _value(column: Column, dtype: T.DataType) -> Column:
    """The value as its field holds it."""
    if isinstance(dtype, T.DateType):
        return F.unix_date(column).cast("bigint")
    if isinstance(dtype, T.BooleanType):
        return column.cast("int").cast("bigint")
    kinds = {"whole": "bigint", "real": "double", "at": "timestamp_ntz", "text": "string"}
    return column.cast(kinds[_kind(dtype)])


def _text(value: Column, dtype: T.DataType) -> Column:
    """A value in its field as text."""
    if isinstance(dtype, T.DateType):
        return F.date_add(F.lit(_EPOCH), value.cast("int")).cast("string")
    if isinstance(dtype, T.BooleanType):
        return (value == 1).cast("string")
    return double_text(value) if _kind(dtype) == "real" else value.cast("string")


def column_profile(frame: DataFrame) -> DataFrame:
    """One row per column: position, name, type, nulls, distinct values, minimum and maximum."""
    fields = list(enumerate(frame.schema.fields, start=1))
    types = {"whole": "bigint", "real": "double", "at": "timestamp_ntz", "text": "string"}

    def pair(i, f):
        value = _value(F.col(f"`{f.name}`"), f.dataType)
        held = [(value if _kind(f.dataType) == k else F.lit(None)).cast(t).alias(k) for k, t in types.items()]
        return F.struct(F.lit(i).alias("ordinal_position"), *held)

    pairs = frame.select(F.inline(F.array(*[pair(i, f) for i, f in fields])))
    word, bit = F.shiftright("whole", 6).alias("word"), F.expr("shiftleft(1L, CAST(whole & 63 AS INT))")
    folded = pairs.groupBy("ordinal_position", word, "real", "at", "text").agg(
        F.count("*").alias("copies"), F.bit_or(bit).alias("bits"),
        F.min("whole").alias("least"), F.max("whole").alias("most"),
    )
    is_null = F.coalesce(F.col("word").cast("string"), F.col("real").cast("string"), F.col("at").cast("string"), "text").isNull()
    counts = folded.groupBy("ordinal_position").agg(
        F.sum(F.when(is_null, F.col("copies")).otherwise(0)).alias("nulls"),
        F.sum(F.when(F.col("word").isNotNull(), F.bit_count("bits")).when(is_null, 0).otherwise(1)).alias("distinct_values"),
        F.min("least").alias("min_whole"), F.max("most").alias("max_whole"),
        *[agg(k).alias(f"{name}_{k}") for k in ("real", "at", "text") for name, agg in (("min", F.min), ("max", F.max))],
    )

    def bound(name):
        """The bound of each column, by its type."""
        chosen = F.lit(None).cast("string")
        for i, f in fields:
            text = _text(F.col(f"{name}_{_kind(f.dataType)}"), f.dataType)
            chosen = F.when(F.col("ordinal_position") == i, text).otherwise(chosen)
        return chosen.alias(f"{name}_value")

    # One row per column, also where the table has no rows.
    named = F.array(*[
        F.struct(F.lit(i).alias("ordinal_position"), F.lit(f.name).alias("column_name"),
                 F.lit(type_name(f.dataType)).alias("data_type"))
        for i, f in fields
    ])
    columns = frame.sparkSession.range(1).select(F.inline(named))
    return columns.join(F.broadcast(counts), "ordinal_position", "left").select(
        "ordinal_position", "column_name", "data_type",
        F.coalesce("nulls", F.lit(0).cast("bigint")).alias("nulls"),
        F.coalesce("distinct_values", F.lit(0).cast("bigint")).alias("distinct_values"),
        bound("min"), bound("max"),
    )


def data_dictionary(tables: Mapping[str, DataFrame]) -> DataFrame:
    """The profiles of ``tables`` (qualified name -> frame) with the registered descriptions."""

    def described(table: str, frame: DataFrame) -> DataFrame:
        texts = COLUMN_DESCRIPTIONS.get(table, {})
        pairs = [F.lit(part) for pair in texts.items() for part in pair]
        text = F.create_map(*pairs)[F.col("column_name")] if pairs else F.lit("")
        return column_profile(frame).select(
            F.lit(table).alias("table_name"), "*", F.coalesce(text, F.lit("")).alias("description")
        )

    return reduce(DataFrame.unionByName, (described(t, f) for t, f in tables.items()))


def table_inventory(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per table: layer, name, number of columns, rows, and its registered description."""

    def counted(table: str, frame: DataFrame) -> DataFrame:
        layer, _, name = table.partition(".")
        return frame.agg(F.count("*").alias("rows")).select(
            F.lit(layer).alias("table_schema"),
            F.lit(name).alias("table_name"),
            F.lit(len(frame.columns)).alias("columns"),
            "rows",
            F.lit(TABLE_DESCRIPTIONS.get(table, "")).alias("description"),
        )

    return reduce(DataFrame.unionByName, (counted(t, f) for t, f in tables.items()))
