"""Silver: cleaned invoice lines with derived columns, and the facts of the data-quality report."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillpanel.functions.money import exact_sum, money, money_sum
from tillpanel.operators.dedup import OVERLAP_FLAG, flag_overlap_copies
from tillpanel.schemas import PRODUCT_CODE_PATTERN, SILVER_SCHEMA
from tillpanel.storage.layout import DAY_COLUMN, clustered_by_date


def line_revenue() -> Column:
    return F.col("quantity") * F.col("unit_price")


def is_cancellation() -> Column:
    return F.col("invoice").startswith("C")


def is_product(product_code_pattern: str = PRODUCT_CODE_PATTERN) -> Column:
    return F.col("stock_code").rlike(product_code_pattern)


def drop_anonymous(lines: DataFrame) -> DataFrame:
    """Lines of known customers only."""
    return lines.filter(F.col("customer_id").isNotNull())


def with_derived_columns(
    lines: DataFrame, product_code_pattern: str = PRODUCT_CODE_PATTERN
) -> DataFrame:
    return lines.withColumns(
        {
            "line_revenue": line_revenue(),
            "is_cancellation": is_cancellation(),
            "is_product": is_product(product_code_pattern),
        }
    )


def cleaned_lines(flagged: DataFrame) -> DataFrame:
    """The lines of silver, without its derived columns: overlap dropped first, then anonymous lines."""
    return drop_anonymous(flagged.filter(~F.col(OVERLAP_FLAG))).drop(OVERLAP_FLAG)


def silver_of_flagged(
    flagged: DataFrame, product_code_pattern: str = PRODUCT_CODE_PATTERN
) -> DataFrame:
    """The silver table: lines dropped first, then columns derived."""
    return with_derived_columns(cleaned_lines(flagged), product_code_pattern).select(SILVER_SCHEMA.fieldNames())


def clustered_silver(
    flagged: DataFrame, lines_by_day: dict[date | None, int], product_code_pattern: str = PRODUCT_CODE_PATTERN
) -> DataFrame:
    """Silver and the day of its rows, laid out by date; columns are derived behind the shuffle."""
    placed = clustered_by_date(cleaned_lines(flagged), lines_by_day)
    return with_derived_columns(placed, product_code_pattern).select(*SILVER_SCHEMA.fieldNames(), DAY_COLUMN)


def silver_lines(bronze: DataFrame, product_code_pattern: str = PRODUCT_CODE_PATTERN) -> DataFrame:
    """The silver table from bronze."""
    return silver_of_flagged(flag_overlap_copies(bronze), product_code_pattern)


def accounting_columns() -> list[Column]:
    """Where every flagged bronze row goes on its way to silver, as aggregates."""
    dropped = F.col(OVERLAP_FLAG)
    anonymous = F.col("customer_id").isNull()
    return [
        F.count("*").alias("bronze_rows"),
        F.count_if(dropped).alias("duplicate_rows_dropped"),
        F.count_if(~dropped).alias("deduped_rows"),
        F.count_if(~dropped & anonymous).alias("anonymous_rows_dropped"),
        F.count_if(~dropped & ~anonymous).alias("silver_rows"),
    ]


def row_accounting(bronze: DataFrame) -> DataFrame:
    """One row: where every bronze row went on its way to silver."""
    return flag_overlap_copies(bronze).agg(*accounting_columns())


def silver_summary(silver: DataFrame) -> DataFrame:
    """One row of totals.

    Lines are first collapsed to one row per customer and invoice. The two distinct counts then
    multiply these few rows, not the lines, and a hot invoice is folded before the shuffle.
    """
    per_invoice = silver.groupBy("customer_id", "invoice").agg(
        F.min("invoice_date").alias("first_date"),
        F.max("invoice_date").alias("last_date"),
        F.count_if("is_cancellation").alias("cancelled"),
        F.count_if(~F.col("is_product")).alias("non_product"),
        F.count_if(F.col("unit_price") == 0).alias("zero_price"),
        exact_sum(F.col("line_revenue"), F.col("is_product")).alias("revenue"),
    )

    def total(column: str) -> Column:
        return F.coalesce(F.sum(column), F.lit(0))

    return per_invoice.agg(
        F.count_distinct("customer_id").alias("customers"),
        F.count_distinct("invoice").alias("invoices"),
        F.min("first_date").alias("first_invoice_date"),
        F.max("last_date").alias("last_invoice_date"),
        total("cancelled").alias("cancellation_lines"),
        total("non_product").alias("non_product_lines"),
        total("zero_price").alias("zero_price_lines"),
        money(money_sum(F.col("revenue"))).alias("net_product_revenue"),
    )


def non_product_codes(silver: DataFrame) -> DataFrame:
    """Service and adjustment codes, largest absolute revenue first."""
    return (
        silver.filter(~F.col("is_product"))
        .groupBy("stock_code")
        .agg(F.count("*").alias("lines"), exact_sum(F.col("line_revenue")).alias("revenue"))
        .orderBy(F.abs("revenue").desc(), "stock_code")
        .select("stock_code", "lines", money(F.col("revenue")).alias("net_line_revenue"))
    )
