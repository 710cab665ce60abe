"""Cross-batch deduplication of identical invoice lines.

Identical lines keep every copy of the earliest batch that holds them (text order of the batch
name); the copies in later batches are overlap and go. Nulls compare equal, and so do -0.0 and 0.0,
which comes out for both on the days that batches share.

The textbook form is ``min(source_sheet)`` over a window of all eight line columns. It shuffles and
sorts every row, and puts all copies of one line into one task. Here:

1. Identical lines share their date, so only days delivered by several batches can hold overlap. One
   small aggregate (a row per day and batch) finds those days, and they are broadcast, one row per
   calendar day. Lines of all other days pass where they are.
2. Lines of these days are folded to one row per distinct bronze row with the number of its copies,
   before the shuffle. The window over the eight columns then holds a few rows per line, however often
   the line occurs, and nothing is looked up in a second read of the lines.
3. Rows are unfolded again in lots of at most ``LOT`` copies, each lot in a task of its own: a line
   that fills a third of bronze is spread over as many tasks as its copies ask for.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillpanel.schemas import LINE_COLUMNS

OVERLAP_FLAG = "is_overlap_copy"
#: Copies of a row that are unfolded in one task.
LOT = 100_000


def _day() -> Column:
    return F.col("invoice_date").cast("date")


def _sheet() -> Column:
    """Batches in text order; rows without a batch come first."""
    return F.struct(F.col("source_sheet").isNotNull().alias("named"), F.col("source_sheet").alias("sheet"))


def batch_days(bronze: DataFrame) -> DataFrame:
    """(day, source_sheet, lines): one row per calendar day and batch."""
    return bronze.groupBy(_day().alias("day"), "source_sheet").agg(F.count("*").alias("lines"))


def shared_days(by_day: DataFrame) -> DataFrame:
    """Days that several batches deliver: one row per calendar day."""
    return (
        by_day.groupBy(F.col("day").alias("shared_day"))
        .agg(F.min(_sheet()).alias("first"), F.max(_sheet()).alias("last"))
        .filter("first <> last").select("shared_day")
    )


def _near(bronze: DataFrame, days: DataFrame) -> DataFrame:
    """Lines dated from the first to the last shared day, and undated ones, in one scan."""
    date = F.col("invoice_date")
    first = days.select(F.min("shared_day").cast("timestamp_ntz")).scalar()
    last_day = days.orderBy(F.desc("shared_day")).limit(1)
    end = last_day.select(F.date_add("shared_day", 1).cast("timestamp_ntz")).scalar()
    # Each bound by itself, so that both reach the scan beside the test for null.
    return bronze.filter(date.isNull() | (date >= first)).filter(date.isNull() | (date < end))


def _on_days(lines: DataFrame, days: DataFrame, how: str) -> DataFrame:
    return lines.join(F.broadcast(days), F.col("shared_day").eqNullSafe(_day()), how)


def _unfolded(folded: DataFrame, copies: str) -> DataFrame:
    """Every row as often as ``copies`` says, in lots of at most ``LOT``."""
    of_row = [F.col(c) for c in folded.columns if c != copies]
    lots = folded.select(
        *of_row, copies, F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"({copies} - 1) div {LOT}"))).alias("lot")
    ).withColumn("held", F.least(F.lit(LOT).cast("long"), F.col(copies) - F.col("lot") * LOT))
    # A hash of the whole row and the lot: rows of one line and lots of one row go different ways. With a
    # given number of partitions, because lots are small and would be put together again for their size.
    partitions = int(folded.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = lots.repartition(partitions, F.xxhash64(*of_row, "lot"))
    return dealt.select(*of_row, F.explode(F.sequence(F.lit(1).cast("long"), F.col("held"))).alias("lot")).drop("lot")


def flag_overlap_copies(bronze: DataFrame, by_day: DataFrame | None = None) -> DataFrame:
    """``bronze`` with a flag on the lines that an earlier batch already holds.

    ``by_day`` is what ``batch_days`` gives, where it is there already.
    """
    columns = bronze.columns
    days = shared_days(batch_days(bronze) if by_day is None else by_day)
    settled = _on_days(bronze, days, "left_anti").select(*columns, F.lit(False).alias(OVERLAP_FLAG))

    near = _on_days(_near(bronze, days), days, "left_semi")
    folded = near.groupBy(*columns).agg(F.count("*").alias("line_copies"))
    first = F.min(_sheet()).over(Window.partitionBy(*LINE_COLUMNS))
    flagged = folded.select("*", (_sheet() != first).alias(OVERLAP_FLAG))
    return settled.unionByName(_unfolded(flagged, "line_copies"))


def drop_overlap_copies(bronze: DataFrame) -> DataFrame:
    """Bronze without the lines that an earlier batch already holds."""
    return flag_overlap_copies(bronze).filter(~F.col(OVERLAP_FLAG)).drop(OVERLAP_FLAG)
