"""Where the rows of a table go in its files.

The silver table is read by date: every snapshot asks for the lines before a cutoff. Its files hold
neighbouring days, and rows are sorted by date in them, so the smallest and largest day that Parquet keeps
per file and row group rule out the rest of the table. Spark compares these for dates but not for
timestamps without a time zone, so the files hold the day in a column of its own beside the table's; only
``dated`` reads it. (Files by customer would spare the folds of a
snapshot one small shuffle, as lines are folded before it; but one customer may have a third of
all lines, who would then be one file, written and read by one task.)

The days are dealt out from their known numbers of lines, so nothing is sampled and nothing computed
twice. A day with more lines than a file should hold has several files; its lines are spread over
these by the task they come from, so that copies of one line need not stay together.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

DAY_COLUMN = "invoice_day"
#: Lines of a file on large and on small tables. A file's lines are sorted by one task, some 250 bytes a line.
MOST_LINES, LEAST_LINES = 1_000_000, 20_000


def dealt_days(lines_by_day: dict[date | None, int], lines_per_file: int) -> list[tuple[date | None, int, int]]:
    """(day, first file, number of files): days in order, undated lines first."""
    dealt, number, held = [], 0, 0
    for day in sorted(lines_by_day, key=lambda d: (d is not None, d)):
        lines = lines_by_day[day]
        if lines > lines_per_file:
            number += held > 0
            files = -(-lines // lines_per_file)
            dealt.append((day, number, files))
            number, held = number + files, 0
            continue
        if held + lines > lines_per_file:
            number, held = number + 1, 0
        dealt.append((day, number, 1))
        held += lines
    return dealt


def clustered_by_date(lines: DataFrame, lines_by_day: dict[date | None, int], column: str = "invoice_date") -> DataFrame:
    """``lines`` and their day, with neighbouring days together, to be written as one file per partition.

    Days that are not in ``lines_by_day`` go to the first file; their place changes nothing but the
    files that a reader can skip.
    """
    spark = lines.sparkSession
    total = sum(lines_by_day.values())
    share = -(-total // int(spark.conf.get("spark.sql.shuffle.partitions")))
    dealt = dealt_days(lines_by_day, min(MOST_LINES, max(LEAST_LINES, share)))
    if not dealt:
        return lines.withColumn(DAY_COLUMN, F.col(column).cast("date"))
    # One row per calendar day.
    files = F.broadcast(spark.createDataFrame(dealt, "dealt_day date, first_file int, day_files int"))
    spread = F.pmod(F.xxhash64(F.spark_partition_id(), column), F.col("day_files")).cast("int")
    file = F.coalesce(F.col("first_file") + spread, F.lit(0))
    number = 1 + max(first + n - 1 for _, first, n in dealt)
    placed = lines.join(files, F.col(column).cast("date").eqNullSafe(F.col("dealt_day")), "left")
    return (
        placed.withColumn("dealt_file", file).repartitionById(number, F.col("dealt_file"))
        .select(*lines.columns, F.col(column).cast("date").alias(DAY_COLUMN)).sortWithinPartitions(column)
    )


def dated(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A stored table with the day of its rows; files that do not hold it give none."""
    with_day = T.StructType([*schema, T.StructField(DAY_COLUMN, T.DateType())])
    return spark.read.schema(with_day).parquet(path)


def before_day(lines: DataFrame, day: date) -> DataFrame:
    """Leaves out files of later days, where the day is known, and drops the column."""
    if DAY_COLUMN not in lines.columns:
        return lines
    known = F.col(DAY_COLUMN)
    return lines.filter(known.isNull() | (known < F.lit(day))).drop(DAY_COLUMN)
