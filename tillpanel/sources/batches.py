"""Raw invoice-line batches to the bronze shape: verbatim rows plus lineage.

A batch is one folder (or file) of CSV or Parquet with the eight source columns. Nothing is cleaned
here. The whole load is narrow: no shuffle, one pass over every batch.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from datetime import datetime
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillpanel.functions.casting import no_whole_number, strict_cast, uncastable, whole_number_text
from tillpanel.schemas import BRONZE_SCHEMA, SOURCE_COLUMNS

# Column for the text of a line that does not have the fields of its header.
MALFORMED = "malformed_line"
CSV_OPTIONS = {
    "header": True,
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
    "escape": '"',
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": MALFORMED,
}
#: Rejected lines that an error lists.
SHOWN = 20

# Fixed value: where the public retail workbook can be downloaded.
SOURCE_URL = "https://archive.ics.uci.edu/dataset/502/online+retail+ii"


def read_batch(
    spark: SparkSession, path: str, file_format: str = "csv", **options: str | bool
) -> DataFrame:
    """Read one raw batch, every CSV value as untouched text.

    A CSV line that has not as many fields as the header comes with its text in ``MALFORMED``; it fails
    the load. Pass ``multiLine=True`` for CSV with line breaks inside quotes; such files cannot be split.
    """
    reader = spark.read
    if file_format == "csv":
        # No schema is given: a given schema would silently drop a surplus column.
        reader = reader.options(inferSchema=False, **CSV_OPTIONS)
    try:
        raw = reader.options(**options).format(file_format).load(path)
        # The names are known now, and that there are no others.
        return raw if file_format != "csv" else reader.schema(_text_schema(raw.columns)).load(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        raise FileNotFoundError(
            f"no source batch at {path}; the retail data can be downloaded from {SOURCE_URL}"
        ) from error


def _text_schema(columns: Iterable[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in (*columns, MALFORMED)])


def check_source_columns(columns: Iterable[str], batch: str) -> None:
    """Raise unless a batch has exactly the source columns, in any order."""
    present, expected = set(columns) - {MALFORMED}, set(SOURCE_COLUMNS)
    if present != expected:
        raise ValueError(
            f"batch {batch!r} has unexpected columns: "
            f"missing={sorted(expected - present)}, extra={sorted(present - expected)}"
        )


def rename_source_columns(raw: DataFrame) -> DataFrame:
    return raw.withColumnsRenamed(SOURCE_COLUMNS)


def with_customer_id_text(batch: DataFrame) -> DataFrame:
    """Customer ids are text everywhere; the source may hold them as floats."""
    dtype = dict(batch.dtypes)["customer_id"]
    return batch.withColumn(
        "customer_id", whole_number_text(F.col("customer_id"), dtype, "customer_id")
    )


def _bronze_shape(
    raw: DataFrame, batch: Column, source_file: Column | str, loaded_at: datetime
) -> DataFrame:
    """Checked raw lines in the bronze columns and types, with their lineage."""
    file_name = F.lit(source_file) if isinstance(source_file, str) else source_file
    lineage = {
        "source_file": file_name,
        "source_sheet": batch,
        "loaded_at": F.lit(loaded_at.isoformat(sep=" ")),
    }
    if MALFORMED in raw.columns:
        complaint = F.raise_error(F.concat(F.lit("malformed line: "), MALFORMED)).cast("string")
        # Beside a column that every load reads.
        raw = raw.withColumn("Invoice", F.when(F.col(MALFORMED).isNotNull(), complaint).otherwise(F.col("Invoice")))
    return typed_bronze(with_customer_id_text(rename_source_columns(raw.withColumns(lineage))))


def bronze_batch(raw: DataFrame, batch: str, source_file: Column | str, loaded_at: datetime) -> DataFrame:
    """One checked batch in the bronze shape, with its lineage."""
    check_source_columns(raw.columns, batch)
    return _bronze_shape(raw, F.lit(batch), source_file, loaded_at)


def typed_bronze(frame: DataFrame) -> DataFrame:
    """Project to the bronze columns and types; a value that does not fit fails the load."""
    have = dict(frame.dtypes)

    def typed(name: str, dtype: str) -> Column:
        column = F.col(name)
        return column if have[name] == dtype else strict_cast(column, dtype, name).alias(name)

    return frame.select([typed(f.name, f.dataType.simpleString()) for f in BRONZE_SCHEMA])


def union_batches(batches: Iterable[DataFrame]) -> DataFrame:
    """Bag union: repeated rows, and the overlap between batches, are kept."""
    return reduce(DataFrame.unionByName, batches)


def bronze_from_deliveries(raw: DataFrame, source_file: str, loaded_at: datetime) -> DataFrame:
    """Bronze rows of several batches in one DataFrame that names each line's ``batch``.

    The batches are read in one pass; their union needs no second one.
    """
    check_source_columns([c for c in raw.columns if c != "batch"], "all batches")
    return _bronze_shape(raw, F.col("batch"), source_file, loaded_at)


def read_batches(
    spark: SparkSession,
    paths: Mapping[str, str],
    loaded_at: datetime,
    source_file: str | None = None,
    file_format: str = "csv",
    **options: str | bool,
) -> DataFrame:
    """Bronze rows of the batches at ``paths`` (batch name -> folder).

    ``source_file`` is the name of the delivered source; left out, each row names the file it was
    read from.
    """
    return union_batches(
        bronze_batch(
            read_batch(spark, path, file_format, **options),
            name,
            source_file or F.col("_metadata.file_name"),
            loaded_at,
        )
        for name, path in paths.items()
    )


# ---- what a load failed on -----------------------------------------------------------------------


class RejectedLines(ValueError):
    """A load that was refused; ``lines`` holds the first (batch, file, line number, problem, line)."""

    def __init__(self, lines: list[tuple], total: int):
        self.lines, self.total = lines, total
        listed = "\n".join(f"{file}:{number} ({batch}): {problem}: {line}" for batch, file, number, problem, line in lines)
        super().__init__(f"{total} lines cannot be loaded:\n{listed}")


def _problem(dtypes: Mapping[str, str]) -> Column:
    """What keeps a raw line from the bronze types; null where nothing does."""
    problems = []
    for source, name in SOURCE_COLUMNS.items():
        value, dtype = F.col(f"`{source}`"), BRONZE_SCHEMA[name].dataType.simpleString()
        if name == "customer_id":
            bad, wanted = no_whole_number(value, dtypes[source]), "whole number"
        else:
            bad, wanted = uncastable(value, dtype), dtype
        problems.append(F.when(bad, F.concat(F.lit(f"{source}: no {wanted} in "), value.cast("string"))))
    return F.coalesce(*problems)


def _numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """The lines of text files with their numbers, from 1 in each file.

    A file is read in blocks, by many tasks; a line's number is its place in the block after the lines of
    the blocks before.
    """
    lines = spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("id"),
    )
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = lines.groupBy("file", "block").agg(F.min("id").alias("first"), F.count("*").alias("lines"))
    before = blocks.select("file", "block", "first", F.coalesce(F.sum("lines").over(earlier), F.lit(0)).alias("before"))
    return lines.join(before, ["file", "block"]).select(
        "file", (F.col("before") + F.col("id") - F.col("first") + 1).alias("line_number"), F.col("value").alias("line")
    )


def rejected_lines(
    spark: SparkSession, paths: Mapping[str, str], file_format: str = "csv", **options: str | bool
) -> DataFrame:
    """(batch, file, line_number, problem, line) of every line that keeps a load from its types.

    Line numbers are those of the files, their headers counted; of Parquet, rows from 1.
    """

    def of_batch(batch: str, path: str) -> DataFrame:
        raw = read_batch(spark, path, file_format, **options)
        if file_format == "csv":
            columns = [c for c in raw.columns if c != MALFORMED]
            schema = ", ".join(f"`{c}` STRING" for c in (*columns, MALFORMED))
            parser = {k: str(v).lower() if isinstance(v, bool) else v for k, v in (CSV_OPTIONS | options).items()}
            lines = (
                _numbered_lines(spark, path).filter("line_number > 1 AND line <> ''")
                .select("*", F.from_csv("line", schema, parser).alias("parsed"))
                .select("file", "line_number", "line", "parsed.*")
            )
            malformed = F.when(F.col(MALFORMED).isNotNull(), F.lit(f"not {len(columns)} fields"))
            problem = F.coalesce(malformed, _problem(dict(raw.dtypes)))
        else:
            lines = raw.select(
                F.col("_metadata.file_path").alias("file"), (F.col("_metadata.row_index") + 1).alias("line_number"),
                F.to_json(F.struct("*")).alias("line"), "*",
            )
            problem = _problem(dict(raw.dtypes))
        return lines.select(F.lit(batch).alias("batch"), "file", "line_number", problem.alias("problem"), "line").filter(
            "problem IS NOT NULL"
        )

    return reduce(DataFrame.unionByName, (of_batch(batch, path) for batch, path in paths.items()))


def refusal(lines: DataFrame) -> RejectedLines | None:
    """The error for rejected lines, which lists the first of them; none if there are none."""
    total = lines.count()
    first = lines.orderBy("batch", "file", "line_number").limit(SHOWN).collect()
    return RejectedLines([tuple(r) for r in first], total) if total else None
