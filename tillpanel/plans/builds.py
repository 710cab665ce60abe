"""The three builds. Each is a job of its own and hands over through a published table."""

from __future__ import annotations

import logging
from collections.abc import Iterable, Mapping
from datetime import date, datetime

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from tillpanel.functions.cutoffs import cutoff_date
from tillpanel.operators.contracts import (
    Contract,
    ReadingAudit,
    WritingAudit,
    bronze_contract,
    coerce,
    customer_360_contract,
    silver_contract,
)
from tillpanel.operators.dedup import OVERLAP_FLAG, batch_days, flag_overlap_copies
from tillpanel.operators.panel import customer_panel
from tillpanel.operators.profile import data_dictionary
from tillpanel.operators.silver import (
    accounting_columns,
    clustered_silver,
    non_product_codes,
    row_accounting,
    silver_summary,
    with_derived_columns,
)
from tillpanel.operators.snapshot import customer_360, snapshot_profile, snapshot_slice
from tillpanel.schemas import (
    BRONZE_SCHEMA,
    BRONZE_TABLE,
    CHURN_WINDOW_DAYS,
    CUSTOMER_360_SCHEMA,
    GOLD_TABLE,
    PRODUCT_CODE_PATTERN,
    SILVER_SCHEMA,
    SILVER_TABLE,
    TRAILING_WINDOW_DAYS,
)
from tillpanel.sources.batches import read_batches, refusal, rejected_lines
from tillpanel.storage.layout import DAY_COLUMN
from tillpanel.storage.warehouse import Warehouse

logger = logging.getLogger(__name__)

#: Beside audited lines: whether they go into silver.
KEPT_FLAG = "is_kept"

ACCOUNTING = (
    "bronze_rows",
    "duplicate_rows_dropped",
    "deduped_rows",
    "anonymous_rows_dropped",
    "silver_rows",
)


def _exported(
    warehouse: Warehouse, table: str, path: str | None, frame: DataFrame | None = None
) -> str | None:
    return warehouse.export(table, path, frame) if path else None


def lines_by_day(days: Iterable[Row]) -> dict[date | None, int]:
    """Lines per calendar day, from those per day and batch."""
    total: dict[date | None, int] = {}
    for row in days:
        total[row.day] = total.get(row.day, 0) + row.lines
    return total


def ingest_bronze(
    warehouse: Warehouse, bronze: DataFrame, export_path: str | None = None
) -> tuple[int, str | None]:
    """Replace bronze with the rows of ``read_batches``; gives the row count and the export."""
    rows = warehouse.replace(bronze, BRONZE_TABLE, BRONZE_SCHEMA).count()
    logger.info("%s: %d rows", BRONZE_TABLE, rows)
    return rows, _exported(warehouse, BRONZE_TABLE, export_path)


def ingest_batches(
    warehouse: Warehouse,
    paths: Mapping[str, str],
    loaded_at: datetime,
    source_file: str | None = None,
    file_format: str = "csv",
    export_path: str | None = None,
    **options: str | bool,
) -> tuple[int, str | None]:
    """Replace bronze with the batches at ``paths`` (batch name -> folder).

    A value or line that does not fit refuses the load and leaves bronze as it was; the error names the
    lines. They are looked for only then, so a load that fits reads its batches once.
    """
    spark = warehouse.spark
    bronze = read_batches(spark, paths, loaded_at, source_file, file_format, **options)
    try:
        return ingest_bronze(warehouse, bronze, export_path)
    except PySparkException as error:
        # Lines inside quotes have no number of their own.
        found = None if options.get("multiLine") else refusal(rejected_lines(spark, paths, file_format, **options))
        if found is None:
            raise
        raise found from error


def build_silver(
    warehouse: Warehouse,
    input_contract: Contract | None = None,
    output_contract: Contract | None = None,
    export_path: str | None = None,
    product_code_pattern: str = PRODUCT_CODE_PATTERN,
) -> tuple[DataFrame, str | None]:
    """Replace silver from bronze; a violated contract raises and leaves silver as it was.

    Gives the row accounting, one row, and the export. Rows are counted and both contracts audited in one
    aggregate before anything is written, so a rejected build sorts and writes no lines; the staged silver is
    not read for its rules.
    """
    bronze = warehouse.table(BRONZE_TABLE)
    entry = ReadingAudit(input_contract or bronze_contract(), "bronze_rule")
    audit = ReadingAudit(output_contract or silver_contract(), "silver_rule")

    # One number per calendar day and batch: which days overlap, and which go to which file.
    days = batch_days(bronze).collect()
    by_day = warehouse.spark.createDataFrame(days, "day date, source_sheet string, lines bigint")
    flagged = flag_overlap_copies(bronze, by_day)

    marked = entry.marked(flagged, beside=(OVERLAP_FLAG,))
    beside = (OVERLAP_FLAG, *entry.beside)
    derived = with_derived_columns(marked, product_code_pattern).select(*SILVER_SCHEMA.fieldNames(), *beside)
    kept = ~F.col(OVERLAP_FLAG) & F.col("customer_id").isNotNull()
    marked = audit.marked(derived.withColumn(KEPT_FLAG, kept), beside=(*beside, KEPT_FLAG))
    stays = F.col(KEPT_FLAG)
    counted = marked.agg(*accounting_columns(), *entry.counts(), *audit.counts(stays)).first().asDict()
    rows = {name: counted[name] for name in ACCOUNTING}
    entry.settle(counted, bronze)
    audit.settle(counted)

    lines = coerce(flagged, entry.contract, beside=(OVERLAP_FLAG,))
    silver = clustered_silver(lines, lines_by_day(days), product_code_pattern)
    staged_path = warehouse.stage(coerce(silver, audit.contract, beside=(DAY_COLUMN,)), SILVER_TABLE)
    staged = warehouse.read_staged(staged_path, SILVER_SCHEMA)
    # From the footers of the files.
    if (written := staged.count()) != rows["silver_rows"]:
        raise RuntimeError(f"{written} lines of silver were written, {rows['silver_rows']} audited")
    audit.settle(counted, staged)

    warehouse.publish(staged_path, SILVER_TABLE, SILVER_SCHEMA)
    logger.info("%s: %s", SILVER_TABLE, rows)
    accounting = warehouse.spark.createDataFrame([tuple(rows[name] for name in ACCOUNTING)], list(ACCOUNTING))
    return accounting, _exported(warehouse, SILVER_TABLE, export_path)


def build_customer_360(
    warehouse: Warehouse,
    as_of: str | date,
    churn_window_days: int = CHURN_WINDOW_DAYS,
    trailing_days: int = TRAILING_WINDOW_DAYS,
    contract: Contract | None = None,
    export_path: str | None = None,
) -> tuple[int, str | None]:
    """Replace one cutoff of the panel; a violated contract raises and leaves the panel as it was.

    Gives the number of customers and the export, which holds the new slice.
    """
    day = cutoff_date(as_of)
    silver = warehouse.dated_table(SILVER_TABLE)
    snapshot = customer_360(silver, day, churn_window_days, trailing_days)

    audit = WritingAudit(contract or customer_360_contract())
    path = warehouse.stage(audit.watched(snapshot).drop("as_of_date"), GOLD_TABLE)
    staged = _staged_slice(warehouse, path, day)
    audit.settle(staged)
    rows = audit.rows

    warehouse.publish_slice(path, day, CUSTOMER_360_SCHEMA)
    logger.info("%s at %s: %d rows", GOLD_TABLE, day, rows)
    return rows, _exported(warehouse, GOLD_TABLE, export_path, staged)


def _staged_slice(warehouse: Warehouse, path: str, as_of: date) -> DataFrame:
    """A staged slice with its cutoff put back."""
    names = CUSTOMER_360_SCHEMA.fieldNames()
    stored = type(CUSTOMER_360_SCHEMA)([f for f in CUSTOMER_360_SCHEMA if f.name != "as_of_date"])
    return (
        warehouse.read_staged(path, stored).withColumn("as_of_date", F.lit(as_of)).select(names)
    )


def backfill_customer_360(
    warehouse: Warehouse,
    cutoffs: Iterable[str | date],
    churn_window_days: int = CHURN_WINDOW_DAYS,
    trailing_days: int = TRAILING_WINDOW_DAYS,
    contract: Contract | None = None,
) -> dict[date, int]:
    """Replace many cutoffs of the panel from one pass over silver; gives the customers of each.

    All slices are audited and then published together: readers have all new cutoffs or none of them.
    """
    days = sorted({cutoff_date(c) for c in cutoffs})
    panel = customer_panel(
        warehouse.dated_table(SILVER_TABLE), days, churn_window_days, trailing_days
    )
    audit = WritingAudit(contract or customer_360_contract())
    root, paths = warehouse.stage_slices(audit.watched(panel), days, GOLD_TABLE)
    staged = warehouse.read_staged(root, CUSTOMER_360_SCHEMA)
    audit.settle(staged)
    # One number per cutoff.
    rows = {r.as_of_date: r["count"] for r in staged.groupBy("as_of_date").count().collect()}

    warehouse.publish_slices(paths, CUSTOMER_360_SCHEMA)
    return {day: rows.get(day, 0) for day in days}


# ---- reports, as frames -------------------------------------------------------------------------


def data_quality_report(warehouse: Warehouse) -> dict[str, DataFrame]:
    bronze, silver = warehouse.table(BRONZE_TABLE), warehouse.table(SILVER_TABLE)
    return {
        "row_accounting": row_accounting(bronze),
        "silver_summary": silver_summary(silver),
        "non_product_codes": non_product_codes(silver),
    }


def snapshot_report(
    warehouse: Warehouse, as_of: str | date, churn_window_days: int = CHURN_WINDOW_DAYS
) -> DataFrame:
    return snapshot_profile(snapshot_slice(warehouse.table(GOLD_TABLE), as_of), churn_window_days)


def dictionary_report(warehouse: Warehouse) -> DataFrame:
    return data_dictionary(warehouse.tables())
