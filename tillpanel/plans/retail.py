"""The registered queries: every operator over the retail lines of the order tables.

Bronze and silver are derived from the given tables once per session and written to the shared folder,
as the builds would leave them; the queries read these tables. The operators that make a layer run from
the layer below, so no query skips the work it is named for.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import cache
from threading import Lock

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillpanel.functions.cutoffs import cutoff_date
from tillpanel.operators import contracts, dedup, panel, profile, silver, snapshot
from tillpanel.plans import builds
from tillpanel.schemas import (
    BRONZE_SCHEMA,
    BRONZE_TABLE,
    CUSTOMER_360_SCHEMA,
    GOLD_TABLE,
    SILVER_SCHEMA,
    SILVER_TABLE,
)
from tillpanel.sources import batches, retail_tables
from tillpanel.storage.layout import dated
from tillpanel.storage.shared import new_folder, remove_folder
from tillpanel.storage.warehouse import Warehouse

Query = Callable[[SparkSession, str], DataFrame]

# Thin history with nulls, mid history, full history.
EARLY, MIDDLE, LATE = "1995-03-01", "1998-06-01", "2001-01-01"


class RetailLayers:
    """Bronze and silver of one folder of order tables, each written when first asked for."""

    def __init__(self, spark: SparkSession, tables_dir: str):
        self.spark, self.tables_dir = spark, tables_dir
        self.folder = new_folder(spark, "layers")
        self._lock = Lock()
        self._written: set[str] = set()

    def derived_bronze(self) -> DataFrame:
        return batches.bronze_from_deliveries(
            retail_tables.raw_deliveries(self.spark, self.tables_dir),
            retail_tables.SOURCE_FILE,
            retail_tables.LOADED_AT,
        )

    def path(self, layer: str) -> str:
        return f"{self.folder}/{layer}"

    def _stored(self, layer: str, derive: Callable[[], DataFrame], schema) -> DataFrame:
        if layer not in self._written:
            derive().write.mode("overwrite").parquet(self.path(layer))
            self._written.add(layer)
        return self.spark.read.schema(schema).parquet(self.path(layer))

    def _bronze(self) -> DataFrame:
        return self._stored("bronze", self.derived_bronze, BRONZE_SCHEMA)

    def bronze(self) -> DataFrame:
        with self._lock:
            return self._bronze()

    def silver(self) -> DataFrame:
        with self._lock:
            return self._stored(
                "silver", lambda: clustered_silver(self._bronze()), SILVER_SCHEMA
            )


    def dated_silver(self) -> DataFrame:
        """Silver with the day of its rows, for what is read up to a cutoff."""
        self.silver()
        return dated(self.spark, self.path("silver"), SILVER_SCHEMA)


SOURCE_TABLES = ("lineitem", "orders", "customer", "part", "nation")


def _source_state(spark: SparkSession, tables_dir: str) -> tuple:
    """Sizes and times of the source files: layers are derived anew when these change."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    found = []
    for name in SOURCE_TABLES:
        path = hadoop.Path(f"{tables_dir}/{name}.parquet")
        files = path.getFileSystem(spark._jsc.hadoopConfiguration())
        for status in files.listStatus(path):
            found.append((name, status.getPath().getName(), status.getLen(), status.getModificationTime()))
    return tuple(sorted(found))


@cache
def _layers_of(application: str, tables_dir: str, state: tuple, spark: SparkSession) -> RetailLayers:
    return RetailLayers(spark, tables_dir)


def layers(spark: SparkSession, tables_dir: str) -> RetailLayers:
    """The layers of ``tables_dir`` in this Spark application."""
    tables_dir = tables_dir.rstrip("/")
    return _layers_of(
        spark.conf.get("spark.app.id"), tables_dir, _source_state(spark, tables_dir), spark
    )


def retail_silver(bronze: DataFrame) -> DataFrame:
    return silver.silver_lines(bronze, retail_tables.RETAIL_PRODUCT_CODE_PATTERN)


def clustered_silver(bronze: DataFrame) -> DataFrame:
    """Silver as a build lays it out."""
    # One number per calendar day and batch.
    days = dedup.batch_days(bronze).collect()
    by_day = bronze.sparkSession.createDataFrame(days, "day date, source_sheet string, lines bigint")
    return silver.clustered_silver(
        dedup.flag_overlap_copies(bronze, by_day),
        builds.lines_by_day(days),
        retail_tables.RETAIL_PRODUCT_CODE_PATTERN,
    )


def retail_bronze_contract() -> contracts.Contract:
    return contracts.bronze_contract(retail_tables.RETAIL_WINDOW)


def retail_silver_contract() -> contracts.Contract:
    return contracts.silver_contract(
        retail_tables.RETAIL_WINDOW,
        retail_tables.RETAIL_INVOICE_PATTERN,
        retail_tables.RETAIL_CUSTOMER_ID_PATTERN,
        retail_tables.RETAIL_PRODUCT_CODE_PATTERN,
    )


def retail_customer_360_contract() -> contracts.Contract:
    return contracts.customer_360_contract(retail_tables.RETAIL_CUSTOMER_ID_PATTERN)


def with_dirt(bronze: DataFrame) -> DataFrame:
    """Bronze with lines that violate the silver contract."""
    invoice, code = F.col("invoice"), F.col("stock_code")
    return bronze.withColumns(
        {
            "invoice": F.when(invoice.endswith("71"), F.concat(F.lit("X"), invoice)).otherwise(invoice),
            "quantity": F.when(invoice.endswith("67"), F.lit(0)).otherwise(F.col("quantity")),
            "unit_price": F.when(code.endswith("13"), -F.col("unit_price"))
            .otherwise(F.col("unit_price")),
        }
    )


def with_wrong_revenue(lines: DataFrame) -> DataFrame:
    off = F.when(F.col("quantity") == 13, 1.0).otherwise(0.0)
    return lines.withColumn("line_revenue", F.col("line_revenue") + off)


def with_text_numbers(bronze: DataFrame) -> DataFrame:
    """Bronze with numbers as text, some of which are no numbers."""
    price, code = F.col("unit_price").cast("string"), F.col("stock_code")
    return bronze.withColumns(
        {
            "quantity": F.when(F.col("quantity") == 7, "seven").otherwise(
                F.col("quantity").cast("string")
            ),
            "unit_price": F.when(code.endswith("3"), F.concat(price, F.lit(" GBP"))).otherwise(price),
        }
    )


def _delivered(spark: SparkSession, tables_dir: str) -> dict[str, str]:
    """CSV folders as they are delivered, one per batch, written in one pass."""
    folder = new_folder(spark, "batches")
    retail_tables.raw_deliveries(spark, tables_dir).write.partitionBy("batch").options(
        header=True, escape='"', timestampNTZFormat="yyyy-MM-dd HH:mm:ss"
    ).csv(folder)
    names = (retail_tables.FIRST_BATCH, retail_tables.SECOND_BATCH)
    return {name: f"{folder}/batch={name}" for name in names}


def _bronze_files(spark: SparkSession, tables_dir: str) -> DataFrame:
    """Bronze by way of delivered CSV folders."""
    return batches.read_batches(
        spark,
        _delivered(spark, tables_dir),
        retail_tables.LOADED_AT,
        source_file=retail_tables.SOURCE_FILE,
    )


def _file_lineage(spark: SparkSession, tables_dir: str) -> DataFrame:
    """Lines per batch of delivered folders, and whether each names the file it was read from."""
    read = batches.read_batches(spark, _delivered(spark, tables_dir), retail_tables.LOADED_AT)
    return read.groupBy("source_sheet").agg(
        F.count("*").alias("lines"),
        F.count_if(F.col("source_file").rlike(r"^part-[^/]*\.csv\z")).alias("lines_with_file_name"),
        (F.count_distinct("source_file") > 0).alias("has_files"),
    )


def _export_roundtrip(spark: SparkSession, tables_dir: str) -> DataFrame:
    path = new_folder(spark, "export")
    layers(spark, tables_dir).silver().write.parquet(path)
    return spark.read.parquet(path)


def _in_warehouse(
    spark: SparkSession, tables_dir: str, work: Callable[[Warehouse, RetailLayers], DataFrame]
) -> DataFrame:
    """The result of ``work`` in a warehouse of its own, which is gone afterwards."""
    stored = layers(spark, tables_dir)
    stored.bronze()
    folder = new_folder(spark, "warehouse")
    warehouse = Warehouse(spark, folder, prefix=f"tillpanel_{uuid.uuid4().hex[:12]}_")
    try:
        warehouse.publish(stored.path("bronze"), BRONZE_TABLE, BRONZE_SCHEMA)
        result = work(warehouse, stored)
        path = new_folder(spark, "result")
        result.write.parquet(path)
    finally:
        warehouse.drop()
        remove_folder(spark, folder)
    return spark.read.schema(result.schema).parquet(path)


def _with_gold(warehouse: Warehouse, stored: RetailLayers) -> None:
    """Silver and two gold slices; the early slice is first built with another window, then replaced."""
    lines = stored.dated_silver()
    warehouse.publish(stored.path("silver"), SILVER_TABLE, SILVER_SCHEMA)
    for cutoff, churn_window in ((EARLY, 30), (MIDDLE, 90), (EARLY, 90)):
        warehouse.upsert_slice(
            snapshot.customer_360(lines, cutoff, churn_window),
            cutoff_date(cutoff),
            CUSTOMER_360_SCHEMA,
        )


def _upserted(warehouse: Warehouse, stored: RetailLayers) -> DataFrame:
    _with_gold(warehouse, stored)
    return warehouse.table(GOLD_TABLE).select(CUSTOMER_360_SCHEMA.fieldNames())


def _inventory(warehouse: Warehouse, stored: RetailLayers) -> DataFrame:
    _with_gold(warehouse, stored)
    return profile.table_inventory(warehouse.tables())


def _slice_read(warehouse: Warehouse, stored: RetailLayers) -> DataFrame:
    """One cutoff of a panel that a backfill and a later build have left."""
    stored.silver()
    warehouse.publish(stored.path("silver"), SILVER_TABLE, SILVER_SCHEMA)
    contract = retail_customer_360_contract()
    builds.backfill_customer_360(warehouse, (EARLY, MIDDLE), contract=contract)
    builds.build_customer_360(warehouse, LATE, contract=contract)
    panel_table = warehouse.table(GOLD_TABLE).select(CUSTOMER_360_SCHEMA.fieldNames())
    return snapshot.snapshot_slice(panel_table, MIDDLE)


def _build_silver(warehouse: Warehouse) -> DataFrame:
    accounting, _ = builds.build_silver(
        warehouse,
        retail_bronze_contract(),
        retail_silver_contract(),
        product_code_pattern=retail_tables.RETAIL_PRODUCT_CODE_PATTERN,
    )
    return accounting


def _build_accounting(warehouse: Warehouse, stored: RetailLayers) -> DataFrame:
    """What a silver build reports, beside the rows of the table that it left."""
    return _build_silver(warehouse).crossJoin(
        warehouse.table(SILVER_TABLE).agg(F.count("*").alias("published_rows"))
    )


def _rejected_build(warehouse: Warehouse, stored: RetailLayers) -> DataFrame:
    """Silver after a build that its contract rejected: that of the build before."""
    _build_silver(warehouse)
    warehouse.replace(with_dirt(stored.bronze()), BRONZE_TABLE, BRONZE_SCHEMA)
    try:
        _build_silver(warehouse)
    except contracts.ContractViolation as violation:
        rejected = len(violation.violations)
    else:
        rejected = 0
    return warehouse.table(SILVER_TABLE).withColumn("violated_rules", F.lit(rejected))


def _run_rates(lines: DataFrame) -> DataFrame:
    return snapshot.customer_360(lines, MIDDLE).select(
        "customer_id", "tenure_days", "total_net_revenue", "trailing_12m_net_revenue", "run_rate_90d"
    )


def _dictionary(spark: SparkSession, tables_dir: str) -> DataFrame:
    stored = layers(spark, tables_dir)
    return profile.data_dictionary(
        {
            BRONZE_TABLE: stored.bronze(),
            SILVER_TABLE: stored.silver(),
            GOLD_TABLE: snapshot.customer_360(stored.dated_silver(), MIDDLE),
        }
    )


def _on_bronze(operator: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, tables_dir: operator(layers(spark, tables_dir).bronze())


def _on_silver(operator: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, tables_dir: operator(layers(spark, tables_dir).silver())


def _on_history(operator: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, tables_dir: operator(layers(spark, tables_dir).dated_silver())


def _warehoused(work: Callable[[Warehouse, RetailLayers], DataFrame]) -> Query:
    return lambda spark, tables_dir: _in_warehouse(spark, tables_dir, work)


def _on_slice(operator: Callable[[DataFrame], DataFrame], cutoff: str = MIDDLE) -> Query:
    return _on_history(lambda lines: operator(snapshot.customer_360(lines, cutoff)))


def retail_queries() -> dict[str, Query]:
    return {
        "customer_360_slice": _on_slice(lambda s: s),
        # bronze
        "bronze_union_all": lambda spark, d: layers(spark, d).derived_bronze(),
        "bronze_customer_id_text": lambda spark, d: layers(spark, d)
        .derived_bronze()
        .groupBy("customer_id")
        .agg(F.count("*").alias("lines")),
        "bronze_typed": _bronze_files,
        "bronze_file_lineage": _file_lineage,
        # silver
        "silver_cross_batch_dedup": _on_bronze(dedup.drop_overlap_copies),
        "silver_anonymous_filter": _on_bronze(silver.drop_anonymous),
        "silver_derived_columns": _on_bronze(
            lambda b: silver.with_derived_columns(
                b, retail_tables.RETAIL_PRODUCT_CODE_PATTERN
            ).select(
                "invoice",
                "stock_code",
                "quantity",
                "unit_price",
                "line_revenue",
                "is_cancellation",
                "is_product",
            )
        ),
        "silver_transactions": _on_bronze(retail_silver),
        "silver_row_accounting": _on_bronze(silver.row_accounting),
        "silver_build_accounting": _warehoused(_build_accounting),
        "silver_after_rejected_build": _warehoused(_rejected_build),
        "silver_summary": _on_silver(silver.silver_summary),
        "silver_non_product_codes": _on_silver(silver.non_product_codes),
        # contracts
        "contract_bronze": _on_bronze(
            lambda b: contracts.violations(b, retail_bronze_contract())
        ),
        "contract_silver": _on_silver(
            lambda s: contracts.violations(s, retail_silver_contract())
        ),
        "contract_silver_dirty": _on_bronze(
            lambda b: contracts.violations(
                with_wrong_revenue(retail_silver(with_dirt(b))), retail_silver_contract()
            )
        ),
        "contract_coercion": _on_bronze(
            lambda b: contracts.violations(with_text_numbers(b), retail_bronze_contract())
        ),
        "contract_gold": _on_slice(
            lambda s: contracts.violations(s, retail_customer_360_contract())
        ),
        "contract_schema_diff": _on_bronze(
            lambda b: contracts.schema_difference_report(
                b.withColumn("surprise", F.col("customer_id")), retail_silver_contract()
            )
        ),
        "contract_describe": _on_silver(
            lambda s: contracts.contract_report(s, retail_silver_contract())
        ),
        # gold
        "gold_as_of_history": _on_history(lambda s: snapshot.history_before(s, MIDDLE)),
        "gold_latest_country": _on_history(lambda s: snapshot.latest_country(s, MIDDLE)),
        "gold_activity_dates": _on_history(lambda s: snapshot.activity_dates(s, EARLY)),
        "gold_order_counts": _on_history(lambda s: snapshot.order_counts(s, MIDDLE)),
        "gold_net_revenue": _on_history(lambda s: snapshot.net_revenue(s, MIDDLE)),
        "gold_trailing_revenue": _on_history(lambda s: snapshot.trailing_revenue(s, MIDDLE)),
        "gold_cancelled_revenue": _on_history(lambda s: snapshot.cancelled_revenue(s, MIDDLE)),
        "gold_run_rate": _on_history(_run_rates),
        "customer_360_panel": _on_history(
            lambda s: panel.customer_panel(s, (EARLY, MIDDLE, LATE))
        ),
        "customer_360_upsert": _warehoused(_upserted),
        "customer_360_slice_read": _warehoused(_slice_read),
        "customer_360_profile": _on_slice(snapshot.snapshot_profile),
        "active_population": _on_slice(snapshot.active_customers),
        # dictionary
        "profile_bronze": _on_bronze(profile.column_profile),
        "profile_silver": _on_silver(profile.column_profile),
        "profile_gold": _on_slice(profile.column_profile),
        "data_dictionary": _dictionary,
        "table_inventory": _warehoused(_inventory),
        "export_roundtrip": _export_roundtrip,
    }
