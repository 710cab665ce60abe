"""Where silver rows lie, and what a reader by date can skip."""

from datetime import date, datetime, timedelta
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tillpanel.operators.snapshot import history_before
from tillpanel.schemas import SILVER_SCHEMA
from tillpanel.storage import layout
from tillpanel.storage.layout import DAY_COLUMN, clustered_by_date, dated, dealt_days

JANUARY = date(2011, 1, 1)


def test_days_are_dealt_in_order_to_files_of_even_size():
    lines = {JANUARY + timedelta(days=k): 40 for k in range(10)} | {JANUARY + timedelta(days=4): 250, None: 5}
    dealt = dealt_days(lines, 100)
    assert [d for d, *_ in dealt] == [None, *(JANUARY + timedelta(days=k) for k in range(10))]
    assert [(first, n) for _, first, n in dealt] == [
        (0, 1), (0, 1), (0, 1), (1, 1), (1, 1), (2, 3), (5, 1), (5, 1), (6, 1), (6, 1), (7, 1)
    ]
    assert dealt_days({}, 100) == []
    assert dealt_days({JANUARY: 300}, 100) == [(JANUARY, 0, 3)]


@pytest.fixture
def small_files(monkeypatch):
    monkeypatch.setattr(layout, "LEAST_LINES", 50)


def silver(spark, days, lines_per_day):
    start = F.lit(datetime(2011, 1, 1, 9)).cast("timestamp_ntz")
    rows = spark.range(days * lines_per_day, numPartitions=5).select(
        F.col("id").cast("string").alias("invoice"), F.lit("60001").alias("stock_code"),
        F.lit("x").alias("description"), F.lit(1).cast("long").alias("quantity"),
        (start + F.make_dt_interval((F.col("id") % days).cast("int"))).alias("invoice_date"),
        F.lit(1.0).alias("unit_price"), F.lit("20001").alias("customer_id"), F.lit("Malta").alias("country"),
        F.lit(1.0).alias("line_revenue"), F.lit(False).alias("is_cancellation"), F.lit(True).alias("is_product"),
        F.lit("f").alias("source_file"), F.lit("S1").alias("source_sheet"), start.alias("loaded_at"),
    )
    return rows, {JANUARY + timedelta(days=k): lines_per_day for k in range(days)}


def read_lines(frame):
    """Lines that the scan hands on, by its own count."""
    frame.collect()
    leaves = frame._jdf.queryExecution().executedPlan().collectLeaves()
    return leaves.head().metrics().apply("numOutputRows").value()


def test_a_cutoff_skips_files(spark, tmp_path, small_files):
    rows, by_day = silver(spark, 40, 50)
    clustered_by_date(rows, by_day).write.parquet(str(tmp_path / "silver"))
    rows.write.parquet(str(tmp_path / "as_it_came"))
    plain = [spark.read.schema(SILVER_SCHEMA).parquet(str(tmp_path / name)) for name in ("silver", "as_it_came")]
    assert plain[0].exceptAll(plain[1]).count() == 0 and plain[0].count() == 2000
    # Files without the day are read whole, and nothing is lost.
    stored = {name: dated(spark, str(tmp_path / name), SILVER_SCHEMA) for name in ("silver", "as_it_came")}
    cutoff = "2011-01-05"
    for frame in (*stored.values(), *plain):
        history = history_before(frame, cutoff)
        assert history.columns == SILVER_SCHEMA.fieldNames() and history.count() == 4 * 50
    assert read_lines(history_before(stored["as_it_came"], cutoff)) == 2000
    assert read_lines(history_before(stored["silver"], cutoff)) <= 500

    ranges = []
    for path in Path(tmp_path / "silver").glob("*.parquet"):
        dates = pq.read_table(path)["invoice_date"].to_pylist()
        assert dates == sorted(dates)
        ranges.append((dates[0].date(), dates[-1].date()))
        assert pq.read_table(path)[DAY_COLUMN].to_pylist() == [d.date() for d in dates]
    ranges.sort()
    assert len(ranges) == 4 and all(a[1] < b[0] for a, b in zip(ranges, ranges[1:], strict=False))


def test_a_hot_day_and_a_hot_line_have_several_files(spark, small_files):
    rows, _ = silver(spark, 1, 4000)
    placed = clustered_by_date(rows.withColumn("invoice", F.lit("500001")), {JANUARY: 4000})
    sizes = [r["count"] for r in placed.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    assert sum(sizes) == 4000 and len(sizes) > 1


def test_days_nobody_counted_and_undated_lines_are_kept(spark, small_files):
    rows, by_day = silver(spark, 6, 50)
    some = {d: n for d, n in by_day.items() if d.day % 2}
    undated = rows.limit(3).withColumn("invoice_date", F.lit(None).cast("timestamp_ntz"))
    assert clustered_by_date(rows.union(undated), some).count() == 303
    assert clustered_by_date(rows.filter("false"), {}).count() == 0


def test_a_file_of_a_large_table_is_sorted_in_a_bounded_task(spark):
    """However few partitions the session has: 40 million lines on 200 days, or on one."""
    rows, _ = silver(spark, 1, 10)
    spread = {JANUARY + timedelta(days=k): 200_000 for k in range(200)}
    for by_day in (spread, {JANUARY: 40_000_000}):
        assert clustered_by_date(rows, by_day).rdd.getNumPartitions() >= 40
