from datetime import datetime

import pytest
from conftest import SHEET_1, SHEET_2
from pyspark.sql import functions as F

from tillpanel.operators.contracts import ContractViolation
from tillpanel.operators.silver import non_product_codes, row_accounting, silver_lines, silver_summary
from tillpanel.plans.builds import (
    ACCOUNTING,
    build_silver,
    data_quality_report,
    dictionary_report,
    ingest_bronze,
)
from tillpanel.schemas import SILVER_SCHEMA, SILVER_TABLE


def line(invoice, code, quantity, at, price, customer, sheet, country="Malta"):
    return (invoice, code, f"item {code}", quantity, at, price, customer, country, sheet)


NEW_YEAR = datetime(2011, 1, 4, 16, 20)
# Three customers; on 4 January both batches deliver, one line of it twice in the first batch.
ROWS = [
    line("500010", "60007", 3, datetime(2010, 3, 8, 12, 5), 1.5, "20001", SHEET_1),
    line("500010", "60008B", 1, datetime(2010, 3, 8, 12, 5), 0.0, "20001", SHEET_1),
    line("500020", "60007", 2, datetime(2010, 7, 19, 8, 30), 1.5, None, SHEET_1),
    line("500030", "BANK", 1, datetime(2010, 9, 2, 15), 7.25, "20002", SHEET_1),
    line("500040", "60009", 4, NEW_YEAR, 2.0, "20003", SHEET_1),
    line("500040", "60009", 4, NEW_YEAR, 2.0, "20003", SHEET_1),
    line("500040", "60009", 4, NEW_YEAR, 2.0, "20003", SHEET_2),
    line("500041", "60009", 5, NEW_YEAR, 2.0, None, SHEET_2),
    line("C500050", "60007", -1, datetime(2011, 2, 11, 10), 1.5, "20001", SHEET_2),
]
ACCOUNT = {
    "bronze_rows": 9, "duplicate_rows_dropped": 1, "deduped_rows": 8,
    "anonymous_rows_dropped": 2, "silver_rows": 6,
}


@pytest.fixture
def loaded(warehouse, bronze_frame):
    ingest_bronze(warehouse, bronze_frame(ROWS))
    return warehouse


def test_every_row_is_accounted_for_however_often_it_is_built(loaded):
    for _ in range(2):
        accounting, path = build_silver(loaded)
        assert (accounting.first().asDict(), path) == (ACCOUNT, None)
    assert loaded.table(SILVER_TABLE).count() == ACCOUNT["silver_rows"]
    assert tuple(ACCOUNT) == ACCOUNTING


def test_accounting_of_a_build_is_that_of_the_operator(loaded, bronze_frame):
    accounting, _ = build_silver(loaded)
    assert accounting.collect() == row_accounting(bronze_frame(ROWS)).collect()


def test_repeats_within_the_first_batch_stay(loaded):
    build_silver(loaded)
    kept = loaded.table(SILVER_TABLE).filter("invoice = '500040'").collect()
    assert [r.source_sheet for r in kept] == [SHEET_1, SHEET_1]


def test_flags_and_revenue_of_invoices(loaded):
    build_silver(loaded)
    silver = loaded.table(SILVER_TABLE)
    assert silver.dtypes == [(f.name, f.dataType.simpleString()) for f in SILVER_SCHEMA]
    by_invoice = silver.groupBy("invoice").agg(
        F.sum("line_revenue"), F.bool_or("is_cancellation"), F.bool_or("is_product")
    )
    assert {r[0]: tuple(r)[1:] for r in by_invoice.collect()} == {
        "500010": (4.5, False, True),
        "500030": (7.25, False, False),
        "500040": (16.0, False, True),
        "C500050": (-1.5, True, True),
    }


@pytest.mark.parametrize(
    ("bad", "rule"),
    [
        (line("500060", "60007", 1, datetime(2010, 5, 5), -0.5, "20001", SHEET_1), "unit_price"),
        (line("500060", "60007", 1, datetime(2015, 5, 5), 0.5, "20001", SHEET_1), "invoice_date"),
    ],
)
def test_a_rejected_build_leaves_silver_as_it_was(loaded, bronze_frame, bad, rule):
    build_silver(loaded)
    before = loaded.table(SILVER_TABLE).collect()
    ingest_bronze(loaded, bronze_frame([*ROWS, bad]))
    with pytest.raises(ContractViolation) as raised:
        build_silver(loaded)
    assert {column for column, _, _ in raised.value.violations} == {rule}
    assert loaded.table(SILVER_TABLE).collect() == before


def test_nothing_is_published_when_the_first_build_is_rejected(warehouse, bronze_frame):
    ingest_bronze(warehouse, bronze_frame(ROWS[:1]).withColumn("unit_price", F.lit(-1.0)))
    with pytest.raises(ContractViolation, match="unit_price"):
        build_silver(warehouse)
    assert not warehouse.exists(SILVER_TABLE)


def test_a_build_looks_for_overlap_once(loaded, spark):
    """The jobs of a build read bronze as often as one dedup and the contract do, no more."""
    listener_reads = []
    stage = loaded.stage

    def spying(frame, table):
        listener_reads.append(frame._jdf.queryExecution().executedPlan().toString().count("FileScan"))
        return stage(frame, table)

    loaded.stage = spying
    build_silver(loaded)
    assert len(listener_reads) == 1  # one plan with dedup in it; the accounting came with it


def test_export(loaded, spark, tmp_path):
    _, path = build_silver(loaded, export_path=str(tmp_path / "out"))
    assert spark.read.parquet(path).count() == ACCOUNT["silver_rows"]
    with pytest.raises(ValueError, match="inside the warehouse"):
        loaded.export(SILVER_TABLE, str(tmp_path / "warehouse" / "silver"))


def test_quality_report(loaded):
    build_silver(loaded)
    report = data_quality_report(loaded)
    summary = report["silver_summary"].first().asDict()
    assert summary == {
        "customers": 3, "invoices": 4,
        "first_invoice_date": datetime(2010, 3, 8, 12, 5),
        "last_invoice_date": datetime(2011, 2, 11, 10),
        "cancellation_lines": 1, "non_product_lines": 1, "zero_price_lines": 1,
        "net_product_revenue": 4.5 + 16.0 - 1.5,
    }
    assert [tuple(r) for r in report["non_product_codes"].collect()] == [("BANK", 1, 7.25)]
    assert report["row_accounting"].first().asDict() == ACCOUNT


def test_dictionary_covers_both_tables(loaded):
    build_silver(loaded)
    rows = dictionary_report(loaded).collect()
    assert {r.table_name for r in rows} == {"bronze.transactions", "silver.transactions"}
    flag = next(r for r in rows if r.column_name == "is_product")
    assert (flag.data_type, flag.distinct_values, flag.description != "") == ("BOOLEAN", 2, True)


def test_empty_input(bronze_frame):
    empty = bronze_frame(ROWS).filter("false")
    assert set(row_accounting(empty).first()) == {0}
    lines = silver_lines(empty)
    summary = silver_summary(lines).first()
    assert (summary.customers, summary.cancellation_lines, summary.net_product_revenue) == (0, 0, 0.0)
    assert non_product_codes(lines).count() == 0


def test_codes_are_ordered_by_size_of_revenue(bronze_frame):
    at = datetime(2010, 4, 1)
    rows = [
        line("500001", "FEE", 2, at, 4.0, "20001", SHEET_1),
        line("C500002", "ADJ", -3, at, 30.0, "20001", SHEET_1),
        line("500003", "CARD", 1, at, 8.0, "20001", SHEET_1),
        line("500004", "60007\n", 1, at, 0.5, "20001", SHEET_1),
    ]
    codes = non_product_codes(silver_lines(bronze_frame(rows))).collect()
    assert [r.stock_code for r in codes] == ["ADJ", "CARD", "FEE", "60007\n"]


def test_longer_codes_need_their_own_pattern(bronze_frame):
    rows = [line("500001", "1234567A", 1, datetime(2010, 4, 1), 4.0, "20001", SHEET_1)]
    assert not silver_lines(bronze_frame(rows)).first().is_product
    assert silver_lines(bronze_frame(rows), r"^[0-9]{5,}[A-Za-z]*\z").first().is_product


def test_a_build_audits_without_reading_what_it_writes(loaded, monkeypatch):
    """Both contracts hold for what went by; staged silver and bronze are read for their row counts alone."""
    from tillpanel.operators import contracts

    monkeypatch.setattr(contracts, "enforce", lambda *a: pytest.fail("counted anew"))
    monkeypatch.setattr(contracts, "violations", lambda *a: pytest.fail("read again"))
    accounting, _ = build_silver(loaded)
    assert accounting.first().asDict() == ACCOUNT


def test_counts_that_went_astray_are_taken_anew(loaded, monkeypatch):
    """As after the loss of an executor: more rows went by than there are."""
    from tillpanel.operators.contracts import WritingAudit

    monkeypatch.setattr(WritingAudit, "rows", property(lambda self: -1))
    accounting, _ = build_silver(loaded)
    assert accounting.first().asDict() == ACCOUNT
    assert loaded.table(SILVER_TABLE).count() == ACCOUNT["silver_rows"]


def test_an_empty_bronze_gives_an_empty_silver(loaded, bronze_frame):
    build_silver(loaded)
    ingest_bronze(loaded, bronze_frame(ROWS).filter("false"))
    accounting, _ = build_silver(loaded)
    assert set(accounting.first()) == {0}
    assert loaded.table(SILVER_TABLE).count() == 0


def test_a_rejected_build_writes_nothing(loaded, bronze_frame, monkeypatch):
    build_silver(loaded)
    ingest_bronze(loaded, bronze_frame([*ROWS, line("C500060", "60007", 2, NEW_YEAR, 1.5, "20001", SHEET_2)]))
    monkeypatch.setattr(loaded, "stage", lambda *a: pytest.fail("written before it was audited"))
    with pytest.raises(ContractViolation) as raised:
        build_silver(loaded)
    assert raised.value.violations == [("<row>", "goods come back on cancellations and only there", 1)]


def test_lines_that_do_not_go_into_silver_break_none_of_its_rules(loaded, bronze_frame):
    anonymous = line("X1", "60007", 0, NEW_YEAR, -1.5, None, SHEET_1)
    ingest_bronze(loaded, bronze_frame([*ROWS, anonymous, (*anonymous[:8], SHEET_2)]))
    accounting, _ = build_silver(loaded)
    assert accounting.first().silver_rows == ACCOUNT["silver_rows"]


def test_build_queries_read_no_silver_but_their_own(spark, monkeypatch):
    from tillpanel.plans import retail

    monkeypatch.setattr(retail.RetailLayers, "silver", lambda self: pytest.fail("derived beside the build"))
    queries = retail.retail_queries()
    built = queries["silver_build_accounting"](spark, "/root/testdata/sf0.001").first()
    left = queries["silver_after_rejected_build"](spark, "/root/testdata/sf0.001")
    assert left.count() == built.published_rows == built.silver_rows > 0
    assert left.filter("violated_rules > 0").count() == built.silver_rows
