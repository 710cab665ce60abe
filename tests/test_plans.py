"""Shapes of the physical plans that the operators promise."""

from __future__ import annotations

import re
from datetime import date, datetime, timedelta

import pytest

from tillpanel.operators.contracts import customer_360_contract, silver_contract, violations
from tillpanel.operators.dedup import drop_overlap_copies, flag_overlap_copies
from tillpanel.operators.panel import customer_panel
from tillpanel.operators.profile import column_profile
from tillpanel.operators.silver import clustered_silver
from tillpanel.operators.snapshot import customer_360, history_before
from tillpanel.schemas import BRONZE_SCHEMA, SILVER_SCHEMA
from tillpanel.sources import retail_tables


def plan(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


def formatted(frame, capsys) -> str:
    capsys.readouterr()
    frame.explain("formatted")
    return capsys.readouterr().out


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    def write(name, schema):
        path = str(tmp_path_factory.mktemp("stored") / name)
        spark.createDataFrame([], schema).write.parquet(path)
        return spark.read.schema(schema).parquet(path)

    return {"bronze": write("bronze", BRONZE_SCHEMA), "silver": write("silver", SILVER_SCHEMA)}


def test_cutoff_and_columns_reach_the_scan(stored):
    text = plan(history_before(stored["silver"], "2011-06-01").select("invoice"))
    assert "LessThan(invoice_date,2011-06-01T00:00)" in text
    assert "ReadSchema: struct<invoice:string,invoice_date:timestamp_ntz>" in text


def test_snapshot_hashes_lines_before_the_first_shuffle(stored):
    text = plan(customer_360(stored["silver"], "2011-06-01"))
    assert text.count("FileScan") == 1
    assert "Expand" not in text and "Join" not in text
    below_first_shuffle = text[text.rindex("Exchange"):]
    assert "HashAggregate" in below_first_shuffle
    assert not re.search(r"SortAggregate|Sort \[", below_first_shuffle)


@pytest.fixture
def no_size_broadcasts(spark):
    # The tables here are small; without this every join would be broadcast for its size.
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def executed(frame, capsys) -> tuple[str, list[str]]:
    """The plan as it ran, after adaptive execution; first the tree, then the details of its nodes."""
    frame.collect()
    text = formatted(frame, capsys)
    tree = text[text.index("== Final Plan ==") : text.index("== Initial Plan ==")]
    used = set(re.findall(r"\((\d+)\)", tree))
    nodes = re.findall(r"\n\n\((\d+)\) (.*?)(?=\n\n)", text, flags=re.S)
    return tree, [detail for number, detail in nodes if number in used]


def test_dedup_shuffles_only_lines_of_shared_days(bronze_frame, spark, tmp_path, capsys, no_size_broadcasts):
    line = ("500001", "60001", "x", 1, datetime(2010, 1, 5), 1.0, "20001", "Malta")
    rows = [(*line, "S1"), (*line, "S2"), (*line[:4], datetime(2010, 1, 9), *line[5:], "S2")]
    bronze_frame(rows).write.parquet(str(tmp_path / "bronze"))
    bronze = spark.read.schema(BRONZE_SCHEMA).parquet(str(tmp_path / "bronze"))
    tree, nodes = executed(drop_overlap_copies(bronze), capsys)
    # The settled lines go from the scan to the result by a broadcast join alone.
    settled = tree[tree.index("Union") : tree.index("Window")]
    assert settled.index("Scan parquet") < settled.index("BroadcastQueryStage")
    # One read of two columns for the days, one of all lines, one of those between the shared days.
    scans = [n for n in nodes if n.startswith("Scan parquet")]
    assert len(scans) == tree.count("Scan parquet") == 3
    assert sum("ReadSchema: struct<invoice_date:timestamp_ntz,source_sheet:string>" in n for n in scans) == 1
    bounded = [n for n in scans if "GreaterThanOrEqual(invoice_date" in n and "LessThan(invoice_date" in n]
    assert len(bounded) == 1
    # Lines meet in no join; copies are folded before their first shuffle.
    assert "SortMergeJoin" not in tree and not re.search("Cartesian|NestedLoop", tree)
    below_window = tree[tree.index("Window") :]
    assert below_window.count("Aggregate") >= 2


def test_panel_reads_lines_once_for_any_number_of_cutoffs(stored):
    for n in (3, 365):
        cutoffs = [date(2010, 1, 1) + timedelta(days=k) for k in range(n)]
        assert plan(customer_panel(stored["silver"], cutoffs)).count("FileScan") == 1


def test_gold_contract_reads_lines_once(stored):
    counted = violations(customer_360(stored["silver"], "2011-06-01"), customer_360_contract())
    assert plan(counted).count("FileScan") == 1


def test_bronze_is_one_join_tree(spark, no_size_broadcasts):
    text = plan(retail_tables.raw_deliveries(spark, "/root/testdata/sf0.001"))
    assert text.count("FileScan") == 5


def test_contract_is_one_scan_and_one_aggregate(stored):
    text = plan(violations(stored["silver"], silver_contract()))
    assert text.count("FileScan") == 1
    assert text.count("Exchange") == 1


def test_no_python_and_no_cartesian_product(stored):
    silver = stored["silver"]
    for frame in (
        drop_overlap_copies(stored["bronze"]),
        customer_360(silver, "2011-06-01"),
        column_profile(silver),
        violations(silver, silver_contract()),
    ):
        assert not re.search(r"Python|Arrow|Cartesian|NestedLoop", plan(frame))


def test_joins_of_many_lines_have_partitions_for_them(spark, no_size_broadcasts, monkeypatch):
    """Also where the session has fewer: no task sorts more than its share, and the rows are the same."""
    few = retail_tables.raw_lines(spark, "/root/testdata/sf0.001")
    monkeypatch.setattr(retail_tables, "JOINED_LINES", 500)
    many = retail_tables.raw_lines(spark, "/root/testdata/sf0.001")
    parts = -(-spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet").count() // 500)
    for key in ("l_orderkey", "l_partkey"):
        assert re.search(rf"hashpartitioning\({key}#\d+L?, {parts}\)", plan(many))
    assert many.exceptAll(few).isEmpty() and many.count() == few.count()


def test_silver_derives_its_columns_behind_the_shuffle(stored):
    text = plan(clustered_silver(flag_overlap_copies(stored["bronze"]), {date(2010, 1, 1): 5}))
    behind = text[: text.index("Exchange")]
    assert "line_revenue" in behind and "RLIKE" in behind.upper()
    assert "line_revenue" not in text[text.index("Exchange") :]
