import random
from collections import Counter
from datetime import date, datetime, timedelta

import pytest
from conftest import FILE, SHEET_2
from pyspark.sql import functions as F

from tillpanel.operators.contracts import ContractViolation, customer_360_contract
from tillpanel.operators.panel import customer_panel
from tillpanel.operators.silver import with_derived_columns
from tillpanel.operators.snapshot import (
    active_customers,
    activity_dates,
    cancelled_revenue,
    customer_360,
    latest_country,
    net_revenue,
    order_counts,
    snapshot_profile,
    snapshot_slice,
    trailing_revenue,
)
from tillpanel.plans.builds import backfill_customer_360, build_customer_360, snapshot_report
from tillpanel.schemas import CUSTOMER_360_SCHEMA, GOLD_TABLE, SILVER_SCHEMA, SILVER_TABLE

AS_OF = "2011-03-15"
UK = "Portugal"


def days_before(days, hour=12):
    return datetime(2011, 3, 15, hour) - timedelta(days=days)


# Anna: two sales a good year apart, then a service line. Ben: new. Cleo: returns only.
ROWS = [
    ("700001", "30001", 4, 2.5, days_before(400), "50001", UK),
    ("700002", "30002C", 6, 5.0, days_before(50), "50001", UK),
    ("700003", "CARRIAGE", 1, 9.0, days_before(20), "50001", UK),
    ("700004", "30003", 8, 3.0, days_before(9), "50002", "Norway"),
    ("C700005", "30003", -2, 6.0, days_before(100), "50003", UK),
]
AT_CUTOFF = ("700006", "30009", 7, 1.0, datetime(2011, 3, 15), "50001", UK)
LATER = ("700007", "30009", 7, 1.0, datetime(2011, 4, 2), "50001", UK)


@pytest.fixture
def silver_frame(spark):
    def build(rows):
        columns = "invoice string, stock_code string, quantity bigint, unit_price double, \
            invoice_date timestamp_ntz, customer_id string, country string"
        lines = spark.createDataFrame(rows, columns).withColumns(
            {
                "description": F.col("stock_code"),
                "source_file": F.lit(FILE),
                "source_sheet": F.lit(SHEET_2),
                "loaded_at": F.lit("2026-06-16 00:00:00").cast("timestamp_ntz"),
            }
        )
        return with_derived_columns(lines).select(SILVER_SCHEMA.fieldNames())

    return build


@pytest.fixture
def loaded(warehouse, silver_frame):
    warehouse.replace(silver_frame(ROWS), SILVER_TABLE, SILVER_SCHEMA)
    return warehouse


def customer(frame, customer_id):
    return frame.filter(F.col("customer_id") == customer_id).first()


def test_schema(silver_frame):
    snapshot = customer_360(silver_frame(ROWS), AS_OF)
    assert snapshot.dtypes == [(f.name, f.dataType.simpleString()) for f in CUSTOMER_360_SCHEMA]


def facts(frame, customer_id, *names):
    row = customer(frame, customer_id)
    return tuple(row[n] for n in names)


def test_everyone_with_history_has_a_row(silver_frame):
    lines = silver_frame(ROWS)
    found = {c: [r.customer_id for r in customer_360(lines, c).collect()] for c in ("2010-01-01", AS_OF)}
    assert {c: sorted(ids) for c, ids in found.items()} == {
        "2010-01-01": [], AS_OF: ["50001", "50002", "50003"],
    }


def test_service_lines_are_activity_but_not_purchases(silver_frame):
    snapshot = customer_360(silver_frame(ROWS), AS_OF)
    assert facts(
        snapshot, "50001", "first_purchase_date", "last_purchase_date", "last_activity_date",
        "recency_days", "tenure_days", "order_count", "cancelled_order_count",
    ) == (days_before(400).date(), days_before(50).date(), days_before(20).date(), 20, 400, 3, 0)
    assert facts(
        snapshot, "50001", "total_net_revenue", "trailing_12m_net_revenue", "cancelled_revenue", "country"
    ) == (40.0, 30.0, 0.0, UK)
    # More than a trailing window of history: that window scaled to the horizon.
    assert customer(snapshot, "50001").run_rate_90d == pytest.approx(30.0 / 365 * 90)


def test_a_short_history_counts_as_long_as_the_horizon(silver_frame):
    lines = silver_frame(ROWS)
    names = ("tenure_days", "total_net_revenue", "run_rate_90d")
    assert facts(customer_360(lines, AS_OF), "50002", *names) == (9, 24.0, 24.0)
    assert facts(customer_360(lines, AS_OF, 6), "50002", *names) == (9, 24.0, 24.0 / 9 * 6)


def test_returns_alone(silver_frame):
    snapshot = customer_360(silver_frame(ROWS), AS_OF)
    assert facts(
        snapshot, "50003", "last_purchase_date", "order_count", "cancelled_order_count",
        "total_net_revenue", "cancelled_revenue",
    ) == (None, 0, 1, -12.0, -12.0)


def test_trailing_window_is_half_open(silver_frame):
    start = datetime(2011, 3, 15) - timedelta(days=365)
    rows = [
        ("700001", "30001", 1, 3.0, start, "50001", UK),
        ("700002", "30001", 1, 20.0, start - timedelta(microseconds=1), "50001", UK),
    ]
    lines = silver_frame(rows)
    assert customer(customer_360(lines, AS_OF), "50001").trailing_12m_net_revenue == 3.0
    assert customer(customer_360(lines, AS_OF, 90, 366), "50001").trailing_12m_net_revenue == 23.0


@pytest.mark.parametrize("later", [AT_CUTOFF, LATER])
def test_lines_from_the_cutoff_on_change_nothing(silver_frame, later):
    plain_rows, leaky = silver_frame(ROWS), silver_frame([*ROWS, later])
    assert customer_360(leaky, AS_OF).exceptAll(customer_360(plain_rows, AS_OF)).count() == 0
    # A cutoff after them sees them.
    assert facts(customer_360(leaky, "2011-05-01"), "50001", "order_count", "total_net_revenue") == (4, 47.0)


def test_an_earlier_cutoff_sees_less(silver_frame):
    snapshot = customer_360(silver_frame(ROWS), days_before(30).date())
    assert customer(snapshot, "50002") is None
    assert facts(snapshot, "50001", "order_count", "recency_days") == (2, 20)


def test_latest_country_breaks_ties_by_invoice_then_country(silver_frame):
    noon = days_before(7)
    rows = [
        ("700011", "30001", 1, 1.0, noon, "50001", "Cyprus"),
        ("700012", "30001", 1, 1.0, noon, "50001", "Austria"),
        ("700099", "30001", 1, 1.0, noon, "50002", "Poland"),
        ("C700001", "30001", -1, 1.0, noon, "50002", "Greece"),
        ("700013", "30001", 1, 1.0, noon, "50003", "Iceland"),
        ("700013", "30001", 1, 1.0, noon, "50003", "Latvia"),
    ]
    lines = silver_frame(rows)
    expected = {"50001": "Austria", "50002": "Greece", "50003": "Latvia"}
    assert {r.customer_id: r.country for r in latest_country(lines, AS_OF).collect()} == expected
    snapshot = customer_360(lines, AS_OF)
    assert {r.customer_id: r.country for r in snapshot.collect()} == expected
    # An invoice with two countries is still one order.
    assert customer(snapshot, "50003").order_count == 1


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_large_and_tiny_amounts_add_exactly(spark, silver_frame, ansi):
    rows = [("700001", "30001", 1, 1.0, days_before(3), "50001", UK),
            ("700002", "30001", 1, 2e12, days_before(3), "50001", UK),
            ("700003", "30001", 1, 1e18, days_before(3), "50003", UK)]
    rows += [(f"7{i:05d}", "30001", 1, 4e-7, days_before(2), "50002", UK) for i in range(1000)]
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        found = {r.customer_id: r.total_net_revenue for r in customer_360(silver_frame(rows), AS_OF).collect()}
        assert found == {"50001": 2000000000001.0, "50002": 0.0004, "50003": 1e18}
        too_much = silver_frame([(*rows[0][:3], 6e19, *rows[0][4:]) for _ in range(2)])
        with pytest.raises(Exception, match="a total exceeds"):
            net_revenue(too_much, AS_OF).collect()
        with pytest.raises(Exception, match="amount: no decimal"):
            net_revenue(silver_frame([(*rows[0][:3], 6e20, *rows[0][4:])]), AS_OF).collect()
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


def random_lines(seed, count=300):
    pick = random.Random(seed)
    rows = []
    for _ in range(count):
        cancelled = pick.random() < 0.3
        number = f"{'C' if cancelled else ''}{100000 + pick.randrange(40)}"
        rows.append(
            (
                number,
                pick.choice(["85123", "85124B", "POST"]),
                pick.randint(1, 9) * (-1 if cancelled else 1),
                pick.choice([0.0, 1.25, 3.1, 7.77]),
                datetime(2010, 1, 1) + timedelta(days=pick.randrange(600), hours=pick.choice([0, 9])),
                pick.choice(["11111", "22222", "33333", "44444"]),
                pick.choice([UK, "France", "Spain"]),
            )
        )
    return rows


CUTOFFS = ["2010-01-02", "2010-03-01", "2010-12-31", "2011-01-01", "2011-06-01", "2012-01-01"]


def brute_force(rows, as_of):
    """The snapshot in plain Python."""
    cutoff = datetime.combine(as_of, datetime.min.time())
    result = {}
    for who in {r[5] for r in rows}:
        lines = [r for r in rows if r[5] == who and r[4] < cutoff]
        if not lines:
            continue
        revenue = lambda part: round(sum(r[2] * r[3] for r in part), 6) + 0.0
        product = [r for r in lines if r[1] != "POST"]
        recent = [r for r in product if r[4] >= cutoff - timedelta(days=365)]
        bought = [r[4] for r in product if r[2] > 0]
        first, last = min(r[4] for r in lines), max(r[4] for r in lines)
        tenure = (as_of - first.date()).days
        total, trailing = revenue(product), revenue(recent)
        rate = trailing * 90 / 365 if tenure >= 365 else total / max(tenure, 90) * 90
        result[who] = (
            first.date(),
            last.date(),
            max(bought).date() if bought else None,
            (as_of - last.date()).days,
            tenure,
            len({r[0] for r in lines if not r[0].startswith("C")}),
            len({r[0] for r in lines if r[0].startswith("C")}),
            total,
            trailing,
            revenue([r for r in lines if r[0].startswith("C")]),
            round(rate, 6),
            max((r[4], r[0], r[6]) for r in lines)[2],
        )
    return result


def plain(rows):
    return {r[0]: (*r[2:9], *(round(v, 6) for v in r[9:13]), r[13]) for r in rows}


@pytest.mark.parametrize("seed", range(2))
def test_panel_and_slices_match_brute_force(silver_frame, seed):
    rows = random_lines(seed)
    lines = silver_frame(rows)
    panel = customer_panel(lines, CUTOFFS).collect()
    assert Counter(r.as_of_date for r in panel).keys() <= {date.fromisoformat(c) for c in CUTOFFS}
    for cutoff in CUTOFFS:
        as_of = date.fromisoformat(cutoff)
        expected = brute_force(rows, as_of)
        assert plain([r for r in panel if r.as_of_date == as_of]) == expected
        assert plain(customer_360(lines, cutoff).collect()) == expected


def test_single_metrics_agree_with_the_snapshot(silver_frame):
    lines = silver_frame(random_lines(7))
    snapshot = customer_360(lines, AS_OF)
    for metric in (
        activity_dates,
        order_counts,
        net_revenue,
        trailing_revenue,
        cancelled_revenue,
        latest_country,
    ):
        alone = metric(lines, AS_OF)
        assert alone.exceptAll(snapshot.select(alone.columns)).count() == 0, metric.__name__
        assert alone.count() == snapshot.count()


def test_profile(silver_frame):
    row = snapshot_profile(customer_360(silver_frame(ROWS), AS_OF)).first()
    assert (row.customers, row.active_customers, row.no_purchase, row.net_negative) == (3, 2, 1, 1)
    assert (row.median_recency_days, row.max_recency_days) == (20.0, 100)
    assert (row.median_tenure_days, row.max_tenure_days) == (100.0, 400)
    assert row.total_net_revenue == 52.0
    narrow = snapshot_profile(customer_360(silver_frame(ROWS), AS_OF), 9).first()
    assert (narrow.active_customers, round(narrow.active_percent, 1)) == (1, 33.3)


def test_profile_of_nobody(silver_frame):
    row = snapshot_profile(customer_360(silver_frame(ROWS), "2005-01-01")).first()
    assert (row.customers, row.active_percent, row.total_net_revenue) == (0, 0.0, 0.0)
    assert row.median_recency_days is None


def test_active_population(silver_frame):
    active = active_customers(customer_360(silver_frame(ROWS), AS_OF), 20)
    assert sorted(r.customer_id for r in active.collect()) == ["50001", "50002"]


# ---- builds -------------------------------------------------------------------------------------

EARLIER = "2011-02-01"


def contents(warehouse):
    return {tuple(r) for r in warehouse.table(GOLD_TABLE).collect()}


def test_a_slice_is_replaced_and_others_stay(loaded):
    assert build_customer_360(loaded, EARLIER)[0] == 2
    first = contents(loaded)
    for _ in range(2):
        assert build_customer_360(loaded, AS_OF) == (3, None)
    assert first < contents(loaded)
    assert loaded.table(GOLD_TABLE).count() == 5


def test_an_empty_slice_clears_the_old_one(loaded, silver_frame):
    build_customer_360(loaded, EARLIER)
    build_customer_360(loaded, AS_OF)
    recent = [r for r in ROWS if r[4] >= days_before(30)]
    loaded.replace(silver_frame(recent), SILVER_TABLE, SILVER_SCHEMA)
    assert build_customer_360(loaded, EARLIER)[0] == 0
    assert {str(r.as_of_date) for r in loaded.table(GOLD_TABLE).collect()} == {AS_OF}
    assert snapshot_report(loaded, EARLIER).first().customers == 0


def test_a_violation_leaves_the_panel_untouched(loaded, silver_frame):
    build_customer_360(loaded, AS_OF)
    before = contents(loaded)
    bad = [*ROWS, ("700200", "30001", 1, 1.0, days_before(5), "walk-in", UK)]
    loaded.replace(silver_frame(bad), SILVER_TABLE, SILVER_SCHEMA)
    with pytest.raises(ContractViolation, match="customer_id"):
        build_customer_360(loaded, AS_OF)
    assert contents(loaded) == before


def test_backfill_equals_replay(loaded):
    cutoffs = ["2009-06-01", EARLIER, "2011-03-10", AS_OF]
    counted = backfill_customer_360(loaded, cutoffs)
    assert {str(day): n for day, n in counted.items()} == dict(zip(cutoffs, [0, 2, 3, 3]))
    backfilled = contents(loaded)
    for cutoff in cutoffs:
        build_customer_360(loaded, cutoff)
    assert contents(loaded) == backfilled
    assert len(backfilled) == 8


def test_backfill_is_audited_before_any_slice_is_published(loaded):
    with pytest.raises(ContractViolation):
        backfill_customer_360(loaded, [AS_OF], contract=customer_360_contract("^9"))
    assert not loaded.exists(GOLD_TABLE)


def test_export_holds_the_new_slice(loaded, spark, tmp_path):
    build_customer_360(loaded, EARLIER)
    rows, path = build_customer_360(loaded, AS_OF, export_path=str(tmp_path / "export"))
    exported = spark.read.parquet(path)
    assert exported.count() == rows == 3
    assert {str(r.as_of_date) for r in exported.collect()} == {AS_OF}


def test_reading_a_slice_reads_its_partition(loaded):
    backfill_customer_360(loaded, [EARLIER, AS_OF])
    one = snapshot_slice(loaded.table(GOLD_TABLE), EARLIER)
    plan = one._jdf.queryExecution().executedPlan().toString()
    filters = plan[plan.index("PartitionFilters") :].splitlines()[0]
    assert "as_of_date" in filters[: filters.index("PushedFilters")]
    assert one.count() == 2


def test_superseded_versions_can_be_removed(loaded):
    build_customer_360(loaded, EARLIER)
    build_customer_360(loaded, AS_OF)
    build_customer_360(loaded, AS_OF)
    backfill_customer_360(loaded, ["2011-03-10", "2011-03-11"])
    before = contents(loaded)
    assert len(loaded.remove_superseded(GOLD_TABLE)) == 1
    assert loaded.remove_superseded(GOLD_TABLE) == []
    assert contents(loaded) == before
    loaded.replace(loaded.table(SILVER_TABLE), SILVER_TABLE, SILVER_SCHEMA)
    assert len(loaded.remove_superseded(SILVER_TABLE)) == 1
    assert loaded.table(SILVER_TABLE).count() == len(ROWS)


@pytest.mark.parametrize("statement", ["CREATE TABLE", "ALTER TABLE", "CREATE OR REPLACE VIEW"])
def test_a_backfill_that_fails_half_way_leaves_the_whole_panel(loaded, spark, monkeypatch, statement):
    build_customer_360(loaded, EARLIER)
    build_customer_360(loaded, AS_OF)
    before = contents(loaded)
    run = spark.sql

    def failing(text, *rest, **more):
        if text.startswith(statement):
            raise ConnectionError("the catalog is gone")
        return run(text, *rest, **more)

    with monkeypatch.context() as patched:
        patched.setattr(loaded, "spark", _Instead(spark, failing))
        with pytest.raises(ConnectionError):
            # Another horizon changes the run rates of both slices.
            backfill_customer_360(loaded, [EARLIER, AS_OF, "2011-03-11"], trailing_days=30)
    assert contents(loaded) == before
    backfill_customer_360(loaded, [EARLIER, AS_OF, "2011-03-11"], trailing_days=30)
    after = contents(loaded)
    assert len(after) > len(before) and after != before
    loaded.remove_superseded(GOLD_TABLE)
    assert contents(loaded) == after
    assert [t for t in loaded.tables() if t.startswith("gold.")] == [GOLD_TABLE]


class _Instead:
    """A session whose statements go through a function."""

    def __init__(self, spark, sql):
        self._spark, self.sql = spark, sql

    def __getattr__(self, name):
        return getattr(self._spark, name)


def test_rows_of_another_cutoff_are_refused(loaded, silver_frame):
    snapshot = customer_360(silver_frame(ROWS), AS_OF)
    with pytest.raises(Exception, match="row outside the slice"):
        loaded.upsert_slice(snapshot, date(2011, 2, 1), CUSTOMER_360_SCHEMA)
    assert not loaded.exists(GOLD_TABLE)
