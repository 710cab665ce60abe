"""Point-in-time customer snapshots: one row per customer with history before a cutoff.

Lines are first folded to one row per customer, invoice and the few flags the metrics ask for, then to
one row per customer. Both steps aggregate before they shuffle, so a customer or an invoice with a
large share of all lines reaches the shuffle as a handful of rows. Each money value is added up once;
the three revenue metrics pick their parts afterwards by flag. Numbering the folded rows within their
invoice turns the distinct invoice counts into plain counts.

The first fold keeps text (country) in its key rather than in an aggregate, because a minimum or
maximum over text makes Spark sort the lines instead of hashing them.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillpanel.functions.cutoffs import days_until, midnight, cutoff_date
from tillpanel.functions.money import exact, exact_sum, money, money_sum
from tillpanel.schemas import CHURN_WINDOW_DAYS, CUSTOMER_360_SCHEMA, TRAILING_WINDOW_DAYS
from tillpanel.storage.layout import before_day

INVOICE_KEY = ("customer_id", "invoice", "is_cancellation")


def history_before(silver: DataFrame, as_of: str | date) -> DataFrame:
    """Lines strictly before midnight at the start of the cutoff date.

    Of a table read with the day of its rows, files of later days are not read.
    """
    day = cutoff_date(as_of)
    return before_day(silver, day).filter(F.col("invoice_date") < midnight(day))


def is_purchase() -> Column:
    """Product lines with a positive quantity; service lines and returns are activity only."""
    return F.col("is_product") & (F.col("quantity") > 0)


def in_trailing_window(as_of: date, trailing_days: int) -> Column:
    return F.col("invoice_date") >= midnight(as_of, days_earlier=trailing_days)


def fold_invoices(history: DataFrame, period: Column) -> DataFrame:
    """Lines folded per invoice, country, product flag and ``period``.

    ``opens_invoice`` marks one row of each invoice, the one of its earliest period.
    """
    folded = (
        history.filter(F.col("customer_id").isNotNull())
        .withColumn("amount", exact(F.col("line_revenue")))
        .groupBy(*INVOICE_KEY, "country", "is_product", period.alias("period"))
        .agg(
            F.min("invoice_date").alias("first_ts"),
            F.max("invoice_date").alias("last_ts"),
            F.max(F.when(is_purchase(), F.col("invoice_date"))).alias("purchase_ts"),
            money_sum(F.col("amount")).alias("amount"),
        )
    )
    within_invoice = Window.partitionBy(*INVOICE_KEY).orderBy("period")
    opens = (F.row_number().over(within_invoice) == 1) & F.col("invoice").isNotNull()
    return folded.withColumn("opens_invoice", opens)


def customer_fold() -> list[Column]:
    """Aggregates over folded invoice rows that any wider set of them can add up again."""
    amount, cancelled = F.col("amount"), F.col("is_cancellation")
    opens = F.col("opens_invoice")

    return [
        F.min("first_ts").alias("first_ts"),
        F.max("last_ts").alias("last_ts"),
        F.max("purchase_ts").alias("purchase_ts"),
        F.count_if(opens & ~cancelled).alias("orders"),
        F.count_if(opens & cancelled).alias("cancelled_orders"),
        money_sum(F.when(F.col("is_product"), amount)).alias("net"),
        money_sum(F.when(cancelled, amount)).alias("cancelled"),
        F.max(F.struct("last_ts", "invoice", "country")).alias("latest"),
    ]


def run_rate(
    tenure: Column, trailing: Column, total: Column, horizon_days: int, trailing_days: int
) -> Column:
    """Revenue expected over the horizon.

    With a full trailing window of history, that window scaled down; with less, the whole history
    spread over the tenure, which counts as no shorter than the horizon.
    """
    floor = F.greatest(tenure, F.lit(horizon_days))
    return F.when(tenure >= trailing_days, trailing * horizon_days / trailing_days).otherwise(
        total / floor * horizon_days
    )


def snapshot_columns(
    as_of: Column, horizon_days: int, trailing_days: int
) -> list[Column]:
    """The stored columns, from the customer fold plus ``trailing``."""
    tenure = days_until(as_of, F.col("first_ts"))
    total, trailing = money(F.col("net")), money(F.col("trailing"))
    columns = {
        "customer_id": F.col("customer_id"),
        "as_of_date": as_of,
        "first_purchase_date": F.col("first_ts"),
        "last_activity_date": F.col("last_ts"),
        "last_purchase_date": F.col("purchase_ts"),
        "recency_days": days_until(as_of, F.col("last_ts")),
        "tenure_days": tenure,
        "order_count": F.col("orders"),
        "cancelled_order_count": F.col("cancelled_orders"),
        "total_net_revenue": total,
        "trailing_12m_net_revenue": trailing,
        "cancelled_revenue": money(F.col("cancelled")),
        "run_rate_90d": run_rate(tenure, trailing, total, horizon_days, trailing_days),
        "country": F.col("latest.country"),
    }
    return [columns[f.name].cast(f.dataType).alias(f.name) for f in CUSTOMER_360_SCHEMA]


def customer_360(
    silver: DataFrame,
    as_of: str | date,
    churn_window_days: int = CHURN_WINDOW_DAYS,
    trailing_days: int = TRAILING_WINDOW_DAYS,
) -> DataFrame:
    """The snapshot of every customer with history before ``as_of``."""
    day = cutoff_date(as_of)
    trailing = F.when(F.col("is_product") & (F.col("period") == 1), F.col("amount"))
    return (
        fold_invoices(history_before(silver, day), in_trailing_window(day, trailing_days).cast("int"))
        .groupBy("customer_id")
        .agg(
            *customer_fold(),
            money_sum(trailing).alias("trailing"),
        )
        .select(snapshot_columns(F.lit(day), churn_window_days, trailing_days))
    )


# ---- the metrics one by one -------------------------------------------------------------------


def activity_dates(silver: DataFrame, as_of: str | date) -> DataFrame:
    """First line, last line and last purchase. The first two count lines of any kind."""
    return history_before(silver, as_of).groupBy("customer_id").agg(
        F.min("invoice_date").cast("date").alias("first_purchase_date"),
        F.max("invoice_date").cast("date").alias("last_activity_date"),
        F.max(F.when(is_purchase(), F.col("invoice_date"))).cast("date").alias("last_purchase_date"),
    )


def order_counts(silver: DataFrame, as_of: str | date) -> DataFrame:
    """Distinct invoices, kept and cancelled apart; an invoice of service lines is an order too."""
    invoices = history_before(silver, as_of).groupBy(*INVOICE_KEY).agg(F.count("*").alias("lines"))
    cancelled, numbered = F.col("is_cancellation"), F.col("invoice").isNotNull()
    return invoices.groupBy("customer_id").agg(
        F.count_if(numbered & ~cancelled).cast("int").alias("order_count"),
        F.count_if(numbered & cancelled).cast("int").alias("cancelled_order_count"),
    )


def _revenue(silver: DataFrame, as_of: str | date, condition: Column, name: str) -> DataFrame:
    total = money(exact_sum(F.col("line_revenue"), condition))
    return history_before(silver, as_of).groupBy("customer_id").agg(total.alias(name))


def net_revenue(silver: DataFrame, as_of: str | date) -> DataFrame:
    """Product revenue to date; cancellations net out."""
    return _revenue(silver, as_of, F.col("is_product"), "total_net_revenue")


def trailing_revenue(
    silver: DataFrame, as_of: str | date, trailing_days: int = TRAILING_WINDOW_DAYS
) -> DataFrame:
    """Product revenue of the trailing window, its first day included."""
    recent = in_trailing_window(cutoff_date(as_of), trailing_days)
    return _revenue(silver, as_of, F.col("is_product") & recent, "trailing_12m_net_revenue")


def cancelled_revenue(silver: DataFrame, as_of: str | date) -> DataFrame:
    """Revenue of all cancelled lines, service codes included; never positive."""
    return _revenue(silver, as_of, F.col("is_cancellation"), "cancelled_revenue")


def latest_country(silver: DataFrame, as_of: str | date) -> DataFrame:
    """Country of the latest line; ties go to the higher invoice, then the higher country.

    The dates are folded per invoice and country before the one row per customer is picked.
    """
    folded = (
        history_before(silver, as_of)
        .filter(F.col("customer_id").isNotNull())
        .groupBy("customer_id", "invoice", "country")
        .agg(F.max("invoice_date").alias("last_ts"))
    )
    latest = F.max(F.struct("last_ts", "invoice", "country"))
    return folded.groupBy("customer_id").agg(latest.getField("country").alias("country"))


# ---- the panel --------------------------------------------------------------------------------


def active_customers(snapshot: DataFrame, churn_window_days: int = CHURN_WINDOW_DAYS) -> DataFrame:
    """Customers whose last activity is at most the churn window before their cutoff."""
    return snapshot.filter(F.col("recency_days") <= churn_window_days)


def snapshot_slice(panel: DataFrame, as_of: str | date) -> DataFrame:
    """One cutoff of the panel; a partition filter on the stored table."""
    return panel.filter(F.col("as_of_date") == F.lit(cutoff_date(as_of)))


def snapshot_profile(snapshot: DataFrame, churn_window_days: int = CHURN_WINDOW_DAYS) -> DataFrame:
    """One row of totals over a snapshot; an empty snapshot gives zeros and null medians.

    The exact medians are over whole days, so their state is one counter per distinct day count.
    """
    customers, active = F.count("*"), F.count_if(F.col("recency_days") <= churn_window_days)
    return snapshot.agg(
        customers.alias("customers"),
        active.alias("active_customers"),
        F.when(customers > 0, active / customers * 100).otherwise(0.0).alias("active_percent"),
        F.count_if(F.col("last_purchase_date").isNull()).alias("no_purchase"),
        F.count_if(F.col("total_net_revenue") < 0).alias("net_negative"),
        F.median("recency_days").alias("median_recency_days"),
        F.max("recency_days").alias("max_recency_days"),
        F.median("tenure_days").alias("median_tenure_days"),
        F.max("tenure_days").alias("max_tenure_days"),
        money(exact_sum(F.col("total_net_revenue"))).alias("total_net_revenue"),
        money(exact_sum(F.col("run_rate_90d"))).alias("total_run_rate"),
    )
