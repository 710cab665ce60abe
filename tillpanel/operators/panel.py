"""Snapshots of many cutoffs in one job.

Replaying the single-cutoff job reads all of silver once per cutoff. Here every line is read once:
the cutoffs and the starts of their trailing windows divide time into periods, lines are folded per
customer and period, and each cutoff adds up the periods before it. Periods start at midnight, so a
calendar with one row per day gives a line its period. After the fold a customer has at most two
rows per cutoff plus one, whatever the number of lines; the rows to be filled, one per cutoff, are
made from the customer's first.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillpanel.functions.cutoffs import cutoff_date
from tillpanel.functions.money import checked
from tillpanel.operators.snapshot import (
    customer_fold,
    fold_invoices,
    history_before,
    snapshot_columns,
)
from tillpanel.schemas import CHURN_WINDOW_DAYS, TRAILING_WINDOW_DAYS

_EPOCH = date(1970, 1, 1)


def _day_number(day: date) -> int:
    return (day - _EPOCH).days


def _calendar(spark: SparkSession, starts: list[date]) -> DataFrame:
    """Day and number of the period it falls in, from the first start to the last."""
    numbers = [_day_number(start) for start in starts]
    first = F.sequence(F.lit(numbers[0]), F.lit(numbers[-1]))
    opened = spark.createDataFrame([(n,) for n in numbers], "opened int")
    # One row per calendar day, from one row per period start.
    day_numbers = spark.range(1).select(F.explode(first).alias("day_number"))
    latest = Window.orderBy("day_number")
    return (
        day_numbers.join(F.broadcast(opened), F.col("day_number") == F.col("opened"), "left")
        .withColumn("period", F.last("opened", ignorenulls=True).over(latest))
        .select(F.date_add(F.lit(_EPOCH), F.col("day_number")).alias("calendar_day"), "period")
    )


def customer_panel(
    silver: DataFrame,
    cutoffs: Iterable[str | date],
    churn_window_days: int = CHURN_WINDOW_DAYS,
    trailing_days: int = TRAILING_WINDOW_DAYS,
) -> DataFrame:
    """One row per customer and cutoff with history before it, for all ``cutoffs``."""
    days = sorted({cutoff_date(c) for c in cutoffs})
    if not days:
        raise ValueError("a panel needs at least one cutoff")
    starts = sorted({*days, *(d - timedelta(days=trailing_days) for d in days)})

    before_all = _day_number(starts[0]) - 1
    dated = history_before(silver, days[-1]).join(
        F.broadcast(_calendar(silver.sparkSession, starts)),  # one row per calendar day
        F.col("invoice_date").cast("date") == F.col("calendar_day"),
        "left",
    )
    invoices = fold_invoices(dated, F.coalesce("period", F.lit(before_all)))
    folded = invoices.groupBy("customer_id", "period").agg(*customer_fold())

    facts = [c for c in folded.columns if c not in ("customer_id", "period")]
    kinds = dict(folded.dtypes)
    own = F.struct(F.lit(False).alias("wanted"), "period", *facts)
    to_fill = F.transform(
        F.filter(F.array(*[F.lit(_day_number(d)) for d in days]), lambda day: day > F.col("period")),
        lambda day: F.struct(
            F.lit(True).alias("wanted"), day.alias("period"),
            *[F.lit(None).cast(kinds[c]).alias(c) for c in facts],
        ),
    )
    by_period = Window.partitionBy("customer_id").orderBy("period")
    timeline = folded.withColumn("is_first", F.row_number().over(by_period) == 1).select(
        "customer_id",
        F.inline(F.when(F.col("is_first"), F.concat(F.array(own), to_fill)).otherwise(F.array(own))),
    )

    before = by_period.rangeBetween(Window.unboundedPreceding, -1)
    recent = by_period.rangeBetween(-trailing_days, -1)

    def total(name, window):
        return checked(F.try_sum(name).over(window), F.count(name).over(window))

    return (
        timeline.select(
            "customer_id",
            "wanted",
            F.date_add(F.lit(_EPOCH), F.col("period")).alias("as_of"),
            F.min("first_ts").over(before).alias("first_ts"),
            F.max("last_ts").over(before).alias("last_ts"),
            F.max("purchase_ts").over(before).alias("purchase_ts"),
            F.sum("orders").over(before).alias("orders"),
            F.sum("cancelled_orders").over(before).alias("cancelled_orders"),
            total("net", before).alias("net"),
            total("cancelled", before).alias("cancelled"),
            F.max("latest").over(before).alias("latest"),
            total("net", recent).alias("trailing"),
        )
        .filter("wanted")
        .select(snapshot_columns(F.col("as_of"), churn_window_days, trailing_days))
    )
