"""Cutoff dates: every gold function takes one, and reads only lines strictly before its midnight."""

from __future__ import annotations

from datetime import date, datetime, time, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F


def cutoff_date(cutoff: str | date) -> date:
    """The day of a cutoff given as ``YYYY-MM-DD`` or as a date; a time of day is cut off."""
    if isinstance(cutoff, str):
        cutoff = date.fromisoformat(cutoff)
    if not isinstance(cutoff, date):
        raise TypeError(f"no cutoff date in {cutoff!r}")
    return date(cutoff.year, cutoff.month, cutoff.day)


def midnight(day: date, days_earlier: int = 0) -> Column:
    """Zone-free timestamp literal for the start of ``day``, or of a day before it."""
    start = datetime.combine(day - timedelta(days=days_earlier), time.min)
    return F.lit(start.isoformat(sep=" ")).cast("timestamp_ntz")


def days_until(as_of: Column, timestamp: Column) -> Column:
    """Whole calendar days from the date of ``timestamp`` to ``as_of``."""
    return F.datediff(as_of, timestamp.cast("date"))
