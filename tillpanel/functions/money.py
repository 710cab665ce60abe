"""Money and text forms that do not depend on row order or on the text quirks of doubles.

Adding doubles gives a different last digit for every order of the rows, so on a cluster the same
query would differ from run to run. Sums are taken over ``DECIMAL(38, 18)``, which holds every digit of a
price and totals below 1e20, and turned back to double once, at the end. What does not fit stops the job,
whatever the session's ANSI setting; nothing is lost silently.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tillpanel.functions.casting import strict_cast

MONEY_DECIMAL = "decimal(38,18)"


def exact(amount: Column) -> Column:
    """``amount`` as the decimal in which money is added up."""
    return strict_cast(amount, MONEY_DECIMAL, "amount")


def checked(total: Column, counted: Column) -> Column:
    """A ``try_sum`` of money that is null only over nothing: zero there, an error on overflow.

    ``counted`` is the number of amounts in the same group or window.
    """
    overflow = F.raise_error(F.lit(f"a total exceeds {MONEY_DECIMAL}")).cast(MONEY_DECIMAL)
    empty = F.lit(0).cast(MONEY_DECIMAL)
    return F.when(total.isNull() & (counted > 0), overflow).otherwise(F.coalesce(total, empty))


def money_sum(value: Column) -> Column:
    """Sum of decimals that are money already; zero over nothing."""
    return checked(F.try_sum(value), F.count(value))


def exact_sum(amount: Column, condition: Column | None = None) -> Column:
    """Decimal sum of the rows that meet ``condition``; zero when there are none."""
    value = exact(amount)
    return money_sum(value if condition is None else F.when(condition, value))


def money(amount: Column) -> Column:
    """A decimal total as the stored double type."""
    return amount.cast("double")


def double_key(value: Column) -> Column:
    """Text of a double, one for each value; negative zero is zero."""
    return (value + F.lit(0.0)).cast("string")


def double_text(value: Column) -> Column:
    """Plain text of a double with all its digits: no exponent from 1e-4 up to 1e15."""
    text = double_key(value)
    plain = F.regexp_replace(
        text.try_cast("decimal(38,18)").cast("string"), r"(\.[0-9]+?)0+$", "$1"
    )
    size = F.abs(value)
    # Between, the text has no exponent anyway. Small numbers may have digits beyond the 18th place.
    few = text.try_cast("decimal(38,18)").cast("double") == value
    by_plain = ((size >= 1e7) & (size < 1e15)) | ((size >= 1e-4) & (size < 1e-3) & few)
    return F.when(by_plain, plain).otherwise(text)
