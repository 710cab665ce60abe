"""Casts that fail, or report, instead of turning bad input into null."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def uncastable(value: Column, dtype: str) -> Column:
    """True where ``value`` is present but has no ``dtype`` form."""
    return value.isNotNull() & value.try_cast(dtype).isNull()


def strict_cast(value: Column, dtype: str, name: str) -> Column:
    """Cast that stops the job on a bad value whatever the session's ANSI setting."""
    complaint = F.concat(F.lit(f"{name}: no {dtype} in "), value.cast("string"))
    return F.when(uncastable(value, dtype), F.raise_error(complaint).cast(dtype)).otherwise(
        value.try_cast(dtype)
    )


def _number(value: Column, dtype: str) -> Column:
    # Text goes through a decimal, which keeps ids longer than a double can hold.
    return value.try_cast("decimal(38,12)" if dtype == "string" else dtype)


def no_whole_number(value: Column, dtype: str) -> Column:
    """True where an id is present but no whole number."""
    number = _number(value, dtype)
    return value.isNotNull() & (number.isNull() | (number != F.floor(number)))


def whole_number_text(value: Column, dtype: str, name: str) -> Column:
    """Text of an id that may arrive as a float (``13085.0`` -> ``13085``); a fraction is an error."""
    complaint = F.concat(F.lit(f"{name}: not a whole number: "), value.cast("string"))
    return F.when(no_whole_number(value, dtype), F.raise_error(complaint).cast("string")).otherwise(
        _number(value, dtype).try_cast("bigint").cast("string")
    )
