"""Data contracts: a strict column set plus rules, all counted in one pass over the data.

A contract is plain data. ``violations`` turns it into one aggregate with a conditional count per rule
(no UDF, one scan, one row per partition shuffled); with a uniqueness rule the rows are folded by its key
first, in the same pass. ``enforce`` is the gate a build passes before it publishes anything.
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterable
from dataclasses import dataclass, replace
from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillpanel.schemas import (
    BRONZE_SCHEMA,
    CUSTOMER_360_SCHEMA,
    CUSTOMER_ID_PATTERN,
    DATASET_WINDOW,
    INVOICE_PATTERN,
    PRODUCT_CODE_PATTERN,
    SILVER_SCHEMA,
)

logger = logging.getLogger(__name__)

# Column name under which rules over whole rows are reported.
WHOLE_ROW = "<row>"


@dataclass(frozen=True)
class Check:
    """A named condition on one column; null values are the business of the not-null rule."""

    name: str
    holds: Callable[[Column], Column]


@dataclass(frozen=True)
class RowRule:
    """A named condition over several columns of a row."""

    name: str
    holds: Callable[[], Column]


@dataclass(frozen=True)
class ColumnRule:
    name: str
    dtype: T.DataType
    nullable: bool = False
    unique_with: tuple[str, ...] | None = None
    checks: tuple[Check, ...] = ()


@dataclass(frozen=True)
class Contract:
    name: str
    columns: tuple[ColumnRule, ...]
    rows: tuple[RowRule, ...] = ()


class ContractViolation(Exception):
    """Raised by ``enforce``; ``violations`` holds (column, check, failing rows), all of them."""

    def __init__(self, contract: str, violations: list[tuple[str, str, int | None]]):
        self.contract, self.violations = contract, violations
        listed = "; ".join(f"{column}: {check} ({rows})" for column, check, rows in violations)
        super().__init__(f"contract {contract!r} violated: {listed}")


def at_least(bound: float) -> Check:
    return Check(f">= {bound}", lambda c: c >= bound)


def at_most(bound: float) -> Check:
    return Check(f"<= {bound}", lambda c: c <= bound)


def differs_from(value: float) -> Check:
    return Check(f"<> {value}", lambda c: c != value)


def matches(pattern: str) -> Check:
    return Check(f"matches {pattern}", lambda c: c.rlike(pattern))


def within(window: tuple[datetime, datetime]) -> tuple[Check, Check]:
    """The two checks of a half-open time window."""
    start, end = (F.lit(t.isoformat(sep=" ")).cast("timestamp_ntz") for t in window)
    return (
        Check(f">= {window[0]}", lambda c: c >= start),
        Check(f"< {window[1]}", lambda c: c < end),
    )


def _columns(schema: T.StructType, **rules: dict) -> tuple[ColumnRule, ...]:
    return tuple(
        replace(ColumnRule(f.name, f.dataType, f.nullable), **rules.get(f.name, {})) for f in schema
    )


def bronze_contract(window: tuple[datetime, datetime] = DATASET_WINDOW) -> Contract:
    """Loose: admits the dirt silver is there to remove, but not a missing value or an odd date."""
    return Contract(
        "bronze.transactions", _columns(BRONZE_SCHEMA, invoice_date={"checks": within(window)})
    )


def silver_contract(
    window: tuple[datetime, datetime] = DATASET_WINDOW,
    invoice_pattern: str = INVOICE_PATTERN,
    customer_id_pattern: str = CUSTOMER_ID_PATTERN,
    product_code_pattern: str = PRODUCT_CODE_PATTERN,
) -> Contract:
    """Strict: known dirt is gone by now, so whatever fails is a surprise."""
    residual = lambda: F.abs(F.col("line_revenue") - F.col("quantity") * F.col("unit_price"))
    cancelled = lambda: F.col("is_cancellation")
    return Contract(
        "silver.transactions",
        _columns(
            SILVER_SCHEMA,
            invoice={"checks": (matches(invoice_pattern),)},
            quantity={"checks": (differs_from(0),)},
            invoice_date={"checks": within(window)},
            unit_price={"checks": (at_least(0),)},
            customer_id={"checks": (matches(customer_id_pattern),)},
        ),
        (
            RowRule("revenue is units times price", lambda: residual() <= 1e-9),
            RowRule(
                "goods come back on cancellations and only there",
                lambda: cancelled() == (F.col("quantity") < 0),
            ),
            RowRule(
                "cancellation flag agrees with the invoice number",
                lambda: cancelled() == F.col("invoice").startswith("C"),
            ),
            RowRule(
                "product flag agrees with the shape of the code",
                lambda: F.col("is_product") == F.col("stock_code").rlike(product_code_pattern),
            ),
        ),
    )


def customer_360_contract(customer_id_pattern: str = CUSTOMER_ID_PATTERN) -> Contract:
    """For one slice or a whole panel: a customer occurs once per cutoff."""
    counts = {"checks": (at_least(0),)}
    return Contract(
        "gold.customer_360",
        _columns(
            CUSTOMER_360_SCHEMA,
            customer_id={"unique_with": ("as_of_date",), "checks": (matches(customer_id_pattern),)},
            recency_days=counts,
            tenure_days=counts,
            order_count=counts,
            cancelled_order_count=counts,
            cancelled_revenue={"checks": (at_most(0),)},
        ),
        (
            RowRule(
                "last seen no earlier than first seen, in days",
                lambda: F.col("recency_days") <= F.col("tenure_days"),
            ),
            RowRule(
                "dates of first and last line in order",
                lambda: F.col("first_purchase_date") <= F.col("last_activity_date"),
            ),
        ),
    )


def schema_differences(columns: Iterable[str], contract: Contract) -> list[tuple[str, str]]:
    """Columns the contract misses and columns it does not know; needs no job."""
    present = list(columns)
    expected = [rule.name for rule in contract.columns]
    return [(c, "missing column") for c in expected if c not in present] + [
        (c, "unexpected column") for c in present if c not in expected
    ]


def schema_difference_report(frame: DataFrame, contract: Contract) -> DataFrame:
    """The column differences of ``frame``; for a surplus column also how many values it holds."""
    found = schema_differences(frame.columns, contract)
    if not found:
        return frame.sparkSession.createDataFrame(
            [], "column_name string, problem string, values bigint"
        )
    surplus = [c for c in frame.columns if (c, "unexpected column") in found]
    # An aggregate has its one row over an empty frame, too.
    counted = frame.agg(F.count("*").alias("rows"), *[F.count(F.col(f"`{c}`")).alias(f"surplus_{c}") for c in surplus])
    differences = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.lit(problem).alias("problem"),
            (F.col(f"`surplus_{c}`") if c in surplus else F.lit(0)).cast("bigint").alias("values"),
        )
        for c, problem in found
    ]
    return counted.select(F.inline(F.array(*differences)))


def _is_coerced(frame: DataFrame, rule: ColumnRule) -> bool:
    return frame.schema[rule.name].dataType != rule.dtype


def coerce(frame: DataFrame, contract: Contract, beside: tuple[str, ...] = ()) -> DataFrame:
    """The contract's columns in its types; what cannot be cast turns null (and is a violation).

    Columns ``beside`` the contract's stay as they are.
    """
    typed = [
        F.col(rule.name).try_cast(rule.dtype).alias(rule.name)
        if _is_coerced(frame, rule)
        else F.col(rule.name)
        for rule in contract.columns
    ]
    return frame.select(*typed, *beside)


def _original(rule: ColumnRule) -> str:
    return f"original_{rule.name}"


def _with_originals(frame: DataFrame, contract: Contract) -> DataFrame:
    """Coerced columns, plus the original of every column whose type had to change."""
    originals = {_original(r): F.col(r.name) for r in contract.columns if _is_coerced(frame, r)}
    coerced = {
        r.name: F.col(r.name).try_cast(r.dtype) for r in contract.columns if _is_coerced(frame, r)
    }
    return frame.withColumns(originals).withColumns(coerced) if originals else frame


def _missing(column: Column, dtype: T.DataType) -> Column:
    """Null, and for floating point also NaN."""
    if isinstance(dtype, T.DoubleType):
        return column.isNull() | F.isnan(column)
    return column.isNull()


def _counted_rules(frame: DataFrame, contract: Contract) -> list[tuple[str, str, Column]]:
    """(column, check, condition of a failing row), in contract order."""
    rules: list[tuple[str, str, Column]] = []
    for rule in contract.columns:
        column = F.col(rule.name)
        missing = _missing(column, rule.dtype)
        if _is_coerced(frame, rule):
            original = F.col(_original(rule))
            lost = original.isNotNull() & column.isNull()
            rules.append((rule.name, f"castable to {rule.dtype.simpleString()}", lost))
            missing = missing & ~lost
        if not rule.nullable:
            rules.append((rule.name, "not null", missing))
        rules += [(rule.name, check.name, ~check.holds(column)) for check in rule.checks]
    return rules + [(WHOLE_ROW, rule.name, ~rule.holds()) for rule in contract.rows]


def _unique_key(rule: ColumnRule) -> tuple[str, ...]:
    return (rule.name, *rule.unique_with)


def _rule_totals(frame: DataFrame, contract: Contract, rules: list) -> DataFrame:
    """One row: ``rule_i`` per rule, and ``repeated_i`` per uniqueness rule.

    The rules are counted while the rows are folded by the first unique key, so both come from one pass; only
    a further key needs a grouping of its own.
    """
    counts = [F.count_if(failing).alias(f"rule_{i}") for i, (_, _, failing) in enumerate(rules)]
    prepared = _with_originals(frame, contract)
    unique = [rule for rule in contract.columns if rule.unique_with is not None]
    if not unique:
        return prepared.agg(*counts)

    def repeated(rule, i):
        counted = F.col(rule.name).isNotNull() & (F.col("copies") > 1)
        return F.coalesce(F.sum(F.when(counted, F.col("copies"))), F.lit(0)).alias(f"repeated_{i}")

    first, *others = unique
    folded = prepared.groupBy(*_unique_key(first)).agg(F.count("*").alias("copies"), *counts)
    totals = folded.agg(
        *[F.coalesce(F.sum(f"rule_{i}"), F.lit(0)).alias(f"rule_{i}") for i in range(len(rules))],
        repeated(first, 0),
    )
    for i, rule in enumerate(others, start=1):
        copies = prepared.groupBy(*_unique_key(rule)).agg(F.count("*").alias("copies"))
        totals = totals.crossJoin(F.broadcast(copies.agg(repeated(rule, i))))  # one row each
    return totals


def violations(frame: DataFrame, contract: Contract) -> DataFrame:
    """(column_name, check_name, failing_rows) of every rule, zero where it holds.

    The frame must have the contract's columns; see ``schema_differences``. Checks and row rules see
    the values the published table would hold. A row with a null fails the not-null rule only.
    """
    rules = _counted_rules(frame, contract)
    unique = [rule for rule in contract.columns if rule.unique_with is not None]
    named = [(column, check, f"rule_{i}") for i, (column, check, _) in enumerate(rules)]
    named += [(rule.name, "unique", f"repeated_{i}") for i, rule in enumerate(unique)]
    labelled = F.array(
        *[
            F.struct(
                F.lit(column).alias("column_name"),
                F.lit(check).alias("check_name"),
                F.col(count).alias("failing_rows"),
            )
            for column, check, count in named
        ]
    )
    return _rule_totals(frame, contract, rules).select(F.inline(labelled))


def _rejected(contract: Contract, failed: list[tuple[str, str, int | None]]) -> None:
    """Log one line per violated check and raise, if there is any."""
    for column, check, rows in failed:
        logger.error("%s: %s is not met: %s (rows: %s)", contract.name, column, check, rows)
    if failed:
        raise ContractViolation(contract.name, failed)
    logger.info("%s: all rules met", contract.name)


def enforce(frame: DataFrame, contract: Contract) -> DataFrame:
    """Check everything, log one line per violated check, raise if there is any.

    Returns the frame in the contract's column order and types. Only the rule counts, a few dozen
    numbers, reach the driver.
    """
    failed: list[tuple[str, str, int | None]] = [
        (column, problem, None) for column, problem in schema_differences(frame.columns, contract)
    ]
    if not failed:
        failed = [
            (row.column_name, row.check_name, row.failing_rows)
            for row in violations(frame, contract).filter("failing_rows > 0").collect()
        ]
    _rejected(contract, failed)
    return coerce(frame, contract)


def _unmatched(columns: Iterable[str], contract: Contract) -> None:
    if differing := schema_differences(columns, contract):
        _rejected(contract, [(column, problem, None) for column, problem in differing])


def _repeated(written: DataFrame, contract: Contract) -> list[tuple[str, str, int]]:
    """Violated uniqueness rules; reads the key columns of ``written``, if there are any."""
    unique = tuple(replace(r, nullable=True, checks=()) for r in contract.columns if r.unique_with is not None)
    if not unique:
        return []
    found = violations(written, replace(contract, columns=unique, rows=())).filter("failing_rows > 0")
    return [(row.column_name, row.check_name, row.failing_rows) for row in found.collect()]


class ReadingAudit:
    """A contract whose rules are counted by an aggregate of the caller's, before a frame is written.

    ``marked`` gives the frame with a mark per rule and row, ``counts`` the aggregates over the marks, and
    ``settle`` raises if one of them is not zero. Only uniqueness reads the written table.
    """

    def __init__(self, contract: Contract, prefix: str):
        self.contract, self._prefix = contract, prefix
        self._rules: list[tuple[str, str]] = []

    @property
    def _marks(self) -> list[str]:
        return [f"{self._prefix}_{i}" for i in range(len(self._rules))]

    def marked(self, frame: DataFrame, beside: tuple[str, ...] = ()) -> DataFrame:
        """``frame`` in the contract's types, with marks; columns ``beside`` the contract's stay as they are."""
        _unmatched([c for c in frame.columns if c not in beside], self.contract)
        rules = _counted_rules(frame, self.contract)
        self._rules = [(column, check) for column, check, _ in rules]
        failing = [condition.alias(mark) for mark, (_, _, condition) in zip(self._marks, rules, strict=True)]
        kept = [*[rule.name for rule in self.contract.columns], *beside]
        return _with_originals(frame, self.contract).select(*kept, *failing)

    @property
    def beside(self) -> tuple[str, ...]:
        """The columns of the marks."""
        return tuple(self._marks)

    def counts(self, among: Column | None = None) -> list[Column]:
        """Failing rows of each rule, of those that meet ``among``."""
        return [F.count_if(F.col(m) if among is None else among & F.col(m)).alias(m) for m in self._marks]

    def settle(self, counted: dict[str, int], written: DataFrame | None = None) -> None:
        """Raise if a rule was violated by what ``counts`` gave, or a uniqueness rule by ``written``."""
        failed = [(*rule, counted[m]) for m, rule in zip(self._marks, self._rules, strict=True) if counted.get(m)]
        _rejected(self.contract, failed + (_repeated(written, self.contract) if written is not None else []))


class WritingAudit:
    """A contract whose rules are counted while a frame is written, without a read of their own.

    ``watched`` gives the frame to write; ``settle`` raises after the write if a rule was not met. Only
    uniqueness, for which rows of one key must meet, reads the written table again, and of that the
    key columns. Parts of a write that are repeated after the loss of an executor may be counted twice:
    when their number of rows is not that of the written table, the rules are counted anew from it.
    """

    def __init__(self, contract: Contract):
        self.contract = contract
        self._counted = Observation(f"rules of {contract.name}")
        self._rules: list[tuple[str, str]] = []

    def watched(self, frame: DataFrame, beside: tuple[str, ...] = ()) -> DataFrame:
        """``frame`` in the contract's types; columns ``beside`` the contract's stay as they are."""
        own = [c for c in frame.columns if c not in beside]
        _unmatched(own, self.contract)
        prepared = _with_originals(frame, self.contract)
        rules = _counted_rules(frame, self.contract)
        self._rules = [(column, check) for column, check, _ in rules]
        counts = [F.count_if(failing).alias(f"rule_{i}") for i, (_, _, failing) in enumerate(rules)]
        counts = [F.count("*").alias("rows"), *counts]
        kept = [*[rule.name for rule in self.contract.columns], *beside]
        return prepared.observe(self._counted, *counts).select(kept)

    @property
    def rows(self) -> int:
        """Rows that went by."""
        return self._counted.get["rows"]

    def settle(self, written: DataFrame | None = None) -> None:
        """Raise if a rule was violated. ``written`` holds the rows that went by, and nothing else.

        Its number of rows comes from the footers of its files.
        """
        if written is not None and self.rows != written.count():
            enforce(written, self.contract)
            return
        counted = self._counted.get
        failed = [(*rule, counted[f"rule_{i}"]) for i, rule in enumerate(self._rules) if counted[f"rule_{i}"]]
        _rejected(self.contract, failed + _repeated(written, self.contract))


def describe(contract: Contract) -> list[tuple[str, str, bool | None, str]]:
    """(column, type, nullable, check) for every rule of a contract, in contract order."""
    rows: list[tuple[str, str, bool | None, str]] = []
    for rule in contract.columns:
        dtype = rule.dtype.simpleString()
        named = [] if rule.nullable else ["not null"]
        named += [check.name for check in rule.checks]
        named += ["unique"] if rule.unique_with is not None else []
        rows += [(rule.name, dtype, rule.nullable, name) for name in named or [""]]
    return rows + [(WHOLE_ROW, "", None, rule.name) for rule in contract.rows]


def contract_report(frame: DataFrame, contract: Contract) -> DataFrame:
    """The description of a contract with the failing rows of each check on ``frame``."""
    described = frame.sparkSession.createDataFrame(
        describe(contract),
        "column_name string, data_type string, nullable boolean, check_name string",
    )
    # Both sides have one row per rule of the contract.
    return described.join(
        F.broadcast(violations(frame, contract)), ["column_name", "check_name"], "left"
    ).select("column_name", "data_type", "nullable", "check_name", "failing_rows")
