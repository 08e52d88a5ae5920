"""Data-quality operators: rules, error codes, splits and reconciliation."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.dates import looks_iso
from ledgerloom.operators.keys import drop_marked_copies, row_marks


class ReconciliationError(ValueError):
    """Totals that must agree do not."""


class RuleViolation(ValueError):
    """A table breaks rules it must keep; ``violations`` counts rows per rule."""

    def __init__(self, what: str, violations: dict[str, int]):
        self.violations = violations
        listed = ", ".join(f"{name}: {n}" for name, n in violations.items())
        super().__init__(f"{what} breaks its rules ({listed})")


@dataclass(frozen=True)
class Rule:
    """A named condition that marks a row as failing. Null does not fail."""

    name: str
    fails: Column


def require_columns(df: DataFrame, required: Sequence[str]) -> None:
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"Missing required columns: {', '.join(missing)}")


# --- one status, or all error codes, per row ---------------------------------


def first_failure(rules: Sequence[Rule], otherwise: str = "VALID") -> Column:
    """Name of the first rule the row fails, in the order given."""
    # Folded from the last rule backwards, so that the first rule decides.
    return reduce(
        lambda rest, rule: F.when(rule.fails, F.lit(rule.name)).otherwise(rest),
        reversed(rules),
        F.lit(otherwise),
    )


def error_codes(rules: Sequence[Rule]) -> Column:
    """Names of all rules the row fails; an empty array for a good row."""
    return F.array_compact(F.array(*[F.when(r.fails, F.lit(r.name)) for r in rules]))


def order_time_rules(
    date_raw: str, date: str, stamp_raw: str, stamp: str, single: bool = False
) -> list[Rule]:
    """Rules for a raw order date and a raw change timestamp with parsed twins.

    ``single`` is the variant for a single status per row: there a missing
    timestamp counts as an invalid one and has no code of its own.
    """
    # The error codes.
    raw, day = F.col(date_raw), F.col(date)
    raw_stamp, moment = F.col(stamp_raw), F.col(stamp)
    rules = [
        Rule("MISSING_ORDER_DATE", raw.isNull()),
        Rule("INVALID_DATE_FORMAT", ~looks_iso(raw)),
        Rule("INVALID_DATE_VALUE", day.isNull() & looks_iso(raw)),
    ]
    if single:
        return [*rules, Rule("INVALID_TIMESTAMP", moment.isNull())]
    return [
        *rules,
        Rule("MISSING_UPDATED_AT", raw_stamp.isNull()),
        Rule("INVALID_TIMESTAMP", moment.isNull() & raw_stamp.isNotNull()),
    ]


def split_on_errors(df: DataFrame, errors: str) -> tuple[DataFrame, DataFrame]:
    """Rows without errors, and rows with at least one."""
    return df.filter(F.size(errors) == 0), df.filter(F.size(errors) > 0)


# --- totals that must agree --------------------------------------------------


def reconcile_split(df: DataFrame, is_valid: Column, amounts: Sequence[str]) -> DataFrame:
    """One row of counts and sums for all, valid and quarantined rows.

    Everything comes out of one pass. A sum over no rows is 0 rather than null.
    """

    def total(column: str, which: Column | None = None) -> Column:
        value = F.col(column) if which is None else F.when(which, F.col(column))
        return F.coalesce(F.sum(value), F.lit(0))

    measures = [
        F.count("*").alias("source_rows"),
        F.count_if(is_valid).alias("valid_rows"),
        F.count_if(~is_valid).alias("quarantine_rows"),
    ]
    for column in amounts:
        measures += [
            total(column).alias(f"source_{column}"),
            total(column, is_valid).alias(f"valid_{column}"),
            total(column, ~is_valid).alias(f"quarantine_{column}"),
        ]
    return df.agg(*measures)


def require_split_reconciled(report: DataFrame) -> dict:
    """Raise unless source = valid + quarantine for the rows and every amount."""
    totals = report.first().asDict()
    for name, source in totals.items():
        if not name.startswith("source_"):
            continue
        measure = name.removeprefix("source_")
        parts = totals[f"valid_{measure}"] + totals[f"quarantine_{measure}"]
        if source != parts:
            raise ReconciliationError(f"{measure}: source {source}, valid + quarantine {parts}")
    return totals


def compare_totals(
    left: DataFrame, left_sums: dict[str, Column], right: DataFrame, right_sums: dict[str, Column]
) -> DataFrame:
    """One row per measure: its total on both sides, and whether they are equal.

    Totals are compared in the type that each sum has; ``left_total`` and
    ``right_total`` show them as DOUBLE.
    """

    def totals(df: DataFrame, sums: dict[str, Column], side: str) -> DataFrame:
        return df.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(f"{side}_{n}") for n, c in sums.items()])

    both = totals(left, left_sums, "left").unionByName(
        totals(right, right_sums, "right"), allowMissingColumns=True
    )
    one = both.agg(*[F.max(c).alias(c) for c in both.columns])
    entries = [
        F.struct(
            F.lit(name).alias("measure"),
            F.col(f"left_{name}").cast("double").alias("left_total"),
            F.col(f"right_{name}").cast("double").alias("right_total"),
            F.col(f"left_{name}").eqNullSafe(F.col(f"right_{name}")).alias("equal"),
        )
        for name in left_sums
    ]
    return one.select(F.inline(F.array(*entries)))


def require_totals_equal(comparison: DataFrame) -> None:
    """Raise if any measure differs between the two sides."""
    off = comparison.filter(~F.col("equal")).collect()
    if off:
        told = ", ".join(f"{r['measure']}: {r['left_total']} / {r['right_total']}" for r in off)
        raise ReconciliationError(f"totals differ ({told})")


def long_form(row: DataFrame, name: str, value: str) -> DataFrame:
    """Turn a one-row frame into one row per column (name, value)."""
    entries = F.array(
        *[F.struct(F.lit(c).alias(name), F.col(c).alias(value)) for c in row.columns]
    )
    return row.select(F.inline(entries))


# --- rule counts -------------------------------------------------------------


def violation_counts(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Rows failing each rule, as (``rule``, ``violations``), in one pass."""
    counted = df.agg(*[F.count_if(r.fails).alias(r.name) for r in rules])
    return long_form(counted, "rule", "violations")


def require_no_violations(counts: DataFrame, what: str) -> None:
    """Raise ``RuleViolation`` listing every rule with a count above zero."""
    broken = counts.filter("violations > 0").collect()
    if broken:
        raise RuleViolation(what, {r[0]: r[1] for r in broken})


def attrition_report(
    df: DataFrame,
    rules: Sequence[Rule],
    kept: str = "kept",
    read: Callable[[DataFrame], DataFrame] = lambda df: df,
) -> DataFrame:
    """How many rows each cleaning step removes, as (``step``, ``row_count``).

    Exact copies beyond the first are removed before any rule counts a row.
    ``rules`` are conditions over the raw columns and those that ``read`` adds; a row counts
    under the first rule it fails. Copies agree in every rule, so each row's step is found first,
    and what is grouped to find the copies are steps and ``row_marks`` instead of whole rows.
    """
    read_rows = read(df.withColumns(row_marks(df))).withColumn("step", first_failure(rules, kept))
    distinct = drop_marked_copies(read_rows.select("step", "_mark_a", "_mark_b", "_mark_check"), "_copies")
    steps = distinct.groupBy("step").agg(
        F.count("*").alias("row_count"), F.sum(F.col("_copies") - 1).alias("_extra")
    )
    entries = F.array(
        F.struct(F.col("step"), F.col("row_count")),
        F.struct(F.lit("exact_duplicate").alias("step"), F.col("_extra").alias("row_count")),
    )
    return (
        steps.select(F.inline(entries)).groupBy("step").agg(F.sum("row_count").alias("row_count"))
    )
