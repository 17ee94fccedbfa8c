"""Data-quality reports as tidy rows: table, check, column, n_bad, n_rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hardwood.functions.cleaning import to_number
from hardwood.tables import QualityRules

MISSING = "missing"
DUPLICATE = "duplicate"
FORMAT = "format"
BUSINESS = "business_rule"

CORRUPT = "_corrupt_record"

# Code of one aggregate: a check on a number held as text takes about three times that of another.
TEXT_CHECK_COST = 3
AGGREGATE_BUDGET = 36


class MissingColumnsError(ValueError):
    """A source lacks columns its load cannot do without."""


def require_columns(df: DataFrame, names: Sequence[str]) -> None:
    """Raise before any job runs when ``df`` lacks one of ``names``."""
    absent = [name for name in names if name not in df.columns]
    if absent:
        raise MissingColumnsError(f"missing columns: {', '.join(absent)}")


def _number(name: str) -> Column:
    return F.col(f"_number_{name}")


def _with_numbers(df: DataFrame, rules: QualityRules) -> DataFrame:
    """``df`` with each checked number parsed once, as several checks look at it."""
    names = {*rules.numeric, *rules.numeric_and_present, *rules.non_negative, *(name for name, _, _ in rules.between)}
    return df.withColumns({
        f"_number_{name}": to_number(F.col(name)) if isinstance(df.schema[name].dataType, T.StringType)
        else F.col(name).cast("double")
        for name in names if name in df.columns
    })


def _row_checks(df: DataFrame, rules: QualityRules) -> list[tuple[str, str, Column]]:
    """All checks that look at one row at a time, as (check, column, row is bad)."""
    present = set(df.columns)
    checks: list[tuple[str, str, Column]] = []
    for name in rules.required:
        checks.append((MISSING, name, F.col(name).isNull()))
    for name in rules.numeric:
        if name in present:
            checks.append((FORMAT, name, F.col(name).isNotNull() & _number(name).isNull()))
    for name in rules.numeric_and_present:
        checks.append((FORMAT, name, _number(name).isNull()))
    for name in rules.boolean:
        if name in present:
            text = F.upper(F.trim(F.col(name).cast("string")))
            checks.append((FORMAT, name, ~F.coalesce(text.isin("TRUE", "FALSE"), F.lit(False))))
    if CORRUPT in present:
        checks.append((FORMAT, CORRUPT, F.col(CORRUPT).isNotNull()))
    for name in rules.non_negative:
        if name in present:
            checks.append((BUSINESS, name, _number(name) < 0))
    for name, low, high in rules.between:
        if name in present:
            checks.append((BUSINESS, name, ~_number(name).between(low, high)))
    return checks


def _count_bad(df: DataFrame, checks: Sequence[tuple[str, str, Column]]) -> DataFrame:
    """One row per check, from a single aggregate that sends one row per task."""
    totals = df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        *(F.count_if(bad).alias(f"_bad_{i}") for i, (_, _, bad) in enumerate(checks)),
    )
    lines = F.array(*(
        F.struct(F.lit(check).alias("check"), F.lit(column).alias("column"), F.col(f"_bad_{i}").alias("n_bad"))
        for i, (check, column, _) in enumerate(checks)
    ))
    return totals.select(F.inline(lines), "n_rows")


def quality(df: DataFrame, rules: QualityRules, table: str) -> DataFrame:
    """One row per check.

    Row checks are counted in groups of whole columns: a wide table in one
    aggregate would make generated code too large to be compiled. The loads call
    this on a staged columnar copy, so a source is parsed once and each group
    reads its own columns only. Duplicates are counted apart on
    the key columns alone: surplus rows per key, summed, which needs neither a
    distinct aggregate beside the others nor the remaining columns.
    """
    require_columns(df, dict.fromkeys((*rules.required, *rules.unique, *rules.numeric_and_present)))
    by_column: dict[str, list[tuple[str, str, Column]]] = {}
    for check in _row_checks(df, rules):
        by_column.setdefault(check[1], []).append(check)
    parsed = _with_numbers(df, rules)
    groups: list[list[tuple[str, str, Column]]] = [[]]
    spent = 0
    for column, checks in by_column.items():
        from_text = f"_number_{column}" in parsed.columns and isinstance(df.schema[column].dataType, T.StringType)
        cost = len(checks) * (TEXT_CHECK_COST if from_text else 1)
        if spent + cost > AGGREGATE_BUDGET:
            groups.append([])
            spent = 0
        groups[-1] += checks
        spent += cost
    by_row = reduce(DataFrame.unionByName, (_count_bad(parsed, group) for group in groups if group))
    per_key = df.groupBy(*rules.unique).agg(F.count(F.lit(1)).alias("n"))
    surplus = F.col("n") - 1
    if rules.null_keys_are_surplus:
        has_null = F.lit(False)
        for name in rules.unique:
            has_null = has_null | F.col(name).isNull()
        surplus = F.when(has_null, F.col("n")).otherwise(surplus)
    by_key = per_key.agg(
        F.lit(DUPLICATE).alias("check"),
        F.lit(", ".join(rules.unique)).alias("column"),
        F.coalesce(F.sum(surplus), F.lit(0)).alias("n_bad"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"),
    )
    return by_row.unionByName(by_key).select(F.lit(table).alias("table"), "check", "column", "n_bad", "n_rows")


def comment(report: Sequence[Row]) -> str:
    """The failed checks of a collected quality report as ``check column=rows``; ``clean`` if there are none."""
    failed = [f"{r.check} {r.column}={r.n_bad}" for r in report if r.n_bad]
    return ", ".join(failed) or "clean"


def text_lengths(df: DataFrame, table: str, limits: Mapping[str, int] | None = None, default: int = 100) -> DataFrame:
    """Longest text form per column against its limit; all columns when no limits are named. Warns, never cuts."""
    limits = limits or {name: default for name in df.columns}
    names = [name for name in limits if name in df.columns]
    longest = df.agg(*(F.max(F.length(F.col(name).cast("string"))).alias(name) for name in names))
    lines = F.array(*(
        F.struct(
            F.lit(name).alias("column"), F.col(name).alias("max_length"), F.lit(limits[name]).alias("length_limit"),
            F.coalesce(F.col(name) > limits[name], F.lit(False)).alias("too_long"),
        )
        for name in names
    ))
    return longest.select(F.lit(table).alias("table"), F.inline(lines))
