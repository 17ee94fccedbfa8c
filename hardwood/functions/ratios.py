"""Exact half-up ratios on integer aggregates.

Division in binary floating point, or in a decimal that was already rounded
once, can land on the wrong side of a tie. Whole numbers cannot.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _hundredths(numerator: Column, denominator: Column, scale: int) -> Column:
    top = F.abs(numerator.cast("bigint")) * F.lit(2 * scale) + F.abs(denominator.cast("bigint"))
    bottom = F.nullif(F.abs(denominator.cast("bigint")) * F.lit(2), F.lit(0).cast("bigint"))
    sign = (F.signum(numerator.cast("bigint")) * F.signum(denominator.cast("bigint"))).cast("bigint")
    return F.call_function("div", top, bottom) * sign


def ratio(numerator: Column, denominator: Column) -> Column:
    """``numerator / denominator`` to two decimals, half away from zero; NULL when the denominator is 0."""
    return _hundredths(numerator, denominator, 100).cast("double") / F.lit(100.0)


def percentage(numerator: Column, denominator: Column) -> Column:
    """``100 * numerator / denominator`` to two decimals, half away from zero; NULL when the denominator is 0."""
    return _hundredths(numerator, denominator, 10_000).cast("double") / F.lit(100.0)
