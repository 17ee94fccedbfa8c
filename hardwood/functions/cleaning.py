"""Parsing and cleaning of raw stage values. Nothing here raises on bad input.

``try_cast`` answers a failed parse by way of an exception, many times the cost
of a good one, so text is cast only where that is likely to succeed.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accepted spellings. ``\z`` and not ``$``, which in Java also
# matches before a trailing line break.
DIGITS = r"^[0-9]+\z"


def is_digits(column: Column) -> Column:
    """True when the text holds ASCII digits only; NULL for NULL."""
    return column.rlike(DIGITS)


def numeric_id(column: Column) -> Column:
    """Text id as bigint; NULL when it is not all digits or does not fit."""
    return F.when(is_digits(column), column.try_cast("bigint"))


def may_be_number(text: Column) -> Column:
    """False for most text that is no number, and for spellings only Java takes for one: ``1d``, ``NaN``, ``0x1p3``.

    Looks at the last character and for an ``x``; a pattern for the whole number
    would cost four times as much as parsing it.
    """
    last = F.substring(text, -1, 1)
    return (last.between("0", "9") | (last == ".")) & ~text.contains("x") & ~text.contains("X")


def to_number(column: Column) -> Column:
    """Text as double; NULL when it is not a plain number. Spaces around it are allowed."""
    text = F.trim(column)
    return F.when(may_be_number(text), text.try_cast("double"))


def whole_number(column: Column) -> Column:
    """A count that may be written ``105`` or ``105.0``; NULL when it is not a number or does not fit."""
    return F.floor(to_number(column.cast("string")) + 0.5).try_cast("int")


def without_sentinel(column: Column, sentinel: str = "0") -> Column:
    """NULL in place of the value that stands for 'none'."""
    return F.nullif(column, F.lit(sentinel))


def season_year(season_id: Column) -> Column:
    """Start year of a season id such as ``22010``; the first character is the season kind."""
    return start_year(F.substr(season_id, F.lit(2)))


def start_year(column: Column) -> Column:
    """Text year as int; NULL when it is not all digits or does not fit."""
    return F.when(is_digits(column), column.try_cast("int"))


def season_label(start_year: Column) -> Column:
    """``2010`` becomes ``2010-2011``; NULL stays NULL."""
    return F.concat(start_year.cast("string"), F.lit("-"), (start_year + 1).cast("string"))


def us_date(column: Column) -> Column:
    """``MM-dd-yyyy`` text as a date; NULL when it is no such date."""
    return F.try_to_date(column, "MM-dd-yyyy")


def truth(column: Column) -> Column:
    """True for the text TRUE in any case, otherwise false, also for NULL."""
    return F.coalesce(F.upper(F.trim(column.cast("string"))) == "TRUE", F.lit(False))


def finite(column: Column) -> Column:
    """NULL in place of NaN."""
    return F.when(~F.isnan(column), column)


def any_distinct(pairs: list[tuple[Column, Column]]) -> Column:
    """True when any pair differs, with NULL as an ordinary value."""
    changed = F.lit(False)
    for left, right in pairs:
        changed = changed | ~left.eqNullSafe(right)
    return changed
