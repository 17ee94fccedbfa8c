"""Row fingerprints that ignore formatting differences but not content.

One decision: a timestamp counts by its day, as sources stamp the same day
differently from load to load.
"""

from __future__ import annotations

from collections.abc import Collection, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hardwood.functions.cleaning import may_be_number

SEPARATOR = "\x1f"


# A number as it may be written; \\z as in ``cleaning``.
NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\z"


def plain_number(text: Column) -> Column:
    """One spelling for all digits-alike forms of a number's text: ``1949.0``, ``+01949`` and ``1949`` give ``1949``.

    Works on the text alone, so that numbers of any size or scale keep every
    digit that tells them apart.
    """
    steps = (
        (r"^\+", ""),
        (r"^(-?)(?=[.])", "$10"),  # a digit before the point
        (r"^(-?)0+(?=[0-9])", "$1"),  # zeros in front
        (r"(\.[0-9]*?)0+(?=[eE]|\z)", "$1"),  # zeros behind the point
        (r"\.(?=[eE]|\z)", ""),
        (r"[eE]\+?(-?)0*(?=[0-9])", "E$1"),
        (r"E-?0\z", ""),
        (r"^-?0(E.*)?\z", "0"),
    )
    for pattern, into in steps:
        text = F.regexp_replace(text, pattern, into)
    return text


def _normal_form(df: DataFrame, name: str, numeric: bool) -> Column:
    kind = df.schema[name].dataType
    value = F.col(name)
    if isinstance(kind, T.StringType):
        text = F.trim(value)
        if not numeric:
            return text
        return F.when(may_be_number(text) & text.rlike(NUMBER), plain_number(text)).otherwise(text)
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        # Whole numbers below 2^53 print without an exponent, like integers and their text.
        whole = (F.floor(value) == value) & (F.abs(value) < float(1 << 53))
        return F.when(whole, value.cast("decimal(20,0)").cast("string")).otherwise(plain_number(value.cast("string")))
    if isinstance(kind, T.NumericType):
        return plain_number(value.cast("string"))
    if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return F.date_format(value, "yyyy-MM-dd")
    return F.trim(value.cast("string"))


def row_hash(df: DataFrame, columns: Sequence[str], numeric: Collection[str] = ()) -> Column:
    """MD5 over the normal forms of ``columns``; NULL counts as empty text.

    ``numeric`` names text columns that hold numbers. Parts are kept apart by a
    control character, so ``ab``+``c`` and ``a``+``bc`` differ.
    """
    parts = [F.coalesce(_normal_form(df, name, name in numeric), F.lit("")) for name in columns]
    return F.md5(F.concat_ws(SEPARATOR, *parts))
