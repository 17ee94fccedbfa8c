"""Schema alignment, required values and key uniqueness."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

EPOCH = "1970-01-01 00:00:00"

# What an older table gets for columns it lacks.
COLUMN_DEFAULTS: dict[str, Any] = {
    "load_timestamp": EPOCH,
    "valid_from": EPOCH,
    "valid_to": None,
    "is_active": True,
}


class DuplicateKeyError(ValueError):
    """A table that must be unique on its key is not."""


def align(df: DataFrame, schema: T.StructType, defaults: Mapping[str, Any] = COLUMN_DEFAULTS) -> DataFrame:
    """``df`` with exactly the columns, order and types of ``schema``.

    A missing column is filled from ``defaults``; without a default there it is an error.
    """
    columns = []
    for field in schema.fields:
        if field.name in df.columns:
            value = F.col(field.name)
        elif field.name in defaults:
            value = F.lit(defaults[field.name])
        else:
            raise ValueError(f"column {field.name} is missing and has no default")
        columns.append(value.cast(field.dataType).alias(field.name))
    return df.select(*columns)


def fill_defaults(df: DataFrame, names: Sequence[str], defaults: Mapping[str, Any] = COLUMN_DEFAULTS) -> DataFrame:
    """Defaults in place of NULL, as rows written before a column existed would read."""
    return df.withColumns({
        name: F.coalesce(F.col(name), F.lit(defaults[name]).cast(df.schema[name].dataType))
        for name in names if name in df.columns
    })


def missing_required(columns: Sequence[str]) -> Column:
    """``null_<column>`` for the first required column that is NULL, else NULL."""
    return F.coalesce(*(F.when(F.col(name).isNull(), F.lit(f"null_{name}")) for name in columns))


def repeated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys held by more than one row, with their number of rows. NULL is an ordinary value."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).where(F.col("n_rows") > 1)


def check_unique(df: DataFrame, keys: Sequence[str], name: str) -> None:
    """Raise when any key occurs twice; run before a table is published."""
    offender = repeated_keys(df, keys).limit(1).collect()
    if offender:
        raise DuplicateKeyError(f"{name}: key {offender[0].asDict()} is not unique")
