"""Newest row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

STAMP = "load_timestamp"


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence) -> DataFrame:
    """One row per key, the first in ``order``.

    ``row_number() = 1`` is planned with a group limit on both sides of the
    shuffle: each task sends at most one row per key, so a key that holds a
    third of all rows costs no more than any other.
    """
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.where(F.col("_rank") == 1).drop("_rank")


def latest(df: DataFrame, keys: Sequence[str], stamp: str = STAMP, ties: Sequence[str] | None = None) -> DataFrame:
    """Newest row per key. Equal stamps are settled by ``ties``, by default all other columns."""
    if ties is None:
        ties = [name for name in df.columns if name != stamp and name not in keys]
    return first_per_key(df, keys, [F.col(stamp).desc_nulls_first(), *(F.col(name).asc_nulls_last() for name in ties)])


def latest_of_few(df: DataFrame, keys: Sequence[str], attributes: Sequence[str], stamp: str = STAMP) -> DataFrame:
    """``latest`` for a small set of key and attribute values inside a very long table.

    Hash aggregation folds the rows to one per value set before anything is
    sorted or shuffled.
    """
    folded = df.groupBy(*keys, *attributes).agg(F.max(stamp).alias(stamp))
    return latest(folded, keys, stamp, attributes) if attributes else folded
