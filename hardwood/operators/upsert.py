"""Timestamped upsert."""

from __future__ import annotations

from collections.abc import Collection, Sequence

from pyspark.sql import DataFrame

from hardwood.operators.delta import key_match


def without_keys(target: DataFrame, changes: DataFrame, keys: Sequence[str],
                 nullable: Collection[str] = ()) -> DataFrame:
    """Rows of ``target`` whose key does not occur in ``changes``."""
    return target.alias("t").join(
        changes.select(*keys).alias("c"), key_match(keys, nullable, "t", "c"), "left_anti"
    )


def upsert(target: DataFrame, changes: DataFrame, keys: Sequence[str], nullable: Collection[str] = ()) -> DataFrame:
    """``target`` with the rows of ``changes`` put in place of, or beside, its own.

    ``changes`` holds one row per key and only rows that win, as returned by
    ``newer_than_target``; columns ``target`` does not have are ignored.
    """
    return without_keys(target, changes, keys, nullable).unionByName(changes.select(target.columns))
