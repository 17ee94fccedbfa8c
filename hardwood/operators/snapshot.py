"""Comparison of a full source snapshot with an append-only stage table."""

from __future__ import annotations

from collections.abc import Collection, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hardwood.functions.hashing import row_hash
from hardwood.operators.delta import key_match
from hardwood.operators.latest import STAMP, first_per_key

NEW = "new"
CHANGED = "changed"
SAME = "unchanged"
DELETED = "deleted"

#: Column of a stage version that holds its row hash, as computed when the version was stored.
STORED_HASH = "row_hash"


def stored_hashes(
    stage: DataFrame, keys: Sequence[str], columns: Sequence[str], numeric: Collection[str] = (), stamp: str = STAMP
) -> DataFrame:
    """Keys, stamp and row hash of every stage version.

    Hashes kept with the versions are taken as they are; then only keys, stamp and hash are read, of tables of any width. Versions stored
    without one are hashed, and only while there are any does the scan read the other columns.
    """
    kept = [*keys, stamp]
    if STORED_HASH not in stage.columns:
        return stage.select(*kept, row_hash(stage, columns, numeric).alias(STORED_HASH))
    if stage.where(F.col(STORED_HASH).isNull()).isEmpty():
        return stage.select(*kept, STORED_HASH)
    return stage.select(*kept, F.coalesce(STORED_HASH, row_hash(stage, columns, numeric)).alias(STORED_HASH))


def snapshot_status(
    source: DataFrame,
    stage: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str],
    numeric: Collection[str] = (),
    stamp: str = STAMP,
    with_hash: bool = False,
) -> DataFrame:
    """Every key of either side once, with ``status``, the source's ``columns`` and, if asked for, their hash to store.

    The source row is compared with the latest stage version only. Where a key
    is repeated, both sides choose by the same rule, and a NULL key matches
    itself, so a second run finds nothing to do. Deleted keys have NULL in all
    non-key columns.
    """
    hashed = source.select(*columns, row_hash(source, columns, numeric).alias("_hash"))
    incoming = first_per_key(hashed, keys, [F.col("_hash").desc()])
    stored = first_per_key(
        stored_hashes(stage, keys, columns, numeric, stamp), keys, [F.col(stamp).desc_nulls_first(), F.col(STORED_HASH).desc()]
    ).select(*keys, F.col(STORED_HASH).alias("_stored"))
    status = (
        F.when(F.col("_stored").isNull(), NEW)
        .when(F.col("_hash").isNull(), DELETED)
        .when(F.col("_hash") == F.col("_stored"), SAME)
        .otherwise(CHANGED)
    )
    matched = incoming.alias("i").join(stored.alias("s"), key_match(keys, keys, "i", "s"), "full")
    return matched.select(
        *(F.coalesce(f"i.{name}", f"s.{name}").alias(name) if name in keys else F.col(f"i.{name}")
          for name in columns),
        status.alias("status"), *([F.col("_hash").alias(STORED_HASH)] if with_hash else []),
    )


def rows_to_append(classified: DataFrame) -> DataFrame:
    """New and changed rows, to be stored as the next version of their key."""
    return classified.where(F.col("status").isin(NEW, CHANGED)).drop("status")


def deleted_keys(classified: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys the source no longer has, each with its ``k:v`` text."""
    pairs = [F.concat(F.lit(f"{key}:"), F.coalesce(F.col(key).cast("string"), F.lit("None"))) for key in keys]
    return classified.where(F.col("status") == DELETED).select(
        *keys, F.concat_ws(", ", *pairs).alias("description")
    )
