"""Newest stored version per key, kept beside an append-only stage table.

Stage keeps every version ever stored. Loads need the newest ones, so these lie in a slice of their own, in key-hash buckets. A slice is brought up
to date when it is read: rows of the runs it does not cover yet are merged into the buckets they fall into, and the other buckets
stay as they are. The rows that name the covered runs are exchanged together with the buckets, all or none, so a slice never claims a run it
does not hold. A slice can be deleted at any time; it is then built again from all versions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hardwood.operators.buckets import BUCKET, bucket_of, touched_buckets
from hardwood.operators.delta import key_match
from hardwood.operators.latest import STAMP
from hardwood.operators.publish import commit, finish_pending
from hardwood.session import materialize
from hardwood.storage import delete_path, path_exists

#: Column of a stage row that names the run that stored it.
RUN = "run"

#: Buckets of a slice. The covered runs lie in partition ``-BUCKETS``: a slice dealt into another number covers nothing and is built again.
BUCKETS = 32


def newest_path(path: str) -> str:
    """Where the newest versions of the stage table at ``path`` lie."""
    return f"{path.rstrip('/')}__newest"


def newest_versions(versions: DataFrame, keys: Sequence[str], stamp: str = STAMP) -> DataFrame:
    """The rows of staged ``versions`` with the newest stamp of their key.

    Rows that share it all stay, so that whoever reads them settles ties by its own rule; so do rows without a stamp.
    A NULL key matches itself. Stamps are folded per task before the shuffle, and rows of a repeated key are not gathered in one group.
    """
    stamps = versions.groupBy(*keys).agg(F.max(stamp).alias("_newest"))
    matched = versions.alias("v").join(stamps.alias("n"), key_match(keys, keys, "v", "n"))
    newest = F.col(f"v.{stamp}").isNull() | (F.col(f"v.{stamp}") == F.col("n._newest"))
    return matched.where(newest).select(*(F.col(f"v.{name}") for name in versions.columns))


def read_newest(versions: DataFrame, path: str, keys: Sequence[str]) -> DataFrame:
    """Columns of ``versions`` but the run, newest versions only, from the slice of the stage table at ``path``.

    ``versions`` are all its rows with their run; of the runs that the slice covers no file is read.
    """
    bring_up_to_date(versions, path, keys)
    return _slice(versions, path).where(F.col(BUCKET) >= 0).drop(BUCKET, RUN)


def bring_up_to_date(versions: DataFrame, path: str, keys: Sequence[str]) -> list[int]:
    """Merge the runs that the slice does not cover into it; returns the buckets that were rewritten."""
    spark, place = versions.sparkSession, newest_path(path)
    finish_pending(spark, place)
    covered = _covered(versions, path) if path_exists(spark, place) else set()
    missing = {row[0] for row in versions.select(RUN).distinct().collect()} - covered
    if not missing:
        return []
    if not covered:
        delete_path(spark, place)
    # Without a covered run all versions are read; else a condition on the partition column alone selects the new ones.
    added = versions.where(F.col(RUN).isin(*missing)) if covered else versions
    fresh = materialize(newest_versions(added, keys), "newest")
    buckets = touched_buckets(fresh, versions.schema, keys, BUCKETS)
    if covered:
        held = _slice(versions, path).where(F.col(BUCKET).isin(*buckets)).drop(BUCKET)
        fresh = newest_versions(held.unionByName(fresh), keys)
    marks = spark.createDataFrame([(run,) for run in sorted(covered | missing)], T.StructType([versions.schema[RUN]])).coalesce(1)
    rows = fresh.withColumn(BUCKET, bucket_of(versions.schema, keys, BUCKETS)).unionByName(
        marks.withColumn(BUCKET, F.lit(-BUCKETS)), allowMissingColumns=True
    )
    commit(rows, place, [BUCKET])
    return buckets


def forget(spark, path: str) -> None:
    """Delete the slice of the stage table at ``path``, before a run that it may cover is stored anew."""
    for left in (newest_path(path), f"{newest_path(path)}__pending"):
        if path_exists(spark, left):
            delete_path(spark, left)


def _slice(versions: DataFrame, path: str) -> DataFrame:
    schema = T.StructType([*versions.schema.fields, T.StructField(BUCKET, T.IntegerType())])
    return versions.sparkSession.read.schema(schema).parquet(newest_path(path))


def _covered(versions: DataFrame, path: str) -> set[str]:
    """Runs whose rows are in the slice: one row per load ever made."""
    return {row[0] for row in _slice(versions, path).where(F.col(BUCKET) == -BUCKETS).select(RUN).collect()}
