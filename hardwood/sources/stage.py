"""Stage tables: append-only snapshots and season partitions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hardwood.operators.latest import STAMP
from hardwood.operators.newest import RUN, forget
from hardwood.operators.publish import commit, finish_pending
from hardwood.storage import delete_path, path_exists

__all__ = ["append", "delete_path", "path_exists", "replace_season", "stamp_literal", "stamped"]


def stamp_literal(run_at: dt.datetime) -> Column:
    """One load stamp for a whole run, so that a repeated run writes the same rows."""
    return F.lit(run_at.isoformat(sep=" ")).cast("timestamp_ntz")


def stamped(df: DataFrame, run_at: dt.datetime) -> DataFrame:
    return df.withColumn(STAMP, stamp_literal(run_at))


def append(df: DataFrame, path: str, run_at: dt.datetime) -> None:
    """Add rows as new versions; earlier versions stay.

    The rows of a run lie in a partition of their own, which is exchanged all or none: a run that is repeated
    after it died, or done twice, stores its rows once. The slice of newest versions may hold what such a run stored before, and is built again.
    """
    spark, run = df.sparkSession, run_at.strftime("r%Y%m%dT%H%M%S%f")
    finish_pending(spark, path)
    if path_exists(spark, f"{path}/{RUN}={run}"):
        forget(spark, path)
    commit(stamped(df, run_at).withColumn(RUN, F.lit(run)), path, [RUN])


def replace_season(df: DataFrame, path: str, year: int, run_at: dt.datetime) -> None:
    """Write one season's partition, all or none; loading a season again replaces it."""
    finish_pending(df.sparkSession, path)
    commit(stamped(df, run_at).withColumn("season", F.lit(year)), path, ["season"])
