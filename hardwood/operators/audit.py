"""Counts of what a load did, and what is left to load."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def load_audit(classified: DataFrame, *by: str) -> DataFrame:
    """Rows per ``status``, and per further columns such as the season."""
    return classified.groupBy(*by, "status").agg(F.count(F.lit(1)).alias("n_rows"))


def season_backlog(source: DataFrame, stage: DataFrame, season: str) -> DataFrame:
    """Seasons of ``source`` that ``stage`` holds no row of, with their source row counts."""
    waiting = source.where(F.col(season).isNotNull()).groupBy(season).agg(F.count(F.lit(1)).alias("n_rows"))
    return waiting.join(stage.select(season).distinct(), season, "left_anti")


def null_zero_counts(
    delta: DataFrame, null_columns: Sequence[str], stage: DataFrame, zero_columns: Sequence[str]
) -> DataFrame:
    """Rows with a NULL id in the delta and rows with the ``0`` sentinel in the stage, in two rows."""
    any_null = F.lit(False)
    for name in null_columns:
        any_null = any_null | F.col(name).isNull()
    any_zero = F.lit(False)
    for name in zero_columns:
        any_zero = any_zero | F.coalesce(F.col(name).cast("string") == "0", F.lit(False))
    return delta.agg(F.lit("null_ids").alias("check"), F.count_if(any_null).alias("n_rows")).unionByName(
        stage.agg(F.lit("zero_ids").alias("check"), F.count_if(any_zero).alias("n_rows"))
    )
