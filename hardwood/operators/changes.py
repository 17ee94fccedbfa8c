"""What a load changed: seasons and dimension keys, stored before the change is published and read by the marts.

A record is written first and may name more than was changed in the end (a run that died between, a key whose new
version equals the old): marts then fold a season again to the same rows. It is removed when all marts have been refreshed.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hardwood.storage import delete_path, path_exists

SEASON, TEAM, PLAYER = "season", "team", "player"
_SCHEMA = "kind string, value long, source string, run string"


def record(changed: DataFrame, path: str, source: str) -> None:
    """Store the distinct rows of ``changed`` (kind, value) as one more record of ``source``."""
    changed.select("kind", F.col("value").cast("long").alias("value")).distinct().write.parquet(f"{path}/source={source}/run={uuid.uuid4().hex}")


def recorded(spark: SparkSession, path: str) -> DataFrame:
    """kind, value, source and run of all records that no refresh has used up."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], _SCHEMA)
    return spark.read.schema(_SCHEMA).parquet(path)


def used_up(spark: SparkSession, path: str, runs: list[tuple[str, str]]) -> None:
    """Remove the records a refresh has read; later ones stay."""
    for source, run in runs:
        delete_path(spark, f"{path}/source={source}/run={run}")


def seasons_to_refold(changed: DataFrame, sources: list[str], fact: DataFrame, season: str, keys: dict[str, str]) -> list[int]:
    """Seasons that staged ``changed`` rows touch in a mart over ``fact``.

    These are the seasons that the ``sources`` name, and those in which a row of ``fact`` holds a changed dimension key (``keys``: kind to
    column). The fact is read for season and that column only, and only where a key of the kind has changed. Their number is that of seasons.
    """
    named = {r.value for r in changed.where((F.col("kind") == SEASON) & F.col("source").isin(*sources)).select("value").distinct().collect()}
    kinds = {r.kind for r in changed.select("kind").distinct().collect()}
    for kind, column in keys.items():
        if kind in kinds:
            ids = changed.where(F.col("kind") == kind).select(F.col("value").alias(column)).distinct()
            others = fact.where(~F.col(season).isin(*named)) if named else fact
            named |= {r[0] for r in others.select(season, column).join(ids, column, "left_semi").select(season).distinct().collect()}
    return sorted(named)
