"""The yearly shot file: typed scan, cleaning, and the split into valid and rejected rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hardwood.functions.cleaning import finite, truth, us_date
from hardwood.operators.constraints import missing_required
from hardwood.operators.quality import CORRUPT, require_columns
from hardwood.tables import SHOT_SCHEMA

# Rows without these are not loaded.
LOAD_REQUIRES = ("player_id", "game_id", "event_type")


def read_shots(spark: SparkSession, path: str) -> DataFrame:
    """One season's file with lower-case names and declared types.

    Columns are matched by header name. A line whose numbers do not parse keeps
    its other fields and carries the raw line in ``_corrupt_record``. Spark marks a
    line for faults in the columns a query reads, so a check has to read all the
    typed ones together, as the quality report does.
    """
    header = spark.read.option("header", True).csv(path)
    names = [name.strip().lower() for name in header.columns]
    header = header.toDF(*names)
    require_columns(header, ["season_1"])
    declared = {f.name: f.dataType for f in SHOT_SCHEMA.fields}
    schema = T.StructType([T.StructField(name, declared.get(name, T.StringType())) for name in names])
    return (
        spark.read.schema(schema.add(CORRUPT, T.StringType()))
        .option("header", True)
        .option("mode", "PERMISSIVE")
        # A file of the folder whose header differs raises, instead of being read by position.
        .option("enforceSchema", False)
        .option("columnNameOfCorruptRecord", CORRUPT)
        .csv(path)
    )


def one_season(shots: DataFrame, year: int) -> DataFrame:
    """Rows of one season, whichever file they came in."""
    return shots.where(F.col("season_1") == str(year))


def clean_shots(shots: DataFrame) -> DataFrame:
    """Stage form of raw shots, plus ``reason`` where a row cannot be loaded."""
    cleaned = {
        "game_date": F.date_format(us_date(F.col("game_date")), "yyyy-MM-dd"),
        "shot_made": truth(F.col("shot_made")),
        "loc_x": finite(F.col("loc_x")).cast("double"),
        "loc_y": finite(F.col("loc_y")).cast("double"),
    }
    return shots.select(
        *(cleaned.get(name, F.col(name)).alias(name) for name in SHOT_SCHEMA.names),
        missing_required(LOAD_REQUIRES).alias("reason"),
    )


def valid_rows(cleaned: DataFrame) -> DataFrame:
    return cleaned.where(F.col("reason").isNull()).drop("reason")


def rejected_rows(cleaned: DataFrame) -> DataFrame:
    return cleaned.where(F.col("reason").isNotNull())
