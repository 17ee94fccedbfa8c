"""Relational extracts: full tables, one season, one calendar year."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hardwood.tables import StageTable


def read_extract(spark: SparkSession, table: StageTable, path: str, fmt: str = "parquet", **options: str) -> DataFrame:
    """All rows of a file extract, with exactly the declared columns as text. Columns are found by name."""
    reader = spark.read.format(fmt)
    if fmt == "csv":
        reader = reader.option("header", True)
    if fmt == "json":
        reader = reader.schema(table.schema)
    return as_declared(reader.options(**options).load(path), table)


def read_database(
    spark: SparkSession, table: StageTable, url: str, dbtable: str, split_column: str, bounds: tuple[int, int],
    partitions: int, **options: str,
) -> DataFrame:
    """All rows of a live database table, read by ``partitions`` tasks over ranges of a numeric column."""
    frame = (
        spark.read.format("jdbc")
        .options(url=url, dbtable=dbtable, partitionColumn=split_column, lowerBound=str(bounds[0]),
                 upperBound=str(bounds[1]), numPartitions=str(partitions), **options)
        .load()
    )
    return as_declared(frame, table)


def as_declared(df: DataFrame, table: StageTable) -> DataFrame:
    """Declared columns in declared order, as text."""
    return df.select(*(F.col(name).cast("string") for name in table.columns))


def season_games(games: DataFrame, year: int) -> DataFrame:
    """Games of the regular season that starts in ``year``: ids open with kind ``2`` and the year."""
    return games.where(F.col("season_id").startswith(f"2{year}"))


def calendar_year(df: DataFrame, date_column: str, year: int) -> DataFrame:
    """Rows dated in ``year``. A half-open range, so that file and row-group statistics prune; works on dates,
    timestamps and ISO text alike."""
    column = F.col(date_column)
    if df.schema[date_column].dataType.simpleString() == "string":
        low, high = F.lit(f"{year:04d}-01-01"), F.lit(f"{year + 1:04d}-01-01")
    else:
        kind = df.schema[date_column].dataType
        low, high = (F.lit(dt.date(y, 1, 1)).cast(kind) for y in (year, year + 1))
    return df.where((column >= low) & (column < high))
