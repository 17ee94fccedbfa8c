"""Registered queries on scans and stage writes."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hardwood.catalog import standins as s
from hardwood.operators.latest import STAMP
from hardwood.session import scratch_path
from hardwood.sources import extracts, shot_csv, stage
from hardwood.tables import SHOT_SCHEMA

# Any one season will do; the scans are by season.
SEASON = 1997


def season_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    games = s.read(spark, sf_dir, "orders").withColumn(
        "season_id", F.concat(F.when(F.col("o_orderstatus") == "P", "4").otherwise("2"),
                              F.year("o_orderdate").cast("string"))
    )
    return extracts.season_games(games, SEASON).select("season_id", "o_orderkey", "o_totalprice")


SEASON_SCAN_SQL = f"""
    SELECT '2{SEASON}' AS season_id, o_orderkey, o_totalprice FROM orders
    WHERE o_orderstatus <> 'P' AND year(o_orderdate) = {SEASON}
"""


def calendar_year_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extracts.calendar_year(s.read(spark, sf_dir, "lineitem"), "l_shipdate", SEASON).select(
        "l_orderkey", "l_linenumber", "l_extendedprice", "l_shipdate"
    )


CALENDAR_YEAR_SCAN_SQL = f"""
    SELECT l_orderkey, l_linenumber, l_extendedprice, l_shipdate FROM lineitem WHERE year(l_shipdate) = {SEASON}
"""


def season_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return s.shots(spark, sf_dir).select("season_1").distinct()


def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shots written as a yearly file would be, faults included, and read back."""
    bad_date = (F.col("l_returnflag") == "A") & (F.col("l_linestatus") == "O")
    values = {
        "season_1": F.year("l_shipdate").cast("string"),
        "player_id": F.when(F.col("l_quantity") > 1, F.col("l_partkey").cast("string")),
        "game_id": F.col("l_orderkey").cast("string"),
        "team_id": F.col("l_suppkey").cast("string"),
        "game_date": F.when(bad_date, "99-99-2010").otherwise(F.date_format("l_shipdate", "MM-dd-yyyy")),
        "event_type": F.when(F.col("l_tax") > 0, "Shot, any"),
        "shot_made": F.when(F.col("l_discount") > 0.05, "TRUE").when(F.col("l_discount") > 0.02, "False")
        .otherwise("maybe"),
        "loc_x": F.col("l_extendedprice").cast("string"),
        "shot_distance": F.when(F.col("l_linenumber") == 7, "x12").otherwise(
            F.col("l_quantity").cast("int").cast("string")),
        "quarter": F.col("l_linenumber").cast("string"),
    }
    path = scratch_path(spark, "shots-csv")
    s.read(spark, sf_dir, "lineitem").select(
        *(values.get(name, F.lit(None).cast("string")).alias(name.upper()) for name in SHOT_SCHEMA.names)
    ).write.option("header", True).csv(path)
    return shot_csv.clean_shots(shot_csv.read_shots(spark, path)).select(
        "season_1", "player_id", "game_id", "team_id", "game_date", "event_type", "shot_made", "loc_x",
        "shot_distance", "quarter", "reason",
    )


CSV_ROUNDTRIP_SQL = """
    SELECT CAST(year(l_shipdate) AS VARCHAR) AS season_1,
           CASE WHEN l_quantity > 1 THEN CAST(l_partkey AS VARCHAR) END AS player_id,
           CAST(l_orderkey AS VARCHAR) AS game_id, CAST(l_suppkey AS VARCHAR) AS team_id,
           CASE WHEN NOT (l_returnflag = 'A' AND l_linestatus = 'O') THEN strftime(l_shipdate, '%Y-%m-%d')
                END AS game_date,
           CASE WHEN l_tax > 0 THEN 'Shot, any' END AS event_type, l_discount > 0.05 AS shot_made,
           CAST(CAST(l_extendedprice AS FLOAT) AS DOUBLE) AS loc_x,
           CASE WHEN l_linenumber <> 7 THEN CAST(l_quantity AS INTEGER) END AS shot_distance,
           l_linenumber AS quarter,
           CASE WHEN l_quantity <= 1 THEN 'null_player_id' WHEN l_tax <= 0 THEN 'null_event_type' END AS reason
    FROM lineitem
"""


def stage_append_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two appended batches: all customers, then the debtors again."""
    path = scratch_path(spark, "stage")
    customer = s.read(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    stage.append(customer, path, dt.datetime(2024, 1, 1))
    stage.append(customer.where("c_acctbal < 0"), path, dt.datetime(2024, 2, 1))
    return spark.read.parquet(path).select("c_custkey", "c_acctbal", STAMP)


STAGE_APPEND_VERSIONS_SQL = """
    SELECT c_custkey, c_acctbal, TIMESTAMP '2024-01-01 00:00:00' AS load_timestamp FROM customer
    UNION ALL SELECT c_custkey, c_acctbal, TIMESTAMP '2024-02-01 00:00:00' FROM customer WHERE c_acctbal < 0
"""

QUERIES = {
    "season_scan": (season_scan, SEASON_SCAN_SQL),
    "calendar_year_scan": (calendar_year_scan, CALENDAR_YEAR_SCAN_SQL),
    "season_values": (season_values, "SELECT DISTINCT CAST(year(l_shipdate) AS VARCHAR) AS season_1 FROM lineitem"),
    "csv_roundtrip": (csv_roundtrip, CSV_ROUNDTRIP_SQL),
    "stage_append_versions": (stage_append_versions, STAGE_APPEND_VERSIONS_SQL),
}
