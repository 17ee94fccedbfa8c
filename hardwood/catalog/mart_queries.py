"""Registered queries on marts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hardwood import tables as t
from hardwood.catalog import standins as s
from hardwood.operators.constraints import align
from hardwood.operators.publish import refresh_unless_empty
from hardwood.plans import dimensions, facts, marts
from hardwood.plans.warehouse import Warehouse, load_history, load_upsert
from hardwood.session import scratch_path, together

RUN_AT = dt.datetime(2024, 6, 1)


def _shot_mart(spark: SparkSession, sf_dir: str, team_versions: str) -> DataFrame:
    return marts.player_shot_efficiency(
        s.warehouse_shots(spark, sf_dir), s.warehouse_zones(spark, sf_dir),
        s.warehouse_times(spark, sf_dir, "lineitem", "l_shipdate"),
        s.warehouse_teams(spark, sf_dir), s.warehouse_players(spark, sf_dir), team_versions,
    )


def player_zone_efficiency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shot_mart(spark, sf_dir, "active")


def player_zone_all_team_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shot_mart(spark, sf_dir, "all")


def _shot_mart_sql(team_filter: str) -> str:
    return f"""
    WITH teams AS ({s.WAREHOUSE_TEAMS}),
    grouped AS (
        SELECT l_partkey AS player_id, p_name AS full_name, year(l_shipdate) AS season_year, l_suppkey AS team_id,
               team_name, p_type AS position, l_returnflag AS basic_zone, l_linestatus AS zone_name,
               'all' AS zone_range,
               COUNT(DISTINCT l_orderkey) AS games_played, COUNT(*) AS shot_attempts,
               CAST(SUM(CASE WHEN l_discount > 0.05 THEN 1 ELSE 0 END) AS BIGINT) AS shots_made,
               CAST(SUM(CASE WHEN l_discount > 0.05 THEN CASE WHEN l_tax > 0.04 THEN 3 ELSE 2 END ELSE 0 END)
                    AS BIGINT) AS points
        FROM lineitem JOIN teams ON l_suppkey = team_id {team_filter} JOIN part ON l_partkey = p_partkey
        GROUP BY l_partkey, p_name, year(l_shipdate), l_suppkey, team_name, p_type, l_returnflag, l_linestatus
    ),
    ranked AS (
        SELECT *, row_number() OVER (
            PARTITION BY player_id, season_year, basic_zone, zone_name, zone_range
            ORDER BY full_name, team_id, team_name, position) AS rn
        FROM grouped
    )
    SELECT player_id, full_name, season_year, team_id, team_name, position, basic_zone, zone_name, zone_range,
           games_played, shot_attempts, shots_made,
           {s.sql_percentage("shots_made", "shot_attempts")} AS zone_fg_percentage,
           {s.sql_ratio("shot_attempts", "games_played")} AS shots_per_game,
           {s.sql_ratio("points", "games_played")} AS points_per_zone
    FROM ranked WHERE rn = 1
    """


def _totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.team_season_totals(
        s.warehouse_games(spark, sf_dir), s.warehouse_times(spark, sf_dir, "orders", "o_orderdate"),
        s.warehouse_game_teams(spark, sf_dir),
    )


def team_attack_efficiency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.team_attack_efficiency(_totals(spark, sf_dir))


TEAM_ATTACK_SQL = f"""
    SELECT team_id, season_year, team_name, games_played, pts AS total_points,
           {s.sql_ratio("pts", "games_played")} AS team_ppg, fgm, fga,
           {s.sql_percentage("fgm", "fga")} AS team_fg_percentage, fg3m, fg3a,
           {s.sql_percentage("fg3m", "fg3a")} AS team_3p_percentage, pts_paint AS paint_points,
           {s.sql_ratio("pts_paint", "games_played")} AS paint_points_per_game
    FROM ({s.TEAM_TOTALS})
"""


def share_trends(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.three_point_trends(_totals(spark, sf_dir))


SHARE_TRENDS_SQL = f"""
    SELECT team_id, season_year, team_name, games_played, fg3a,
           {s.sql_ratio("fg3a", "games_played")} AS team_3pa_per_game, fg3m,
           {s.sql_percentage("fg3m", "fg3a")} AS team_3p_percentage,
           CAST(fg3m * 3 AS BIGINT) AS three_point_points, pts AS total_points,
           {s.sql_percentage("fg3m * 3", "pts")} AS three_point_contribution
    FROM ({s.TEAM_TOTALS})
"""


def full_refresh_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A mart that is rebuilt once with rows and once without any keeps its rows."""
    path = scratch_path(spark, "mart")
    mart = share_trends(spark, sf_dir)
    key = ("team_id", "season_year")
    refresh_unless_empty(mart, path, key, "three_point_trends")
    refresh_unless_empty(mart.where(F.col("games_played") < 0), path, key, "three_point_trends")
    return spark.read.schema(mart.schema).parquet(path).select(mart.columns)


def season_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stage to mart through stored dimensions and facts."""
    wh = Warehouse(spark, scratch_path(spark, "warehouse"))
    shots, games = s.shots(spark, sf_dir), s.games(spark, sf_dir)
    together(
        lambda: load_upsert(wh, t.DIM_TIME, dimensions.dim_time(shots, games)),
        lambda: load_upsert(wh, t.DIM_ZONE, dimensions.dim_zone(shots)),
        lambda: load_history(wh, t.DIM_TEAM, dimensions.dim_team(s.teams(spark, sf_dir), s.team_details(spark, sf_dir)), RUN_AT),
        lambda: load_history(wh, t.DIM_PLAYER, dimensions.dim_player(s.players(spark, sf_dir)), RUN_AT),
    )
    zones, times = wh.table(t.DIM_ZONE), wh.table(t.DIM_TIME)
    load_upsert(wh, t.FACT_SHOTS, facts.fact_shots(shots, zones, times))
    mart = marts.player_shot_efficiency(
        wh.table(t.FACT_SHOTS), zones, times, wh.table(t.DIM_TEAM), wh.table(t.DIM_PLAYER)
    )
    decimals = ("zone_fg_percentage", "shots_per_game", "points_per_zone")
    stamped = mart.withColumn("load_timestamp", F.lit(RUN_AT.isoformat(sep=" ")))
    return align(stamped, t.PLAYER_SHOT_EFFICIENCY).withColumns({c: F.col(c).cast("double") for c in decimals})


SEASON_CHAIN_SQL = f"""
    WITH shots AS ({s.SHOTS}),
    usable AS (SELECT * FROM shots WHERE team_id <> '0'),
    facts AS (
        SELECT * FROM usable QUALIFY row_number() OVER (
            PARTITION BY game_id, player_id, quarter, mins_left, secs_left
            ORDER BY load_timestamp DESC NULLS FIRST, CAST(team_id AS BIGINT), basic_zone, zone_name, zone_range,
                     shot_made, shot_type, loc_x, loc_y) = 1
    ),
    team AS (
        SELECT s_nationkey AS team_id, s_name AS team_name FROM supplier
        QUALIFY row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey DESC) = 1
    ),
    grouped AS (
        SELECT CAST(f.player_id AS BIGINT) AS player_id,
               CASE WHEN c_acctbal >= 0 THEN concat(c_mktsegment, ' ', c_name) END AS full_name,
               CAST(season_1 AS INTEGER) AS season_year, t.team_id, t.team_name, c_mktsegment AS position,
               basic_zone, zone_name, zone_range,
               COUNT(DISTINCT game_id) AS games_played, COUNT(*) AS shot_attempts,
               CAST(SUM(CASE WHEN shot_made THEN 1 ELSE 0 END) AS BIGINT) AS shots_made,
               CAST(SUM(CASE WHEN shot_made THEN CASE WHEN shot_type = '3PT Field Goal' THEN 3 ELSE 2 END
                             ELSE 0 END) AS BIGINT) AS points
        FROM facts f JOIN team t ON CAST(f.team_id AS BIGINT) = t.team_id
             JOIN customer ON CAST(f.player_id AS BIGINT) = c_custkey
        GROUP BY ALL
    ),
    ranked AS (
        SELECT *, row_number() OVER (
            PARTITION BY player_id, season_year, basic_zone, zone_name, zone_range
            ORDER BY full_name NULLS LAST, team_id) AS rn
        FROM grouped
    )
    SELECT player_id, full_name, season_year, CAST(team_id AS BIGINT) AS team_id, team_name, position, basic_zone,
           zone_name, zone_range, CAST(games_played AS INTEGER) AS games_played,
           CAST(shot_attempts AS INTEGER) AS shot_attempts, CAST(shots_made AS INTEGER) AS shots_made,
           {s.sql_percentage("shots_made", "shot_attempts")} AS zone_fg_percentage,
           {s.sql_ratio("shot_attempts", "games_played")} AS shots_per_game,
           {s.sql_ratio("points", "games_played")} AS points_per_zone,
           TIMESTAMP '{RUN_AT.isoformat(sep=" ")}' AS load_timestamp
    FROM ranked WHERE rn = 1
"""

QUERIES = {
    "player_zone_efficiency": (player_zone_efficiency, _shot_mart_sql("AND is_active")),
    "player_zone_all_team_versions": (player_zone_all_team_versions, _shot_mart_sql("")),
    "team_attack_efficiency": (team_attack_efficiency, TEAM_ATTACK_SQL),
    "share_trends": (share_trends, SHARE_TRENDS_SQL),
    "full_refresh_guard": (full_refresh_guard, SHARE_TRENDS_SQL),
    "season_chain": (season_chain, SEASON_CHAIN_SQL),
}
