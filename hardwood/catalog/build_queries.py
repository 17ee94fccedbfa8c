"""Registered queries on dimension and fact builds."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hardwood.catalog import standins as s
from hardwood.functions.cleaning import numeric_id, season_label, season_year, to_number, without_sentinel
from hardwood.operators.latest import STAMP
from hardwood.operators.surrogate import assign_ids
from hardwood.plans import dimensions, facts
from hardwood.session import materialize


def dim_season_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    games = s.read(spark, sf_dir, "orders").select(
        F.concat(F.lit("2"), F.year("o_orderdate").cast("string")).alias("season_id"), F.col("o_orderdate").alias(STAMP)
    )
    return dimensions.dim_time(s.shots(spark, sf_dir), games)


DIM_SEASON_UNION_SQL = """
    SELECT CAST(y AS INTEGER) AS season_year, concat(y, '-', y + 1) AS season_name, max(ts) AS load_timestamp
    FROM (SELECT year(l_shipdate) AS y, l_shipdate AS ts FROM lineitem
          UNION ALL SELECT year(o_orderdate), o_orderdate FROM orders)
    GROUP BY y
"""


def dim_zone_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dimensions.dim_zone(s.shots(spark, sf_dir))


_ZONES = f"""
    SELECT basic_zone, zone_name, zone_range, zone_abb, load_timestamp FROM ({s.SHOTS})
    QUALIFY row_number() OVER (PARTITION BY basic_zone, zone_name, zone_range
                               ORDER BY load_timestamp DESC, zone_abb) = 1
"""


def dim_left_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dimensions.dim_team(s.teams(spark, sf_dir), s.team_details(spark, sf_dir))


DIM_LEFT_DETAILS_SQL = """
    WITH newest AS (
        SELECT * FROM supplier QUALIFY row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey DESC) = 1
    )
    SELECT CAST(s_nationkey AS VARCHAR) AS business_key, s_name AS full_name, concat('N', s_nationkey) AS abbreviation,
           CASE WHEN s_acctbal >= 0 THEN concat('City ', s_suppkey) END AS city, n_name AS arena,
           'Unknown' AS conference, TIMESTAMP '2024-01-01 00:00:00' + to_seconds(s_suppkey) AS load_timestamp
    FROM newest LEFT JOIN nation ON s_nationkey = n_nationkey AND n_regionkey <> 0
"""


def dim_player_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dimensions.dim_player(s.players(spark, sf_dir))


DIM_PLAYER_NAMES_SQL = """
    SELECT CAST(c_custkey AS VARCHAR) AS business_key,
           c_mktsegment || ' ' || CASE WHEN c_acctbal >= 0 THEN c_name END AS full_name,
           c_mktsegment AS first_name, CASE WHEN c_acctbal >= 0 THEN c_name END AS last_name,
           c_mktsegment AS position, CAST(nullif(c_nationkey, 0) AS BIGINT) AS team_id,
           TIMESTAMP '2024-01-01 00:00:00' + to_seconds(c_custkey) AS load_timestamp
    FROM customer
"""


def clean_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of five spellings, one per market segment, parsed or refused."""
    key = F.col("c_custkey").cast("string")
    raw = (
        F.when(F.col("c_mktsegment") == "AUTOMOBILE", F.regexp_extract("c_name", r"#([0-9]+)", 1))
        .when(F.col("c_mktsegment") == "BUILDING", F.concat(F.lit(" "), key))
        .when(F.col("c_mktsegment") == "FURNITURE", F.concat(key, F.lit("\n")))
        .when(F.col("c_mktsegment") == "HOUSEHOLD", F.lpad(key, 25, "9"))
        .otherwise(key)
    )
    year = F.lpad(F.col("c_nationkey").cast("string"), 4, "20")
    padded = F.concat(F.repeat(F.lit("0"), F.lit(30)), year)
    season = F.concat(
        F.lit("2"),
        F.when(F.col("c_mktsegment") == "BUILDING", padded).when(F.col("c_mktsegment") == "FURNITURE", F.concat(padded, F.lit("x")))
        .otherwise(year),
    )
    return s.read(spark, sf_dir, "customer").withColumns({"raw": raw, "season": season}).select(
        "c_custkey", numeric_id(F.col("raw")).alias("id"), to_number(F.col("raw")).alias("number"),
        numeric_id(without_sentinel(F.col("c_nationkey").cast("string"))).alias("team_id"),
        season_year(F.col("season")).alias("season_year"), season_label(season_year(F.col("season"))).alias("label"),
    )


CLEAN_IDS_SQL = r"""
    WITH raws AS (
        SELECT c_custkey, c_nationkey, CASE c_mktsegment
            WHEN 'AUTOMOBILE' THEN regexp_extract(c_name, '#([0-9]+)', 1)
            WHEN 'BUILDING' THEN concat(' ', c_custkey)
            WHEN 'FURNITURE' THEN concat(c_custkey, chr(10))
            WHEN 'HOUSEHOLD' THEN lpad(CAST(c_custkey AS VARCHAR), 25, '9')
            ELSE CAST(c_custkey AS VARCHAR) END AS raw,
            CASE WHEN c_mktsegment <> 'FURNITURE' THEN CAST(lpad(CAST(c_nationkey AS VARCHAR), 4, '20') AS INTEGER) END AS season_year
        FROM customer
    )
    SELECT c_custkey, CASE WHEN regexp_full_match(raw, '[0-9]+') THEN TRY_CAST(raw AS BIGINT) END AS id,
           CASE WHEN regexp_full_match(trim(raw), '[0-9]+') THEN CAST(trim(raw) AS DOUBLE) END AS number, CAST(nullif(c_nationkey, 0) AS BIGINT) AS team_id,
           season_year, season_year || '-' || (season_year + 1) AS label
    FROM raws
"""


def dim_game_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dimensions.dim_game(s.games(spark, sf_dir))


DIM_GAME_BUILD_SQL = f"""
    SELECT CAST(game_id AS BIGINT) AS game_id, game_date, season_id,
           CAST(substr(season_id, 2) AS INTEGER) AS season_year, CAST(team_id_home AS BIGINT) AS home_team_id,
           CAST(team_id_away AS BIGINT) AS away_team_id, matchup_home AS matchup, load_timestamp
    FROM ({s.GAMES}) WHERE regexp_full_match(game_id, '[0-9]+')
    QUALIFY row_number() OVER (
        PARTITION BY CAST(game_id AS BIGINT)
        ORDER BY load_timestamp DESC, game_date, season_id, season_year, CAST(team_id_home AS BIGINT),
                 CAST(team_id_away AS BIGINT)) = 1
"""


def home_away_unpivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts.game_sides(s.games(spark, sf_dir))


_SIDES = f"""
    SELECT TRY_CAST(game_id AS BIGINT) AS game_id, CAST(substr(season_id, 2) AS INTEGER) AS season_year,
           load_timestamp, CAST(team_id_home AS BIGINT) AS team_id, TRUE AS is_home, pts_home AS pts,
           fgm_home AS fgm, fga_home AS fga, fg3m_home AS fg3m, fg3a_home AS fg3a
    FROM ({s.GAMES})
    UNION ALL
    SELECT TRY_CAST(game_id AS BIGINT), CAST(substr(season_id, 2) AS INTEGER), load_timestamp,
           CAST(team_id_away AS BIGINT), FALSE, pts_away, fgm_away, fga_away, fg3m_away, fg3a_away
    FROM ({s.GAMES})
"""


def _times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stored season dimension that lacks one season."""
    return materialize(s.warehouse_times(spark, sf_dir, "lineitem", "l_shipdate").where("season_year <> 1995"), "times")


def _dims(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Stored zone and season dimensions that lack one kind of zone and one season."""
    zones = dimensions.dim_zone(s.shots(spark, sf_dir)).where(
        ~((F.col("basic_zone") == "R") & (F.col("zone_range") == "30+ ft."))
    )
    return assign_ids(zones, facts.ZONE_KEY, "zone_id"), _times(spark, sf_dir)


_DIMS = f"""
    zones AS (
        SELECT *, row_number() OVER (ORDER BY basic_zone, zone_name, zone_range) AS zone_id FROM ({_ZONES})
        WHERE NOT (basic_zone = 'R' AND zone_range = '30+ ft.')
    ),
    times AS (
        SELECT DISTINCT year(l_shipdate) AS season_year, CAST(year(l_shipdate) AS BIGINT) AS time_id FROM lineitem
        WHERE year(l_shipdate) <> 1995
    )
"""

_CLASSIFIED = f"""
    shots AS ({s.SHOTS}),
    {_DIMS},
    classified AS (
        SELECT s.*, zone_id, time_id, CAST(season_1 AS INTEGER) AS season_year,
               CASE WHEN team_id = '0' THEN 'missing_team' WHEN zone_id IS NULL THEN 'no_zone'
                    WHEN time_id IS NULL THEN 'no_season' ELSE 'loaded' END AS outcome
        FROM shots s LEFT JOIN zones z USING (basic_zone, zone_name, zone_range)
             LEFT JOIN times t ON CAST(s.season_1 AS INTEGER) = t.season_year
    )
"""


def fact_lookup_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts.reject_counts(facts.classify_shots(s.shots(spark, sf_dir), *_dims(spark, sf_dir)))


def fact_shots_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts.fact_shots(s.shots(spark, sf_dir), *_dims(spark, sf_dir))


FACT_SHOTS_BUILD_SQL = f"""
    WITH {_CLASSIFIED}
    SELECT CAST(game_id AS BIGINT) AS game_id, CAST(player_id AS BIGINT) AS player_id, quarter, mins_left, secs_left,
           CAST(team_id AS BIGINT) AS team_id, zone_id, time_id, shot_made, shot_type, loc_x, loc_y, shot_distance,
           season_year, load_timestamp
    FROM classified WHERE outcome = 'loaded'
    QUALIFY row_number() OVER (
        PARTITION BY game_id, player_id, quarter, mins_left, secs_left
        ORDER BY load_timestamp DESC, CAST(team_id AS BIGINT), zone_id, time_id, shot_made, shot_type, loc_x, loc_y
    ) = 1
"""


def fact_games_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts.fact_games(s.games(spark, sf_dir), s.other_stats(spark, sf_dir), _times(spark, sf_dir))


FACT_GAMES_BUILD_SQL = f"""
    WITH {_DIMS},
    sides AS (
        SELECT sides.*, time_id FROM ({_SIDES}) sides JOIN times USING (season_year) WHERE game_id IS NOT NULL
        QUALIFY row_number() OVER (
            PARTITION BY game_id, team_id
            ORDER BY load_timestamp DESC, season_year, is_home, pts, fgm, fga, fg3m, fg3a) = 1
    ),
    paint AS ({s.OTHER_STATS})
    SELECT game_id, team_id, time_id, is_home, pts, fgm, fga, fg3m, fg3a,
           CASE WHEN is_home THEN pts_paint_home ELSE pts_paint_away END AS pts_paint, season_year, load_timestamp
    FROM sides LEFT JOIN paint USING (game_id)
"""

QUERIES = {
    "dim_season_union": (dim_season_union, DIM_SEASON_UNION_SQL),
    "dim_zone_distinct": (dim_zone_distinct, _ZONES),
    "dim_left_details": (dim_left_details, DIM_LEFT_DETAILS_SQL),
    "dim_player_names": (dim_player_names, DIM_PLAYER_NAMES_SQL),
    "clean_ids": (clean_ids, CLEAN_IDS_SQL),
    "dim_game_build": (dim_game_build, DIM_GAME_BUILD_SQL),
    "home_away_unpivot": (home_away_unpivot, _SIDES),
    "fact_lookup_rejects": (
        fact_lookup_rejects, f"WITH {_CLASSIFIED} SELECT outcome, COUNT(*) AS n_rows FROM classified GROUP BY outcome"
    ),
    "fact_shots_build": (fact_shots_build, FACT_SHOTS_BUILD_SQL),
    "fact_games_build": (fact_games_build, FACT_GAMES_BUILD_SQL),
}
