"""Driver tables in the roles of stage and warehouse tables.

Each role is given twice: as a Spark frame that the library's own builds take,
and as SQL text for the independent check.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hardwood.operators.latest import STAMP


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _text(name: str) -> Column:
    return F.col(name).cast("string")


def _seconds_after(start: str, seconds: str) -> Column:
    return F.expr(f"timestamp_ntz'{start}' + make_dt_interval(0, 0, 0, cast({seconds} as decimal(18,6)))")


def _range(quantity: Column) -> Column:
    return (
        F.when(quantity < 10, "Less Than 10 ft.").when(quantity < 30, "10-29 ft.").otherwise("30+ ft.")
    )


# Stage role of shots, of the team that is the supplier's nation. The last two key parts are constant or NULL, so that keys repeat.
def shots(spark: SparkSession, sf_dir: str) -> DataFrame:
    nations = read(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey")
    return read(spark, sf_dir, "lineitem").join(nations, "l_suppkey").select(
        F.year("l_shipdate").cast("string").alias("season_1"),
        _text("s_nationkey").alias("team_id"),
        _text("l_suppkey").alias("player_id"),
        _text("l_orderkey").alias("game_id"),
        (F.col("l_discount") > 0.05).alias("shot_made"),
        F.when(F.col("l_tax") > 0.04, "3PT Field Goal").otherwise("2PT Field Goal").alias("shot_type"),
        F.col("l_returnflag").alias("basic_zone"),
        F.col("l_linestatus").alias("zone_name"),
        _range(F.col("l_quantity")).alias("zone_range"),
        F.concat("l_returnflag", _text("l_linenumber")).alias("zone_abb"),
        F.col("l_quantity").alias("loc_x"),
        F.col("l_extendedprice").alias("loc_y"),
        F.col("l_quantity").cast("int").alias("shot_distance"),
        F.col("l_linenumber").alias("quarter"),
        F.when(F.col("l_linestatus") == "F", 5).alias("mins_left"),
        F.lit(0).alias("secs_left"),
        F.col("l_shipdate").alias(STAMP),
    )


SHOTS = """
    SELECT CAST(year(l_shipdate) AS VARCHAR) AS season_1, CAST(s_nationkey AS VARCHAR) AS team_id,
           CAST(l_suppkey AS VARCHAR) AS player_id, CAST(l_orderkey AS VARCHAR) AS game_id,
           l_discount > 0.05 AS shot_made,
           CASE WHEN l_tax > 0.04 THEN '3PT Field Goal' ELSE '2PT Field Goal' END AS shot_type,
           l_returnflag AS basic_zone, l_linestatus AS zone_name,
           CASE WHEN l_quantity < 10 THEN 'Less Than 10 ft.' WHEN l_quantity < 30 THEN '10-29 ft.'
                ELSE '30+ ft.' END AS zone_range,
           concat(l_returnflag, l_linenumber) AS zone_abb,
           l_quantity AS loc_x, l_extendedprice AS loc_y, CAST(l_quantity AS INTEGER) AS shot_distance,
           l_linenumber AS quarter, CASE WHEN l_linestatus = 'F' THEN 5 END AS mins_left, 0 AS secs_left,
           l_shipdate AS load_timestamp
    FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
"""


# Stage role of games between nations: several stored versions per game, some ids padded and some malformed.
def games(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = _text("l_orderkey")
    status_o = F.col("l_linestatus") == "O"
    whole = F.col("l_quantity").cast("int")
    hundredths = {name: F.round(F.col(name) * 100).cast("int").cast("string") for name in ("l_discount", "l_tax")}
    nations = read(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey")
    return read(spark, sf_dir, "lineitem").join(nations, "l_suppkey").select(
        F.concat(F.lit("2"), F.year("l_shipdate").cast("string")).alias("season_id"),
        F.when((F.col("l_returnflag") == "N") & status_o, F.lpad(key, 12, "0"))
        .when((F.col("l_returnflag") == "A") & status_o, F.concat(key, F.lit("x")))
        .otherwise(key).alias("game_id"),
        F.concat(F.date_format("l_shipdate", "yyyy-MM-dd"), F.lit(" 00:00:00")).alias("game_date"),
        _text("s_nationkey").alias("team_id_home"),
        (F.col("l_partkey") % 25).cast("string").alias("team_id_away"),
        F.concat(F.lit("S"), _text("l_suppkey"), F.lit(" vs. P"), _text("l_partkey")).alias("matchup_home"),
        _text("l_quantity").alias("pts_home"), (F.col("l_linenumber") * 10).cast("string").alias("pts_away"),
        _text("l_linenumber").alias("fgm_home"), hundredths["l_discount"].alias("fgm_away"),
        (whole + F.col("l_linenumber")).cast("string").alias("fga_home"), (whole + 10).cast("string").alias("fga_away"),
        hundredths["l_tax"].alias("fg3m_home"), _text("l_linenumber").alias("fg3m_away"),
        _text("l_quantity").alias("fg3a_home"), (whole + 7).cast("string").alias("fg3a_away"),
        F.col("l_shipdate").alias(STAMP),
    )


GAMES = """
    SELECT concat('2', year(l_shipdate)) AS season_id,
           CASE WHEN l_returnflag = 'N' AND l_linestatus = 'O' THEN lpad(CAST(l_orderkey AS VARCHAR), 12, '0')
                WHEN l_returnflag = 'A' AND l_linestatus = 'O' THEN concat(l_orderkey, 'x')
                ELSE CAST(l_orderkey AS VARCHAR) END AS game_id,
           CAST(l_shipdate AS DATE) AS game_date,
           CAST(s_nationkey AS VARCHAR) AS team_id_home, CAST(l_partkey % 25 AS VARCHAR) AS team_id_away,
           concat('S', l_suppkey, ' vs. P', l_partkey) AS matchup_home,
           CAST(l_quantity AS INTEGER) AS pts_home, l_linenumber * 10 AS pts_away,
           l_linenumber AS fgm_home, CAST(round(l_discount * 100) AS INTEGER) AS fgm_away,
           CAST(l_quantity AS INTEGER) + l_linenumber AS fga_home, CAST(l_quantity AS INTEGER) + 10 AS fga_away,
           CAST(round(l_tax * 100) AS INTEGER) AS fg3m_home, l_linenumber AS fg3m_away,
           CAST(l_quantity AS INTEGER) AS fg3a_home, CAST(l_quantity AS INTEGER) + 7 AS fg3a_away,
           l_shipdate AS load_timestamp
    FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
"""


# Stage role of other game statistics; games still open have none.
def other_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "orders").where(F.col("o_orderstatus") != "P").select(
        _text("o_orderkey").alias("game_id"),
        F.floor(F.col("o_totalprice") / 10000).cast("string").alias("pts_paint_home"),
        F.length("o_orderpriority").cast("string").alias("pts_paint_away"),
        F.col("o_orderdate").alias(STAMP),
    )


OTHER_STATS = """
    SELECT o_orderkey AS game_id, CAST(floor(o_totalprice / 10000) AS INTEGER) AS pts_paint_home,
           CAST(length(o_orderpriority) AS INTEGER) AS pts_paint_away
    FROM orders WHERE o_orderstatus <> 'P'
"""


# Stage role of teams: one per nation, with one stored version per supplier of it.
def teams(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "supplier").select(
        _text("s_nationkey").alias("id"),
        F.col("s_name").alias("full_name"),
        F.concat(F.lit("N"), _text("s_nationkey")).alias("abbreviation"),
        F.when(F.col("s_acctbal") >= 0, F.concat(F.lit("City "), _text("s_suppkey"))).alias("city"),
        _seconds_after("2024-01-01 00:00:00", "s_suppkey").alias(STAMP),
    )


def team_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "nation").where(F.col("n_regionkey") != 0).select(
        _text("n_nationkey").alias("team_id"), F.col("n_name").alias("arena"),
        _seconds_after("2024-01-01 00:00:00", "n_nationkey").alias(STAMP),
    )


# Stage role of players.
def players(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "customer").select(
        _text("c_custkey").alias("person_id"),
        F.col("c_mktsegment").alias("first_name"),
        F.when(F.col("c_acctbal") >= 0, F.col("c_name")).alias("last_name"),
        F.col("c_mktsegment").alias("position"),
        _text("c_nationkey").alias("team_id"),
        _seconds_after("2024-01-01 00:00:00", "c_custkey").alias(STAMP),
    )


# Warehouse role of shots and the four dimensions around it.
def warehouse_shots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("game_id"), F.col("l_partkey").alias("player_id"),
        F.col("l_suppkey").alias("team_id"),
        (F.ascii("l_returnflag") * 256 + F.ascii("l_linestatus")).cast("bigint").alias("zone_id"),
        F.year("l_shipdate").cast("bigint").alias("time_id"),
        (F.col("l_discount") > 0.05).alias("shot_made"),
        F.when(F.col("l_tax") > 0.04, "3PT Field Goal").otherwise("2PT Field Goal").alias("shot_type"),
    )


def warehouse_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(
        F.lit("all").alias("zone_range")
    ).select(
        (F.ascii("l_returnflag") * 256 + F.ascii("l_linestatus")).cast("bigint").alias("zone_id"),
        F.col("l_returnflag").alias("basic_zone"), F.col("l_linestatus").alias("zone_name"), "zone_range",
    )


def warehouse_times(spark: SparkSession, sf_dir: str, table: str, date: str) -> DataFrame:
    return read(spark, sf_dir, table).select(F.year(date).alias("season_year")).distinct().select(
        F.col("season_year").cast("bigint").alias("time_id"), "season_year"
    )


def warehouse_teams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers, those in debt with an earlier closed version of the same name, large ones with another name."""
    supplier = read(spark, sf_dir, "supplier")
    key = _text("s_suppkey").alias("business_key")
    return (
        supplier.select(key, F.col("s_name").alias("full_name"), F.lit(True).alias("is_active"))
        .unionByName(supplier.where("s_acctbal < 0").select(
            key, F.col("s_name").alias("full_name"), F.lit(False).alias("is_active")))
        .unionByName(supplier.where("s_acctbal > 9000").select(
            key, F.concat(F.lit("Old "), "s_name").alias("full_name"), F.lit(False).alias("is_active")))
    )


WAREHOUSE_TEAMS = """
    SELECT s_suppkey AS team_id, s_name AS team_name, TRUE AS is_active FROM supplier
    UNION ALL SELECT s_suppkey, s_name, FALSE FROM supplier WHERE s_acctbal < 0
    UNION ALL SELECT s_suppkey, concat('Old ', s_name), FALSE FROM supplier WHERE s_acctbal > 9000
"""


def warehouse_players(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts, the big ones with an earlier closed version."""
    part = read(spark, sf_dir, "part")
    columns = (_text("p_partkey").alias("business_key"), F.col("p_type").alias("position"))
    return part.select(*columns, F.col("p_name").alias("full_name"), F.lit(True).alias("is_active")).unionByName(
        part.where("p_size > 40").select(
            *columns, F.concat(F.lit("Old "), "p_name").alias("full_name"), F.lit(False).alias("is_active")
        )
    )


# Warehouse role of game results: unique on game and team.
def warehouse_games(spark: SparkSession, sf_dir: str) -> DataFrame:
    month = F.month("o_orderdate")
    return read(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("game_id"), F.col("o_custkey").alias("team_id"),
        F.year("o_orderdate").cast("bigint").alias("time_id"),
        F.floor(F.col("o_totalprice") / 1000).cast("int").alias("pts"),
        F.length("o_orderpriority").alias("fgm"), (F.dayofmonth("o_orderdate") + 15).alias("fga"),
        F.when(month <= 6, 0).otherwise(month - 6).alias("fg3m"),
        F.when(month <= 6, 0).otherwise(month).alias("fg3a"),
        F.when(F.col("o_orderstatus") != "P", F.floor(F.col("o_totalprice") / 10000).cast("int")).alias("pts_paint"),
    )


def warehouse_game_teams(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "customer").select(
        _text("c_custkey").alias("business_key"), F.col("c_name").alias("full_name"),
        (F.col("c_acctbal") > -900).alias("is_active"),
    )


TEAM_TOTALS = """
    SELECT o_custkey AS team_id, year(o_orderdate) AS season_year, c_name AS team_name,
           COUNT(DISTINCT o_orderkey) AS games_played,
           CAST(SUM(floor(o_totalprice / 1000)) AS BIGINT) AS pts,
           CAST(SUM(length(o_orderpriority)) AS BIGINT) AS fgm,
           CAST(SUM(day(o_orderdate) + 15) AS BIGINT) AS fga,
           CAST(SUM(CASE WHEN month(o_orderdate) <= 6 THEN 0 ELSE month(o_orderdate) - 6 END) AS BIGINT) AS fg3m,
           CAST(SUM(CASE WHEN month(o_orderdate) <= 6 THEN 0 ELSE month(o_orderdate) END) AS BIGINT) AS fg3a,
           CAST(SUM(CASE WHEN o_orderstatus <> 'P' THEN floor(o_totalprice / 10000) END) AS BIGINT) AS pts_paint
    FROM orders JOIN customer ON o_custkey = c_custkey AND c_acctbal > -900
    GROUP BY o_custkey, year(o_orderdate), c_name
"""


def sql_ratio(numerator: str, denominator: str) -> str:
    """Half-up ratio to two decimals in whole numbers."""
    return f"((200 * ({numerator}) + ({denominator})) // nullif(2 * ({denominator}), 0)) / CAST(100.0 AS DOUBLE)"


def sql_percentage(numerator: str, denominator: str) -> str:
    return f"((20000 * ({numerator}) + ({denominator})) // nullif(2 * ({denominator}), 0)) / CAST(100.0 AS DOUBLE)"
