"""Dimension candidates from stage frames: one newest row per key, not yet compared with the target."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hardwood.functions.cleaning import numeric_id, season_label, season_year, start_year, without_sentinel
from hardwood.operators.constraints import missing_required
from hardwood.operators.latest import STAMP, latest, latest_of_few


def first_reason(*reasons: tuple[Column, str]) -> Column:
    """Text of the first condition that holds, else NULL."""
    return F.coalesce(*(F.when(condition, text) for condition, text in reasons))


def dim_time(shots: DataFrame, games: DataFrame) -> DataFrame:
    """Seasons seen in shots or games, with the newest stamp of either."""
    years = shots.select(start_year(F.col("season_1")).alias("season_year"), STAMP).unionByName(
        games.select(season_year(F.col("season_id")).alias("season_year"), STAMP)
    )
    newest = latest_of_few(years.where(F.col("season_year").isNotNull() & F.col(STAMP).isNotNull()), ["season_year"], [])
    return newest.select("season_year", season_label(F.col("season_year")).alias("season_name"), STAMP)


def dim_zone(shots: DataFrame) -> DataFrame:
    """Court zones with their newest abbreviation."""
    keys = ["basic_zone", "zone_name", "zone_range"]
    return latest_of_few(shots.where(F.col("basic_zone").isNotNull() & F.col(STAMP).isNotNull()), keys, ["zone_abb"]).select(
        *keys, "zone_abb", STAMP
    )


def dim_team(teams: DataFrame, details: DataFrame) -> DataFrame:
    """Teams with the arena from their newest detail row."""
    arenas = latest(details.select("team_id", "arena", STAMP).where(F.col("team_id").isNotNull()), ["team_id"])
    named = latest(
        teams.where(F.col("id").isNotNull() & F.col(STAMP).isNotNull()).select("id", "full_name", "abbreviation", "city", STAMP), ["id"]
    )
    return named.join(arenas.select(F.col("team_id").alias("id"), "arena"), "id", "left").select(
        F.col("id").cast("string").alias("business_key"), "full_name", "abbreviation", "city", "arena",
        F.lit("Unknown").alias("conference"), STAMP,
    )


def dim_player(players: DataFrame) -> DataFrame:
    """Players with full name; team ``0`` means none."""
    columns = ["person_id", "first_name", "last_name", "position", "team_id", STAMP]
    return latest(players.where(F.col("person_id").isNotNull() & F.col(STAMP).isNotNull()).select(*columns), ["person_id"]).select(
        F.col("person_id").cast("string").alias("business_key"),
        F.concat("first_name", F.lit(" "), "last_name").alias("full_name"),
        "first_name", "last_name", "position",
        numeric_id(without_sentinel(F.col("team_id").cast("string"))).alias("team_id"),
        STAMP,
    )


def classify_games(games: DataFrame) -> DataFrame:
    """Games with parsed ids and dates, and ``reason`` where a row cannot become a dimension row."""
    parsed = games.select(
        numeric_id(F.col("game_id")).alias("game_id"),
        F.col("game_date").try_cast("date").alias("game_date"),
        "season_id",
        season_year(F.col("season_id")).alias("season_year"),
        numeric_id(F.col("team_id_home")).alias("home_team_id"),
        numeric_id(F.col("team_id_away")).alias("away_team_id"),
        F.col("matchup_home").alias("matchup"),
        STAMP,
    )
    return parsed.withColumn("reason", F.coalesce(
        first_reason(
            (F.col("game_id").isNull(), "bad_game_id"),
            (F.col("home_team_id").isNull(), "bad_home_team_id"),
            (F.col("away_team_id").isNull(), "bad_away_team_id"),
        ),
        missing_required(["game_date", "season_id", "season_year", STAMP]),
    ))


def dim_game(games: DataFrame) -> DataFrame:
    """Newest usable row per game. Ids are parsed before rows are compared, so ``0021`` and ``21`` are one game."""
    return newest_games(classify_games(games))


def newest_games(classified: DataFrame) -> DataFrame:
    """``dim_game`` from games already classified."""
    return latest(classified.where(F.col("reason").isNull()).drop("reason"), ["game_id"])


def unusable(rows: DataFrame, key: str) -> DataFrame:
    """Rows a dimension cannot take for want of a key or stamp, with the reason."""
    reason = missing_required([key, STAMP])
    return rows.withColumn("reason", reason).where(F.col("reason").isNotNull())
