"""Fact candidates from stage and dimension frames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hardwood.functions.cleaning import numeric_id, season_year, start_year, whole_number, without_sentinel
from hardwood.operators.constraints import missing_required
from hardwood.operators.latest import STAMP, latest
from hardwood.plans.dimensions import first_reason
from hardwood.tables import FACT_GAMES, FACT_SHOTS

LOADED = "loaded"

ZONE_KEY = ["basic_zone", "zone_name", "zone_range"]

# Box-score columns a fact row takes from its side of the game.
SIDE_METRICS = ("pts", "fgm", "fga", "fg3m", "fg3a")


def classify_shots(shots: DataFrame, zones: DataFrame, times: DataFrame) -> DataFrame:
    """Shots with parsed ids and looked-up surrogates, and ``reason`` where a row cannot become a fact.

    Both lookups are outer joins, so a shot without a zone or season is still
    there to be counted. The dimensions are read from files, whose sizes decide
    whether they are broadcast.
    """
    parsed = shots.withColumns({
        "season_year": start_year(F.col("season_1")),
        "raw_team": F.col("team_id").cast("string"),
        "game_id": numeric_id(F.col("game_id").cast("string")),
        "player_id": numeric_id(F.col("player_id").cast("string")),
    })
    found = (
        parsed.join(zones.select(*ZONE_KEY, "zone_id"), ZONE_KEY, "left")
        .join(times.select("season_year", "time_id"), "season_year", "left")
    )
    typed = found.select(
        "game_id", "player_id", "quarter", "mins_left", "secs_left",
        numeric_id(without_sentinel(F.col("raw_team"))).alias("team_id"),
        "zone_id", "time_id", "shot_made", "shot_type",
        F.col("loc_x").cast("double").alias("loc_x"), F.col("loc_y").cast("double").alias("loc_y"),
        "shot_distance", "season_year", STAMP,
        (F.col("raw_team") == "0").alias("_no_team"),
    )
    reason = F.coalesce(
        first_reason(
            (F.col("game_id").isNull(), "bad_game_id"),
            (F.col("player_id").isNull(), "bad_player_id"),
            (F.col("_no_team"), "missing_team"),
            (F.col("team_id").isNull(), "bad_team_id"),
            (F.col("zone_id").isNull(), "no_zone"),
            (F.col("time_id").isNull(), "no_season"),
        ),
        missing_required(["shot_made", "shot_type", STAMP]),
    )
    return typed.withColumn("reason", reason).drop("_no_team")


def fact_shots(shots: DataFrame, zones: DataFrame, times: DataFrame) -> DataFrame:
    """Newest usable row per shot key."""
    return newest_shots(classify_shots(shots, zones, times))


def newest_shots(classified: DataFrame) -> DataFrame:
    """``fact_shots`` from shots already classified."""
    usable = classified.where(F.col("reason").isNull())
    return latest(usable.select(*FACT_SHOTS.key, *FACT_SHOTS.attributes, STAMP), FACT_SHOTS.key)


def reject_counts(classified: DataFrame) -> DataFrame:
    """Rows per outcome: ``loaded`` or the reason they were not."""
    return classified.groupBy(F.coalesce("reason", F.lit(LOADED)).alias("outcome")).agg(
        F.count(F.lit(1)).alias("n_rows")
    )


def game_sides(games: DataFrame) -> DataFrame:
    """Two rows per game, one for each team, from a single pass over the games.

    Raw text is unpivoted first and parsed after: half as many parsing
    expressions keep the generated code small enough to be compiled.
    """
    def side(name: str, is_home: bool) -> Column:
        return F.struct(
            F.col(f"team_id_{name}").cast("string").alias("team_id"),
            F.lit(is_home).alias("is_home"),
            *(F.col(f"{metric}_{name}").cast("string").alias(metric) for metric in SIDE_METRICS),
        )

    unpivoted = games.select(
        numeric_id(F.col("game_id").cast("string")).alias("game_id"),
        season_year(F.col("season_id")).alias("season_year"),
        STAMP,
        F.inline(F.array(side("home", True), side("away", False))),
    )
    return unpivoted.withColumns({
        "team_id": numeric_id(F.col("team_id")), **{metric: whole_number(F.col(metric)) for metric in SIDE_METRICS}
    })


def classify_game_sides(games: DataFrame, times: DataFrame) -> DataFrame:
    """Game sides with their season looked up, and ``reason`` where a row cannot become a fact."""
    joined = game_sides(games).join(times.select("season_year", "time_id"), "season_year", "left")
    return joined.withColumn("reason", F.coalesce(
        first_reason(
            (F.col("game_id").isNull(), "bad_game_id"),
            (F.col("team_id").isNull(), "bad_team_id"),
            (F.col("time_id").isNull(), "no_season"),
        ),
        missing_required([STAMP]),
    ))


def fact_games(games: DataFrame, other_stats: DataFrame, times: DataFrame) -> DataFrame:
    """Newest row per game and team, with points in the paint where known."""
    return newest_sides(classify_game_sides(games, times), other_stats)


def newest_sides(classified: DataFrame, other_stats: DataFrame) -> DataFrame:
    """``fact_games`` from sides already classified.

    Both join sides are down to one row per key first, so a game with several
    stored versions on either side does not fan out.
    """
    sides = latest(classified.where(F.col("reason").isNull()).drop("reason"), ["game_id", "team_id"])
    paint = latest(
        other_stats.select(
            numeric_id(F.col("game_id").cast("string")).alias("game_id"),
            whole_number(F.col("pts_paint_home")).alias("_paint_home"),
            whole_number(F.col("pts_paint_away")).alias("_paint_away"),
            STAMP,
        ).where(F.col("game_id").isNotNull()),
        ["game_id"],
    ).drop(STAMP)
    return sides.join(paint, "game_id", "left").withColumn(
        "pts_paint", F.when(F.col("is_home"), F.col("_paint_home")).otherwise(F.col("_paint_away"))
    ).select(*FACT_GAMES.key, *FACT_GAMES.attributes, STAMP)
