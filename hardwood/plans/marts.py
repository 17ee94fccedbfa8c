"""Marts: facts are folded to their ids first, then the few remaining rows meet the dimensions.

The dimension keys are unique, so folding before the joins changes no result
and leaves nothing large, and no hot key, for the joins to move.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hardwood.functions.cleaning import numeric_id
from hardwood.functions.ratios import percentage, ratio
from hardwood.operators.latest import first_per_key

# Fixed value: shot type that scores three.
THREE_POINTER = "3PT Field Goal"

# Tasks over which the games of one player, team, zone and season are spread.
GAME_SLICES = 4


def _active(dimension: DataFrame) -> DataFrame:
    return dimension.where(F.col("is_active"))


def player_shot_efficiency(
    shots: DataFrame, zones: DataFrame, times: DataFrame, teams: DataFrame, players: DataFrame,
    team_versions: str = "active",
) -> DataFrame:
    """Shooting per player, season and zone.

    A player who changed teams within a season keeps one row per zone, the first
    by name and team id. With ``team_versions="all"`` every stored version of a
    team counts its shots again.

    Rows are dealt out twice, per slice of games and then per place, each time over
    as many tasks as the session names and by keys with few rows each. What a task holds
    is its share of the ids, not of the names.
    """
    points = F.when(
        F.col("shot_made"), F.when(F.col("shot_type") == THREE_POINTER, 3).otherwise(2)
    ).otherwise(0)
    tasks = int(shots.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ids = ["player_id", "team_id", "zone_id", "time_id"]
    measures = ("shot_attempts", "shots_made", "points")
    # A game adds few shots to one player's zone, so folding them before the shuffle would fill a task with groups for nothing.
    # The number of tasks is named, so that small compressed partitions are not gathered into a few whose rows fill one task.
    # Of a player's games one slice lies in one task, which folds it to a row: few rows are left for the second deal.
    per_slice = (
        shots.select(*ids, "game_id", F.when(F.col("shot_made"), 1).otherwise(0).alias("shots_made"), points.alias("points"))
        .withColumn("slice", F.pmod(F.hash("game_id"), F.lit(GAME_SLICES)))
        .repartition(tasks, *ids, "slice")
        .groupBy(*ids, "slice", "game_id")
        .agg(F.count(F.lit(1)).alias("shot_attempts"), *(F.sum(name).alias(name) for name in measures[1:]))
        .groupBy(*ids, "slice")
        .agg(F.count("game_id").alias("games_played"), *(F.sum(name).alias(name) for name in measures))
    )
    # Zones of the same name compete for one row: they share a number. The dimension has a few dozen rows.
    names = ("basic_zone", "zone_name", "zone_range")
    named = zones.select("zone_id", *names).distinct().withColumn("zone_key", F.dense_rank().over(Window.orderBy(*names)))
    place = ["player_id", "season_year", "zone_key"]
    folded = (
        per_slice.join(named.select("zone_id", "zone_key"), "zone_id")
        .join(times.select("time_id", "season_year").distinct(), "time_id")
        .repartition(tasks, *place)
        .groupBy(*ids, *place[1:])
        .agg(*(F.sum(name).alias(name) for name in ("games_played", *measures)))
    )
    team_names = (_active(teams) if team_versions == "active" else teams).select(
        numeric_id(F.col("business_key")).alias("team_id"), F.col("full_name").alias("team_name")
    )
    versions = first_per_key(
        team_names.groupBy("team_id", "team_name").agg(F.count(F.lit(1)).alias("_versions")),
        ["team_id"], [F.col("team_name").asc_nulls_last()],
    )
    player_names = first_per_key(
        _active(players).select(numeric_id(F.col("business_key")).alias("player_id"), "full_name", "position"),
        ["player_id"], [F.col(name).asc_nulls_last() for name in ("full_name", "position")],
    )
    # The first row by full_name, team_id, team_name and position: a player's names are the same in all rows of a place, and a
    # team's in all rows of the team, so the team id alone decides, and names are looked up for the rows that stay.
    of_teams = folded.join(versions, "team_id")
    if team_versions == "all":
        of_teams = of_teams.withColumns({name: F.col(name) * F.col("_versions") for name in measures})
    one_team = (
        first_per_key(of_teams, place, [F.col("team_id").asc_nulls_last()])
        .join(player_names, "player_id")
        .join(named.drop("zone_id").distinct(), "zone_key")
    )
    games = F.col("games_played")
    return one_team.select(
        "player_id", "full_name", "season_year", "team_id", "team_name", "position",
        "basic_zone", "zone_name", "zone_range", "games_played", "shot_attempts", "shots_made",
        percentage(F.col("shots_made"), F.col("shot_attempts")).alias("zone_fg_percentage"),
        ratio(F.col("shot_attempts"), games).alias("shots_per_game"),
        ratio(F.col("points"), games).alias("points_per_zone"),
    )


def team_season_totals(games: DataFrame, times: DataFrame, teams: DataFrame) -> DataFrame:
    """Base of both team marts: sums per team and season.

    ``games`` is unique on game and team, so within one team and season counting
    rows counts distinct games, and no row is shuffled for it.
    """
    metrics = ("pts", "fgm", "fga", "fg3m", "fg3a", "pts_paint")
    folded = games.groupBy("team_id", "time_id").agg(
        F.count("game_id").alias("games_played"), *(F.sum(name).alias(name) for name in metrics)
    )
    names = _active(teams).select(
        numeric_id(F.col("business_key")).alias("team_id"), F.col("full_name").alias("team_name")
    )
    return folded.join(times.select("time_id", "season_year"), "time_id").join(names, "team_id")


def team_attack_efficiency(totals: DataFrame) -> DataFrame:
    """Scoring per team and season."""
    games = F.col("games_played")
    return totals.select(
        "team_id", "season_year", "team_name", "games_played",
        F.col("pts").alias("total_points"),
        ratio(F.col("pts"), games).alias("team_ppg"),
        "fgm", "fga",
        percentage(F.col("fgm"), F.col("fga")).alias("team_fg_percentage"),
        "fg3m", "fg3a",
        percentage(F.col("fg3m"), F.col("fg3a")).alias("team_3p_percentage"),
        F.col("pts_paint").alias("paint_points"),
        ratio(F.col("pts_paint"), games).alias("paint_points_per_game"),
    )


def three_point_trends(totals: DataFrame) -> DataFrame:
    """Three-point volume, accuracy and share of scoring per team and season."""
    from_three = F.col("fg3m") * 3
    return totals.select(
        "team_id", "season_year", "team_name", "games_played", "fg3a",
        ratio(F.col("fg3a"), F.col("games_played")).alias("team_3pa_per_game"),
        "fg3m",
        percentage(F.col("fg3m"), F.col("fg3a")).alias("team_3p_percentage"),
        from_three.alias("three_point_points"),
        F.col("pts").alias("total_points"),
        percentage(from_three, F.col("pts")).alias("three_point_contribution"),
    )
