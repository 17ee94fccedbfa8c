"""Builds and marts on hand-made rows, and the shape of their physical plans."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from hardwood.operators.latest import latest
from hardwood.plans import dimensions, facts, marts
from hardwood.sources import extracts

DAY = [dt.datetime(2024, 1, d) for d in range(1, 10)]


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


@pytest.fixture
def star(frame):
    def build(shots, teams=None, players=None):
        return (
            frame(shots, "game_id bigint, player_id bigint, team_id bigint, zone_id bigint, time_id bigint, "
                         "shot_made boolean, shot_type string"),
            frame([(1, "Paint", None, "near")], "zone_id bigint, basic_zone string, zone_name string, zone_range string"),
            frame([(1, 2010)], "time_id bigint, season_year int"),
            frame(teams or [("10", "Alphas", True), ("20", "Betas", True)],
                  "business_key string, full_name string, is_active boolean"),
            frame(players or [("7", "Al One", "G", True)],
                  "business_key string, full_name string, position string, is_active boolean"),
        )

    return build


def shot(game, team=10, made=True, kind="2PT Field Goal"):
    return (game, 7, team, 1, 1, made, kind)


def test_traded_player_keeps_one_row_per_zone(star):
    mart = marts.player_shot_efficiency(*star([shot(g, team) for g in range(5) for team in (20, 10)]))
    assert rows(mart, "team_id", "shot_attempts", "games_played") == [(10, 5, 5)]


def test_team_versions_count_again_only_on_request(star):
    teams = [("10", "Alphas", True), ("10", "Alphas", False)]
    shots = [shot(1), shot(1, made=False), shot(2, kind="3PT Field Goal")]
    measures = ("games_played", "shot_attempts", "shots_made", "zone_fg_percentage", "shots_per_game", "points_per_zone")
    one = marts.player_shot_efficiency(*star(shots, teams))
    assert rows(one, *measures) == [(2, 3, 2, 66.67, 1.5, 2.5)]
    both = marts.player_shot_efficiency(*star(shots, teams), team_versions="all")
    assert rows(both, *measures) == [(2, 6, 4, 66.67, 3.0, 5.0)]


def test_inactive_players_and_unknown_teams_drop_out(star):
    players = [("7", "Al One", "G", False), ("x", "Bad Key", "G", True)]
    assert marts.player_shot_efficiency(*star([shot(1)], players=players)).isEmpty()
    assert marts.player_shot_efficiency(*star([shot(1, team=99)])).isEmpty()


def test_team_marts_share_one_base(frame, star):
    _, _, times, teams, _ = star([])
    games = frame([(1, 10, 1, 100, 40, 80, 10, 30, 44), (2, 10, 1, 91, 30, 80, 0, 0, None), (1, 99, 1, 1, 1, 1, 1, 1, 1)],
                  "game_id bigint, team_id bigint, time_id bigint, pts int, fgm int, fga int, fg3m int, fg3a int, "
                  "pts_paint int")
    totals = marts.team_season_totals(games, times, teams)
    assert rows(marts.team_attack_efficiency(totals), "*") == [
        (10, 2010, "Alphas", 2, 191, 95.5, 70, 160, 43.75, 10, 30, 33.33, 44, 22.0)]
    assert rows(marts.three_point_trends(totals), "*") == [
        (10, 2010, "Alphas", 2, 30, 15.0, 10, 33.33, 30, 191, 15.71)]
    no_threes = marts.three_point_trends(marts.team_season_totals(games.where("game_id = 2"), times, teams))
    assert rows(no_threes, "team_3p_percentage", "three_point_contribution") == [(None, 0.0)]


GAME = "season_id string, game_id string, game_date string, team_id_home string, team_id_away string, " \
       "matchup_home string, load_timestamp timestamp_ntz"


def test_games_are_keyed_by_number_and_bad_ids_have_a_reason(frame):
    games = frame([
        ("22010", "0021", "2010-10-26", "1", "2", "old", DAY[0]), ("22010", "21", "2010-10-26", "1", "2", "new", DAY[1]),
        ("22010", "12a", "2010-10-26", "1", "2", "m", DAY[0]), ("22010", "1", "2010-10-26", None, "2", "m", DAY[0]),
        ("22010", "1", "2010-10-26", "1", "2\n", "m", DAY[0]), ("2201x", "1", "2010-10-26", "1", "2", "m", DAY[0]),
        ("22010", "1", "26.10.2010", "1", "2", "m", DAY[0]), ("22010", "1" * 20, "2010-10-26", "1", "2", "m", DAY[0]),
    ], GAME)
    assert rows(dimensions.dim_game(games), "game_id", "matchup") == [(21, "new")]
    reasons = dimensions.classify_games(games).where("reason is not null").groupBy("reason").count()
    assert rows(reasons, "*") == [
        ("bad_away_team_id", 1), ("bad_game_id", 2), ("bad_home_team_id", 1), ("null_game_date", 1),
        ("null_season_year", 1)]


def test_latest_arena_without_fan_out(frame):
    teams = frame([("1", "A", "a", "x", DAY[0]), ("1", "B", "b", "x", DAY[1]), ("2", "C", "c", "y", DAY[0])],
                  "id string, full_name string, abbreviation string, city string, load_timestamp timestamp_ntz")
    details = frame([("1", "old", DAY[0]), ("1", "new", DAY[2])], "team_id string, arena string, load_timestamp timestamp_ntz")
    assert rows(dimensions.dim_team(teams, details), "business_key", "full_name", "arena", "conference") == [
        ("1", "B", "new", "Unknown"), ("2", "C", None, "Unknown")]


SHOT = "season_1 string, team_id string, player_id string, game_id string, shot_made boolean, shot_type string, " \
       "basic_zone string, zone_name string, zone_range string, loc_x double, loc_y double, shot_distance int, " \
       "quarter int, mins_left int, secs_left int, load_timestamp timestamp_ntz"


def raw_shot(**more):
    row = dict(season_1="2010", team_id="10", player_id="7", game_id="21", shot_made=True, shot_type="2PT Field Goal",
               basic_zone="Paint", zone_name="Center", zone_range="near", loc_x=1.0, loc_y=2.0, shot_distance=3,
               quarter=1, mins_left=5, secs_left=30, load_timestamp=DAY[0])
    return tuple({**row, **more}.values())


def test_shots_reach_the_fact_once_or_a_reason(frame):
    shots = frame([
        raw_shot(), raw_shot(game_id="0021", load_timestamp=DAY[1], shot_made=False), raw_shot(team_id="0"),
        raw_shot(team_id=None), raw_shot(player_id="x"), raw_shot(game_id=""), raw_shot(zone_name=None),
        raw_shot(season_1="1999"), raw_shot(shot_type=None), raw_shot(quarter=None), raw_shot(quarter=None),
    ], SHOT)
    zones = frame([(5, "Paint", "Center", "near"), (6, "Paint", None, "near")],
                  "zone_id bigint, basic_zone string, zone_name string, zone_range string")
    times = frame([(3, 2010)], "time_id bigint, season_year int")
    assert rows(facts.fact_shots(shots, zones, times), "game_id", "quarter", "shot_made", "zone_id", "time_id") == [
        (21, 1, False, 5, 3), (21, None, True, 5, 3)]
    outcome = dict(rows(facts.reject_counts(facts.classify_shots(shots, zones, times)), "*"))
    assert outcome == {"loaded": 4, "missing_team": 1, "bad_team_id": 1, "bad_player_id": 1, "bad_game_id": 1,
                       "no_zone": 1, "no_season": 1, "null_shot_type": 1}


def test_season_and_calendar_scans(frame):
    games = frame([("22010",), ("42010",), ("22011",), (None,)], "season_id string")
    assert rows(extracts.season_games(games, 2010), "*") == [("22010",)]
    text = frame([("2010-12-31 20:00:00",), ("2011-01-01",), ("2011-12-31",), ("2012-01-01",)], "d string")
    assert rows(extracts.calendar_year(text, "d", 2011), "*") == [("2011-01-01",), ("2011-12-31",)]


# ------------------------------------------------------------------- plans


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def lineitem(spark):
    return spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")


def test_latest_limits_groups_before_the_shuffle(lineitem):
    text = plan(latest(lineitem, ["l_orderkey"], "l_shipdate"))
    assert text.count("WindowGroupLimit") == 2 and text.count("Exchange") == 1


def test_filters_and_columns_reach_the_scan(lineitem):
    text = plan(extracts.calendar_year(lineitem, "l_shipdate", 1997).select("l_orderkey"))
    assert "GreaterThanOrEqual(l_shipdate" in text and "ReadSchema: struct<l_orderkey:bigint,l_shipdate" in text
    assert "l_extendedprice" not in text


def test_marts_fold_before_they_join(spark, lineitem, star):
    _, zones, times, teams, players = star([])
    shots = lineitem.select(
        F.col("l_orderkey").alias("game_id"), F.col("l_partkey").alias("player_id"), F.col("l_suppkey").alias("team_id"),
        F.col("l_orderkey").alias("zone_id"), F.col("l_orderkey").alias("time_id"),
        (F.col("l_tax") > 0).alias("shot_made"), F.col("l_returnflag").alias("shot_type"),
    )
    text = plan(marts.player_shot_efficiency(shots, zones, times, teams, players))
    assert "Expand" not in text and "Cartesian" not in text and "NestedLoop" not in text
    # In the printed tree, what runs first is printed last.
    assert text.rindex("HashAggregate") > text.rindex("Join") and "ReadSchema: struct<l_orderkey:bigint,l_partkey" in text


@pytest.mark.parametrize("versions", ["active", "all"])
def test_shots_are_dealt_out_before_they_fill_a_task(spark, lineitem, star, versions):
    """No task folds its share of the files, both deals keep their number of tasks, and no name is sorted with the ids."""
    _, zones, times, teams, players = star([])
    shots = lineitem.select(
        F.col("l_orderkey").alias("game_id"), F.col("l_partkey").alias("player_id"), F.col("l_suppkey").alias("team_id"),
        F.col("l_linenumber").cast("bigint").alias("zone_id"), F.col("l_linenumber").cast("bigint").alias("time_id"),
        (F.col("l_tax") > 0).alias("shot_made"), F.col("l_returnflag").alias("shot_type"),
    )
    lines = plan(marts.player_shot_efficiency(shots, zones, times, teams, players, versions)).split("\n")
    deals = [i for i, line in enumerate(lines) if "REPARTITION_BY_NUM" in line]
    assert len(deals) == 2
    assert "slice#" in lines[deals[1]] and not [line for line in lines[deals[1]:] if "Aggregate" in line and "game_id#" in line]
    ranked = next(line for line in lines if "WindowGroupLimit" in line and "zone_key#" in line)
    assert "team_id#" in ranked and "full_name#" not in ranked and "position#" not in ranked


def test_repeated_dimension_rows_give_the_first_by_name(frame, star):
    """Names are looked up after the row is picked, and still the first by full_name, team_id, team_name and position."""
    shots, _, _, teams, players = star(
        [shot(1, 20), shot(2, 20), (3, 7, 20, 2, 1, True, "2PT Field Goal")],
        [("20", "Gammas", True), ("20", "Betas", True), ("20", None, True)],
        [("7", None, "A", True), ("7", "Al One", "G", True), ("7", "Al One", "C", True)],
    )
    zones = frame([(1, "Paint", None, "near"), (1, "Paint", None, "near"), (2, "Arc", "x", "far")],
                  "zone_id bigint, basic_zone string, zone_name string, zone_range string")
    times = frame([(1, 2010), (1, 2010)], "time_id bigint, season_year int")
    for versions in ("active", "all"):
        mart = marts.player_shot_efficiency(shots, zones, times, teams, players, versions)
        assert rows(mart, "full_name", "team_name", "position", "basic_zone", "games_played", "shot_attempts") == [
            ("Al One", "Betas", "C", "Arc", 1, 1), ("Al One", "Betas", "C", "Paint", 2, 2)]


def test_team_totals_shuffle_only_folded_rows(spark, star):
    _, _, times, teams, _ = star([])
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    games = orders.select(
        F.col("o_orderkey").alias("game_id"), F.col("o_custkey").alias("team_id"), F.col("o_custkey").alias("time_id"),
        *(F.col("o_totalprice").cast("int").alias(c) for c in ("pts", "fgm", "fga", "fg3m", "fg3a", "pts_paint")),
    )
    totals = marts.team_season_totals(games, times, teams)
    text = plan(totals)
    assert "partial_sum" in text and "hashpartitioning(team_id" in text and "game_id#" not in text.split("Exchange")[1].split("\n")[0]
