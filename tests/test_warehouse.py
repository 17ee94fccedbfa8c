"""Whole rounds over small hand-made extracts."""

import datetime as dt
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from hardwood import tables as t
from hardwood.operators.constraints import repeated_keys
from hardwood.plans import warehouse as w

RUN_1 = dt.datetime(2024, 1, 1, 6)
RUN_2 = dt.datetime(2024, 1, 2, 6)
RUN_3 = dt.datetime(2024, 1, 3, 6)

SHOT_COLUMNS = [name.upper() for name in t.SHOT_SCHEMA.names]


def extract(spark, table, rows):
    """Rows given as dicts; absent columns are NULL."""
    return spark.createDataFrame([tuple(row.get(c) for c in table.columns) for row in rows], table.schema).coalesce(1)


def game(game_id, home="10", away="20", season="22010", **more):
    return {
        "season_id": season, "game_id": game_id, "game_date": "2010-10-26 00:00:00", "matchup_home": "AAA vs. BBB",
        "team_id_home": home, "team_id_away": away, "pts_home": "100.0", "pts_away": "90.0", "fgm_home": "40",
        "fgm_away": "35", "fga_home": "80", "fga_away": "85", "fg3m_home": "10", "fg3m_away": "5", "fg3a_home": "25",
        "fg3a_away": "20", **more,
    }


def shot(**more):
    row = {
        "season_1": "2010", "season_2": "2010-11", "team_id": "10", "team_name": "Alphas", "player_id": "7",
        "player_name": "Al One", "position_group": "G", "position": "PG", "game_date": "10-26-2010", "game_id": "21",
        "home_team": "AAA", "away_team": "BBB", "event_type": "Made Shot", "shot_made": "TRUE",
        "action_type": "Jump Shot", "shot_type": "2PT Field Goal", "basic_zone": "Mid-Range", "zone_name": "Center",
        "zone_abb": "C", "zone_range": "8-16 ft.", "loc_x": "1.5", "loc_y": "10.25", "shot_distance": "9",
        "quarter": "1", "mins_left": "5", "secs_left": "30",
    }
    return {**row, **more}


def write_csv(path, shots):
    lines = [",".join(SHOT_COLUMNS)]
    lines += [",".join(row[name.lower()] for name in SHOT_COLUMNS) for row in shots]
    path.write_text("\n".join(lines) + "\n")
    return str(path)


@pytest.fixture
def sources(spark, tmp_path):
    def build(teams=None, games=None, shots=None, name="shots.csv"):
        static = {
            "team": extract(spark, t.TEAM, teams or [
                {"id": "10", "full_name": "Alphas", "abbreviation": "AAA", "city": "A"},
                {"id": "20", "full_name": "Betas", "abbreviation": "BBB", "city": "B"},
            ]),
            "team_details": extract(spark, t.TEAM_DETAILS, [
                {"team_id": "10", "arena": "Hall A", "arenacapacity": "1000.0"}]),
            "common_player_info": extract(spark, t.COMMON_PLAYER_INFO, [
                {"person_id": "7", "first_name": "Al", "last_name": "One", "position": "Guard", "team_id": "10"},
                {"person_id": "8", "first_name": "Bo", "last_name": None, "position": "Center", "team_id": "0"},
            ]),
            "other_stats": extract(spark, t.OTHER_STATS, [
                {"game_id": "0021", "team_id_home": "10", "team_id_away": "20", "pts_paint_home": "44",
                 "pts_paint_away": "30"}]),
        }
        return {
            "static": static,
            "games": extract(spark, t.GAME, games or [game("0021"), game("0022"), game("12a"), game("23", home=None)]),
            "line_scores": extract(spark, t.LINE_SCORE_GAME, [
                {"game_id": "21", "game_date_est": "2010-10-26", "team_id_home": "10", "team_id_away": "20"},
                {"game_id": "22", "game_date_est": "2011-01-02", "team_id_home": "10", "team_id_away": "20"}]),
            "shots_csv": write_csv(tmp_path / name, shots or [
                shot(), shot(secs_left="29", shot_made="False"), shot(secs_left="20", shot_type="3PT Field Goal"),
                shot(game_id="22", team_id="0"), shot(game_id="22", zone_name=""), shot(player_id=""),
                shot(season_1="2011"),
            ]),
        }

    return build


def counts(results):
    return {r.table: dict(r.counts) for r in results}


def snapshot(wh):
    """Contents of every warehouse table, for comparison across runs."""
    tables = (t.DIM_TIME, t.DIM_ZONE, t.DIM_TEAM, t.DIM_PLAYER, t.DIM_GAME, t.FACT_SHOTS, t.FACT_GAMES)
    return {table.name: sorted(map(str, wh.table(table).collect())) for table in tables}


def test_a_season_its_rerun_and_a_reload_with_changes(spark, tmp_path, sources):
    root = str(tmp_path / "wh")
    wh = w.Warehouse(spark, root)
    done = counts(w.run_season(spark, root, 2010, RUN_1, **sources()))
    assert done["team"] == {"new": 2}
    assert done["line_score_game"] == {"new": 1}
    assert done["shot_data"] == {"new": 5, "skipped": 1}
    assert done["dim_zone"]["inserted"] == 2  # one of them has no zone name
    assert done["dim_game"]["inserted"] == 2 and done["dim_game"]["rejected"] == 2
    assert done["fact_shots"]["inserted"] == 3 and done["fact_shots"]["rejected"] == 2
    assert done["fact_games"]["inserted"] == 5 and done["fact_games"]["rejected"] == 3
    reasons = spark.read.parquet(wh.path("rejects", "fact_shots")).groupBy("reason").count().collect()
    assert {r.reason: r["count"] for r in reasons} == {"missing_team": 1, "no_zone": 1}
    remarks = {r.object_name: r.remarks for r in spark.read.parquet(wh.path("tech", "load_audit")).collect()}
    assert remarks["fact_shots"] == "null_ids: 1, zero_ids: 1" and remarks["dim_game"].startswith("null_ids: 1")
    if spark.sparkContext.getCheckpointDir():
        left = [p for p in Path(spark.sparkContext.getCheckpointDir().removeprefix("file:")).iterdir() if p.name.startswith("source-")]
        assert not left  # what a run staged is gone when it ends

    player = wh.table(t.DIM_PLAYER).orderBy("business_key").collect()
    assert [(p.business_key, p.full_name, p.team_id) for p in player] == [("7", "Al One", 10), ("8", None, None)]
    paint = {(r.game_id, r.team_id): r.pts_paint for r in wh.table(t.FACT_GAMES).collect()}
    assert paint == {(21, 10): 44, (21, 20): 30, (22, 10): None, (22, 20): None, (23, 20): None}
    mart = spark.read.parquet(wh.path("dm", "player_shot_efficiency")).collect()
    assert len(mart) == 1
    assert (mart[0].shot_attempts, mart[0].shots_made, float(mart[0].zone_fg_percentage)) == (3, 2, 66.67)
    assert (float(mart[0].shots_per_game), float(mart[0].points_per_zone)) == (3.0, 5.0)
    attack = {r.team_id: r for r in spark.read.parquet(wh.path("dm", "team_attack_efficiency")).collect()}
    assert (attack[10].games_played, attack[10].total_points, float(attack[10].team_ppg)) == (2, 200, 100.0)
    assert (float(attack[20].team_fg_percentage), attack[20].paint_points) == (41.18, 30)
    trends = {r.team_id: r for r in spark.read.parquet(wh.path("dm", "three_point_trends")).collect()}
    assert (trends[10].three_point_points, float(trends[10].three_point_contribution)) == (60, 30.0)

    before = snapshot(wh)
    again = counts(w.load_dds(wh, RUN_2, 2010))
    assert all(not set(c) & {"inserted", "updated"} for c in again.values())
    assert snapshot(wh) == before

    # A reload of the season with changes keeps ids and adds history.
    ids = {(r.game_id, r.secs_left): r.shot_id for r in wh.table(t.FACT_SHOTS).collect()}
    changed = sources(
        teams=[{"id": "10", "full_name": "Alphas", "abbreviation": "AAA", "city": "Moved"},
               {"id": "30", "full_name": "Gammas", "abbreviation": "CCC", "city": "C"}],
        shots=[shot(shot_made="FALSE"), shot(secs_left="11")], name="again.csv",
    )
    done = counts(w.run_season(spark, root, 2010, RUN_2, **changed))
    assert done["team"] == {"changed": 1, "new": 1, "deleted": 1}
    assert done["common_player_info"] == {}
    assert done["dim_team"] == {"updated": 1, "inserted": 1, "rejected": 0}
    assert done["fact_shots"] == {"updated": 1, "inserted": 1, "unchanged": 0, "rejected": 0}
    shots = {(r.game_id, r.secs_left): r for r in wh.table(t.FACT_SHOTS).collect()}
    assert len(shots) == 4  # keys the reload no longer has stay in the warehouse
    assert shots[(21, 30)].shot_id == ids[(21, 30)] and shots[(21, 30)].shot_made is False
    assert shots[(21, 11)].shot_id == max(ids.values()) + 1
    versions = wh.table(t.DIM_TEAM).where("business_key = '10'").orderBy("valid_from").collect()
    assert [(v.city, v.valid_from, v.valid_to, v.is_active) for v in versions] == [
        ("A", RUN_1, RUN_2, False), ("Moved", RUN_2, None, True)]
    assert repeated_keys(wh.table(t.DIM_TEAM), ["team_sk"]).isEmpty()
    assert wh.stage_shots().count() == 2  # the season partition was replaced
    audit = spark.read.parquet(wh.path("tech", "load_audit"))
    assert audit.select("run_at").distinct().count() == 2


def test_a_correction_moves_a_game_to_another_season(spark, tmp_path):
    wh = w.Warehouse(spark, str(tmp_path / "wh"))
    schema = t.DIM_GAME.schema

    def row(game_id, season, stamp):
        return (game_id, dt.date(2010, 10, 26), f"2{season}", season, 10, 20, "m", stamp)

    first = [row(1, 2010, RUN_1), row(2, 2011, RUN_1), row(3, 2012, RUN_1)]
    w.load_upsert(wh, t.DIM_GAME, spark.createDataFrame(first, schema))
    moved = [row(1, 2011, RUN_2), row(3, 2012, RUN_1)]
    result = w.load_upsert(wh, t.DIM_GAME, spark.createDataFrame(moved, schema))
    assert result.counts == {"updated": 1, "unchanged": 1}
    stored = {r.game_id: r.season_year for r in wh.table(t.DIM_GAME).collect()}
    assert stored == {1: 2011, 2: 2011, 3: 2012} and wh.table(t.DIM_GAME).count() == 3
    # Two games leave one partition while a third stays in it.
    w.load_upsert(wh, t.DIM_GAME, spark.createDataFrame([row(2, 2012, RUN_3)], schema))
    stored = {r.game_id: r.season_year for r in wh.table(t.DIM_GAME).collect()}
    assert stored == {1: 2011, 2: 2012, 3: 2012}


def test_shot_with_null_quarter_is_stored_once(spark, tmp_path):
    wh = w.Warehouse(spark, str(tmp_path / "wh"))
    names = [*t.FACT_SHOTS.key, *t.FACT_SHOTS.attributes, "load_timestamp"]
    fields = [t.FACT_SHOTS.schema[name] for name in names]

    def load(stamp):
        row = (1, 7, None, 5, 30, 10, 1, 1, True, "2PT Field Goal", 1.0, 2.0, 9, 2010, stamp)
        return w.load_upsert(wh, t.FACT_SHOTS, spark.createDataFrame([row], fields and type(t.SHOT_SCHEMA)(fields)))

    assert load(RUN_1).counts == {"inserted": 1, "unchanged": 0}
    assert load(RUN_1).counts == {"unchanged": 1}
    assert load(RUN_2).counts == {"updated": 1, "unchanged": 0}
    assert [(r.shot_id, r.load_timestamp) for r in wh.table(t.FACT_SHOTS).collect()] == [(1, RUN_2)]


def test_sync_modes_and_repeat(spark, tmp_path):
    wh = w.Warehouse(spark, str(tmp_path / "wh"))

    def teams(*rows):
        return extract(spark, t.TEAM, [{"id": i, "full_name": n, "year_founded": y} for i, n, y in rows])

    assert w.sync_static(wh, t.TEAM, teams(), RUN_1).counts == {}
    assert w.sync_static(wh, t.TEAM, teams(("1", "a", "1949.0"), ("2", "b", "1950")), RUN_1).mode == "FULL_LOAD"
    second = teams(("1", "a", "1949"), ("2", "B", "1950"))
    assert w.sync_static(wh, t.TEAM, second, RUN_2).counts == {"unchanged": 1, "changed": 1}
    assert w.sync_static(wh, t.TEAM, second, RUN_3).counts == {"unchanged": 2}
    gone = w.sync_static(wh, t.TEAM, teams(("1", "a", "1949")), RUN_3)
    assert gone.counts == {"unchanged": 1, "deleted": 1} and "1 deleted keys" in gone.remarks
    listed = spark.read.parquet(wh.path("tech", "deleted_keys") + "/team").collect()
    assert [(row.id, row.description) for row in listed] == [("2", "id:2")]
    assert wh.stage_table(t.TEAM).count() == 3
    once = extract(spark, t.DRAFT_COMBINE_STATS, [{"season": "2010", "player_id": "1", "weight": "-1"}])
    assert w.sync_static(wh, t.DRAFT_COMBINE_STATS, once, RUN_1).mode == "FULL_LOAD"
    skipped = w.sync_static(wh, t.DRAFT_COMBINE_STATS, once, RUN_2)
    assert skipped.mode == "SKIPPED" and "business_rule weight=1" in skipped.remarks


def test_backlog(spark, tmp_path):
    wh = w.Warehouse(spark, str(tmp_path / "wh"))
    games = extract(spark, t.GAME, [game("1"), game("2", season="22011"), game("3", season="22011"),
                                    game("4", season="42012")])

    def waiting():
        return {r.season: r.n_rows for r in w.waiting_seasons(wh, t.GAME, games).collect()}

    assert waiting() == {2010: 1, 2011: 2}
    w.load_games(wh, games, w.next_season(wh, games), RUN_1)
    assert waiting() == {2011: 2}
    w.load_games(wh, games, w.next_season(wh, games), RUN_1)
    assert waiting() == {} and w.next_season(wh, games) is None
    w.load_games(wh, games, 2011, RUN_2)
    assert wh.stage_table(t.GAME).count() == 3
    assert wh.stage_table(t.GAME, 2011).select(F.max("load_timestamp")).first()[0] == RUN_2
