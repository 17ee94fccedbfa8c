"""Extract scans, the yearly shot file and stage writes."""

import datetime as dt

import pytest
from pyspark.errors import AnalysisException

from hardwood.operators.quality import MissingColumnsError, quality
from hardwood.sources import extracts, shot_csv, stage
from hardwood.tables import PLAYER, SHOT_DATA, SHOT_SCHEMA

NOW = dt.datetime(2024, 1, 1)
LATER = dt.datetime(2024, 1, 2)


def test_extracts_are_read_by_column_name(spark, frame, tmp_path):
    df = frame([("x", "1", "Al One", "Al", "One")], "extra string, id string, full_name string, first_name string, "
                                                     "last_name string")
    df.select("last_name", "extra", "id", "full_name", "first_name").write.option("header", True).csv(str(tmp_path / "c"))
    df.withColumn("id", df.id.cast("bigint")).write.parquet(str(tmp_path / "p"))
    df.write.json(str(tmp_path / "j"))
    for fmt, name in (("csv", "c"), ("parquet", "p"), ("json", "j")):
        got = extracts.read_extract(spark, PLAYER, str(tmp_path / name), fmt)
        assert got.columns == list(PLAYER.columns)
        assert [tuple(r) for r in got.collect()] == [("1", "Al One", "Al", "One")]


def shots_file(path, *rows):
    names = [name.upper() for name in SHOT_SCHEMA.names]
    base = dict.fromkeys(names, "") | {
        "SEASON_1": "2010", "PLAYER_ID": "7", "GAME_ID": "0021", "TEAM_ID": "10", "EVENT_TYPE": "Made Shot",
        "GAME_DATE": "10-26-2010", "SHOT_MADE": "TRUE", "LOC_X": "1.5", "SHOT_DISTANCE": "9", "QUARTER": "1",
    }
    lines = [",".join(names)] + [",".join((base | row)[name] for name in names) for row in rows]
    path.write_text("\n".join(lines) + "\n")
    return str(path)


def test_shot_file_with_faults(spark, tmp_path):
    path = shots_file(
        tmp_path / "s.csv", {}, {"GAME_DATE": "99-99-2010", "SHOT_MADE": "False"}, {"SHOT_DISTANCE": "x12"},
        {"PLAYER_ID": ""}, {"SEASON_1": "2011"}, {"SHOT_MADE": "maybe", "QUARTER": "-1"}, {"LOC_X": "NaN"},
    )
    raw = shot_csv.one_season(shot_csv.read_shots(spark, path), 2010)
    bad = {(r.check, r.column): r.n_bad for r in quality(raw, SHOT_DATA.quality, "shot_data").collect() if r.n_bad}
    # Equal on player, game, place and quarter: the first three lines.
    assert bad == {("missing", "player_id"): 1, ("format", "shot_made"): 1, ("format", "_corrupt_record"): 1,
                   ("business_rule", "quarter"): 1, ("duplicate", "player_id, game_id, loc_x, loc_y, quarter"): 2}
    cleaned = shot_csv.clean_shots(raw)
    assert [r.reason for r in shot_csv.rejected_rows(cleaned).collect()] == ["null_player_id"]
    got = shot_csv.valid_rows(cleaned).select("game_date", "shot_made", "loc_x", "shot_distance", "game_id").collect()
    assert sorted(map(tuple, got), key=str) == sorted([
        ("2010-10-26", True, 1.5, 9, "0021"), (None, False, 1.5, 9, "0021"), ("2010-10-26", True, 1.5, None, "0021"),
        ("2010-10-26", False, 1.5, 9, "0021"), ("2010-10-26", True, None, 9, "0021"),
    ], key=str)


def test_missing_file_and_missing_season_column_raise(spark, tmp_path):
    with pytest.raises(AnalysisException):
        shot_csv.read_shots(spark, str(tmp_path / "none.csv"))
    (tmp_path / "bad.csv").write_text("PLAYER_ID,GAME_ID\n1,2\n")
    with pytest.raises(MissingColumnsError):
        shot_csv.read_shots(spark, str(tmp_path / "bad.csv"))


def test_stage_appends_versions_and_replaces_seasons(spark, frame, tmp_path):
    static, season = str(tmp_path / "static"), str(tmp_path / "season")
    df = frame([("a",), ("b",)], "k string")
    stage.append(df, static, NOW)
    stage.append(df.where("k = 'a'"), static, LATER)
    got = spark.read.parquet(static).drop("run").orderBy("k", "load_timestamp").collect()
    assert [tuple(r) for r in got] == [("a", NOW), ("a", LATER), ("b", NOW)]
    stage.replace_season(df, season, 2010, NOW)
    stage.replace_season(df, season, 2011, NOW)
    stage.replace_season(df.where("k = 'b'"), season, 2010, LATER)
    got = spark.read.parquet(season).orderBy("season", "k").collect()
    assert [tuple(r) for r in got] == [("b", LATER, 2010), ("a", NOW, 2011), ("b", NOW, 2011)]
    assert stage.path_exists(spark, season) and not stage.path_exists(spark, str(tmp_path / "nothing"))
