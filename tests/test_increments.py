"""Loads and refreshes that rewrite only what changed."""

import datetime as dt
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from hardwood import tables as t
from hardwood.functions.hashing import row_hash
from hardwood.operators import changes, newest, publish
from hardwood.operators.buckets import bucket_of, folder, in_partitions
from hardwood.operators.constraints import DuplicateKeyError
from hardwood.operators.latest import latest
from hardwood.operators.snapshot import stored_hashes
from hardwood.plans import warehouse as w
from hardwood.sources import stage

RUNS = [dt.datetime(2024, 1, day, 6) for day in range(1, 8)]


class Stopped(Exception):
    pass


def stopped(*args, **more):
    raise Stopped


def files(path):
    return {str(p.relative_to(path)) for p in Path(path).rglob("part-*.parquet")}


def games(spark, rows):
    """(game_id, season, stamp) as rows of the game dimension."""
    made = [(g, dt.date(2010, 10, 26), f"2{season}", season, 10, 20, "m", stamp) for g, season, stamp in rows]
    return spark.createDataFrame(made, t.DIM_GAME.schema)


def stored(wh):
    return {r.game_id: (r.season_year, r.load_timestamp) for r in wh.table(t.DIM_GAME).collect()}


def test_a_correction_rewrites_its_bucket_alone(spark, tmp_path):
    wh = w.Warehouse(spark, str(tmp_path / "wh"))
    path = wh.path("dds", "dim_game")
    first = [(g, 2010 + g % 2, RUNS[0]) for g in range(80)]
    w.load_upsert(wh, t.DIM_GAME, games(spark, first))
    before = files(path)
    assert {f.split("/")[0] for f in before} == {"season_year=2010", "season_year=2011"}
    assert {f.split("/")[1] for f in before} == {f"bucket={b}" for b in range(t.DIM_GAME.buckets)}
    place = spark.range(1).select(F.lit(7).cast("long").alias("game_id")).select(bucket_of(t.DIM_GAME.schema, t.DIM_GAME.key, t.DIM_GAME.buckets)).first()[0]

    assert w.load_upsert(wh, t.DIM_GAME, games(spark, [(7, 2011, RUNS[1])])).counts == {"updated": 1, "unchanged": 0}
    after = files(path)
    assert {str(Path(f).parent) for f in before - after} == {f"season_year=2011/bucket={place}"} == {str(Path(f).parent) for f in after - before}

    # A move exchanges one bucket of the old and one of the new season; new keys are added and rewrite nothing.
    moved = w.load_upsert(wh, t.DIM_GAME, games(spark, [(7, 2010, RUNS[2]), (900, 2010, RUNS[2]), (901, 2011, RUNS[2])]))
    assert moved.counts == {"inserted": 2, "updated": 1, "unchanged": 0}
    assert {str(Path(f).parent) for f in after - files(path)} == {f"season_year=201{k}/bucket={place}" for k in (0, 1)}
    expected = {g: (season, stamp) for g, season, stamp in first} | {7: (2010, RUNS[2]), 900: (2010, RUNS[2]), 901: (2011, RUNS[2])}
    assert stored(wh) == expected and wh.table(t.DIM_GAME).count() == len(expected)


def test_a_bucket_that_loses_its_last_row_is_dropped(spark, tmp_path):
    wh = w.Warehouse(spark, str(tmp_path / "wh"))
    w.load_upsert(wh, t.DIM_GAME, games(spark, [(1, 2010, RUNS[0]), (2, 2011, RUNS[0])]))
    w.load_upsert(wh, t.DIM_GAME, games(spark, [(1, 2011, RUNS[1])]))
    assert stored(wh) == {1: (2011, RUNS[1]), 2: (2011, RUNS[0])}
    assert {f.split("/")[0] for f in files(wh.path("dds", "dim_game"))} == {"season_year=2011"}


def test_only_the_buckets_of_a_delta_are_read(spark, tmp_path, monkeypatch):
    wh = w.Warehouse(spark, str(tmp_path / "wh"))
    w.load_upsert(wh, t.DIM_GAME, games(spark, [(g, 2010, RUNS[0]) for g in range(40)]))
    seen, look_up = [], w.known_rows

    def watched(staged, target, *more):
        plan = target._jdf.queryExecution().executedPlan().toString()
        seen.append((next(line for line in plan.splitlines() if "PartitionFilters" in line), {r.bucket for r in target.select("bucket").distinct().collect()}))
        return look_up(staged, target, *more)

    monkeypatch.setattr(w, "known_rows", watched)
    w.load_upsert(wh, t.DIM_GAME, games(spark, [(7, 2010, RUNS[1])]))
    (scan, buckets), = seen
    assert "bucket" in scan.split("PartitionFilters")[1].split("PushedFilters")[0] and len(buckets) == 1


def test_a_table_keeps_its_number_of_buckets_and_an_older_one_has_none(spark, tmp_path):
    wh = w.Warehouse(spark, str(tmp_path / "wh"))
    assert wh.buckets(t.FACT_SHOTS) == t.FACT_SHOTS.buckets
    other = t.WarehouseTable(**{**vars(t.FACT_SHOTS), "buckets": 99})
    assert wh.buckets(other) == t.FACT_SHOTS.buckets
    old = games(spark, [(1, 2010, RUNS[0]), (2, 2011, RUNS[0])])
    old.write.partitionBy("season_year").parquet(wh.path("dds", "dim_game"))
    assert wh.buckets(t.DIM_GAME) is None
    w.load_upsert(wh, t.DIM_GAME, games(spark, [(1, 2011, RUNS[1]), (3, 2012, RUNS[1])]))
    assert stored(wh) == {1: (2011, RUNS[1]), 2: (2011, RUNS[0]), 3: (2012, RUNS[1])}


def test_repeated_keys_are_refused_when_they_are_only_added(spark, tmp_path):
    wh = w.Warehouse(spark, str(tmp_path / "wh"))
    with pytest.raises(DuplicateKeyError):
        w.load_upsert(wh, t.DIM_GAME, games(spark, [(1, 2010, RUNS[0]), (1, 2011, RUNS[0])]))
    assert stored(wh) == {}


def test_a_stop_between_corrections_and_new_keys_is_made_good(spark, tmp_path, monkeypatch):
    wh = w.Warehouse(spark, str(tmp_path / "wh"))
    w.load_upsert(wh, t.DIM_GAME, games(spark, [(1, 2010, RUNS[0])]))
    batch = games(spark, [(1, 2011, RUNS[1]), (2, 2010, RUNS[1])])
    whole = publish.commit
    monkeypatch.setattr(publish, "commit", lambda *a, **b: (whole(*a, **b), stopped()))
    with pytest.raises(Stopped):
        w.load_upsert(wh, t.DIM_GAME, batch)
    monkeypatch.undo()
    assert stored(wh) == {1: (2011, RUNS[1])}
    assert w.load_upsert(wh, t.DIM_GAME, batch).counts == {"inserted": 1, "unchanged": 1}
    assert stored(wh) == {1: (2011, RUNS[1]), 2: (2010, RUNS[1])}


def test_conditions_and_folders_of_places(frame):
    df = frame([(p, b) for p in range(3) for b in range(3)], "p int, b int")
    assert {tuple(r) for r in df.where(in_partitions(["p", "b"], {(0, 1), (0, 2), (2, 0)})).collect()} == {(0, 1), (0, 2), (2, 0)}
    assert df.where(in_partitions(["p"], {(1,)})).count() == 3 and folder(["p", "b"], (1, 2)) == "p=1/b=2"


# ------------------------------------------------------------------ stage


def test_a_repeated_append_stores_its_rows_once(spark, frame, tmp_path, monkeypatch):
    path = str(tmp_path / "s")
    df = frame([("a",), ("b",)], "k string")
    stage.append(df, path, RUNS[0])
    stage.append(df, path, RUNS[0])  # done twice
    assert spark.read.parquet(path).count() == 2
    for stop in ("finish_pending", "overwrite_partitions"):
        # Stopped before and after the rows are exchanged: once marked ready, the next load completes it.
        whole = getattr(publish, stop)
        monkeypatch.setattr(publish, stop, stopped if stop == "finish_pending" else lambda *a, whole=whole: (whole(*a), stopped()))
        with pytest.raises(Stopped):
            stage.append(df, path, RUNS[1])
        monkeypatch.undo()
        stage.append(df, path, RUNS[1])
        assert spark.read.parquet(path).groupBy("load_timestamp").count().count() == 2 and spark.read.parquet(path).count() == 4


def test_a_season_is_exchanged_whole(spark, frame, tmp_path, monkeypatch):
    path = str(tmp_path / "s")
    df = frame([("a",), ("b",)], "k string")
    stage.replace_season(df, path, 2010, RUNS[0])
    monkeypatch.setattr(publish, "finish_pending", stopped)
    with pytest.raises(Stopped):
        stage.replace_season(df.where("k = 'a'"), path, 2010, RUNS[1])
    monkeypatch.undo()
    assert publish.finish_pending(spark, path)
    assert [r.k for r in spark.read.parquet(path).collect()] == ["a"]


def test_the_mark_of_an_exchange_goes_first(spark, frame, tmp_path, monkeypatch):
    """A stop while the pending folder is deleted leaves no mark without rows, which would block every later load."""
    path = str(tmp_path / "t")
    delete = publish.delete_path
    done = []
    monkeypatch.setattr(publish, "delete_path", lambda s, p: stopped() if done else (delete(s, p), p.endswith("/ready") and done.append(p)))
    with pytest.raises(Stopped):
        publish.commit(frame([("a", 1)], "k string, p int"), path, ["p"])
    monkeypatch.undo()
    assert not publish.finish_pending(spark, path) and spark.read.parquet(path).count() == 1


def test_a_sync_reads_stored_hashes_and_no_other_column(spark, tmp_path):
    wh = w.Warehouse(spark, str(tmp_path / "wh"))

    def teams(*rows):
        made = [tuple({"id": i, "full_name": n, "year_founded": y}.get(c) for c in t.TEAM.columns) for i, n, y in rows]
        return spark.createDataFrame(made, t.TEAM.schema)

    w.sync_static(wh, t.TEAM, teams(("1", "a", "1949.0"), ("2", "b", "1950")), RUNS[0])
    stored = wh.stage_table(t.TEAM, hashed=True)
    assert stored.where("row_hash is null").isEmpty()
    computed = stored.select("id", row_hash(stored, t.TEAM.columns, t.TEAM.numeric).alias("h")).collect()
    assert {(r.id, r.row_hash) for r in stored.collect()} == {(r.id, r.h) for r in computed}
    scan = stored_hashes(stored, t.TEAM.key, t.TEAM.columns, t.TEAM.numeric)._jdf.queryExecution().executedPlan().toString()
    assert "row_hash" in scan and "full_name" not in scan
    assert w.sync_static(wh, t.TEAM, teams(("1", "a", "1949"), ("2", "B", "1950"), ("3", "c", None)), RUNS[1]).counts == {"unchanged": 1, "changed": 1, "new": 1}
    # Versions of an older layout have no hash: they are hashed when they are compared.
    stage.append(teams(("4", "d", "07")), wh.path("stage", "team"), RUNS[2])
    assert w.sync_static(wh, t.TEAM, teams(("1", "a", "1949"), ("2", "B", "1950.0"), ("4", "d", "7")), RUNS[3]).counts == {"unchanged": 3, "deleted": 1}
    assert wh.stage_table(t.TEAM).count() == 5 and wh.stage_table(t.TEAM).columns[:-1] == [*t.TEAM.columns]


# -------------------------------------------------------- newest versions


def team_source(spark, *rows):
    made = [tuple({"id": i, "full_name": n}.get(c) for c in t.TEAM.columns) for i, n in rows]
    return spark.createDataFrame(made, t.TEAM.schema)


def named(df):
    return sorted((r.id or "", r.full_name, r.load_timestamp) for r in df.collect())


def slice_files(wh):
    return files(newest.newest_path(wh.path("stage", "team")))


def team_buckets(spark, *ids):
    rows = spark.createDataFrame([(i,) for i in ids], "id string")
    return {r[0] for r in rows.select(bucket_of(t.TEAM.schema, t.TEAM.key, newest.BUCKETS)).collect()}


def test_the_newest_versions_follow_the_stage_table_bucket_by_bucket(spark, tmp_path):
    wh, path = w.Warehouse(spark, str(tmp_path / "wh")), str(tmp_path / "wh/stage/team")
    assert wh.newest_stage(t.TEAM).isEmpty() and not Path(newest.newest_path(path)).exists()
    first = [(str(i), "a") for i in range(60)] + [(None, "n"), ("7", "b")]  # a key that repeats, and none
    w.sync_static(wh, t.TEAM, team_source(spark, *first), RUNS[0])
    assert named(wh.newest_stage(t.TEAM)) == sorted((i or "", n, RUNS[0]) for i, n in first)
    before = slice_files(wh)

    stage.append(team_source(spark, ("3", "c"), ("90", "d")), path, RUNS[1])
    expected = sorted((i or "", n, RUNS[0]) for i, n in first if i != "3") + [("3", "c", RUNS[1]), ("90", "d", RUNS[1])]
    assert named(wh.newest_stage(t.TEAM)) == sorted(expected)
    assert {Path(f).parent.name for f in before ^ slice_files(wh)} == {f"bucket={b}" for b in team_buckets(spark, "3", "90") | {-newest.BUCKETS}}
    after = slice_files(wh)
    assert named(wh.newest_stage(t.TEAM)) == sorted(expected) and slice_files(wh) == after  # nothing new: nothing written

    # A run dated earlier than stored versions brings no newer one of a known key; a NULL key has a newest version too.
    stage.append(team_source(spark, ("3", "old"), ("91", "e"), (None, "m")), path, dt.datetime(2023, 1, 1))
    expected.append(("91", "e", dt.datetime(2023, 1, 1)))
    assert named(wh.newest_stage(t.TEAM)) == sorted(expected)
    assert wh.stage_table(t.TEAM).count() == len(first) + 5  # no version is removed from stage


def test_newest_versions_give_the_same_row_per_key_as_all_of_them(spark, tmp_path):
    wh, path = w.Warehouse(spark, str(tmp_path / "wh")), str(tmp_path / "wh/stage/team")
    for n, run in enumerate((RUNS[2], RUNS[0], RUNS[1], RUNS[3])):
        stage.append(team_source(spark, *((str(i % 40), f"{n}-{i}") for i in range(n * 7, 50 + n) if (i + n) % 3)), path, run)
        if n != 2:  # two runs at once are merged as well as one
            assert named(latest(wh.newest_stage(t.TEAM), ["id"])) == named(latest(wh.stage_table(t.TEAM), ["id"]))


def test_rows_without_a_stamp_stay_beside_the_newest(frame):
    rows = frame([("a", 1, RUNS[0]), ("a", 2, RUNS[1]), ("a", 3, None), ("b", 4, None), (None, 5, RUNS[0]), (None, 6, RUNS[1])],
                 "k string, v int, load_timestamp timestamp_ntz")
    assert {r.v for r in newest.newest_versions(rows, ["k"]).collect()} == {2, 3, 4, 6}
    assert newest.newest_versions(rows.where("false"), ["k"]).isEmpty()


def test_a_run_stored_anew_is_read_anew(spark, tmp_path):
    wh, path = w.Warehouse(spark, str(tmp_path / "wh")), str(tmp_path / "wh/stage/team")
    stage.append(team_source(spark, ("1", "a"), ("2", "a")), path, RUNS[0])
    assert len(named(wh.newest_stage(t.TEAM))) == 2
    stage.append(team_source(spark, ("1", "b")), path, RUNS[0])
    assert named(wh.newest_stage(t.TEAM)) == [("1", "b", RUNS[0])]


def test_a_slice_is_exchanged_whole_and_one_of_other_buckets_is_rebuilt(spark, tmp_path, monkeypatch):
    wh, path = w.Warehouse(spark, str(tmp_path / "wh")), str(tmp_path / "wh/stage/team")
    stage.append(team_source(spark, ("1", "a"), ("2", "a")), path, RUNS[0])
    wh.newest_stage(t.TEAM)
    stage.append(team_source(spark, ("1", "b"), ("3", "b")), path, RUNS[1])
    expected = [("1", "b", RUNS[1]), ("2", "a", RUNS[0]), ("3", "b", RUNS[1])]
    for stop in ("finish_pending", "overwrite_partitions"):
        monkeypatch.setattr(publish, stop, stopped)
        with pytest.raises(Stopped):
            newest.read_newest(wh.read("stage", "team", versions_schema()), path, t.TEAM.key)
        monkeypatch.undo()
    assert named(wh.newest_stage(t.TEAM)) == expected
    monkeypatch.setattr(newest, "BUCKETS", 5)
    assert named(wh.newest_stage(t.TEAM)) == expected
    assert {Path(f).parent.name for f in slice_files(wh)} <= {f"bucket={b}" for b in (-5, 0, 1, 2, 3, 4)}


def versions_schema():
    fields = [*t.TEAM.schema.fields, type(t.TEAM.schema["id"])("load_timestamp", t.NTZ), type(t.TEAM.schema["id"])("run", t.TEAM.schema["id"].dataType)]
    return type(t.TEAM.schema)(fields)


def test_a_covered_run_is_not_read_again(spark, tmp_path, monkeypatch):
    """Of stage only the runs that are new to the slice, and of the slice only the buckets they fall into."""
    wh, path = w.Warehouse(spark, str(tmp_path / "wh")), str(tmp_path / "wh/stage/team")
    stage.append(team_source(spark, *((str(i), "a") for i in range(50))), path, RUNS[0])
    wh.newest_stage(t.TEAM)
    stage.append(team_source(spark, ("1", "b")), path, RUNS[1])
    seen, fold = [], newest.newest_versions

    def watched(versions, keys):
        seen.append(versions.select("id", "load_timestamp").collect())
        return fold(versions, keys)

    monkeypatch.setattr(newest, "newest_versions", watched)
    held = wh.newest_stage(t.TEAM)
    plan = held._jdf.queryExecution().executedPlan().toString()
    new_rows, merged = seen
    assert [tuple(r) for r in new_rows] == [("1", RUNS[1])]
    assert team_buckets(spark, *(r.id for r in merged)) == team_buckets(spark, "1") and len(merged) < 20
    assert all("team__newest/bucket=" in f for f in held.inputFiles()) and "Window" not in plan and "Join" not in plan


def test_a_sync_compares_with_the_newest_versions(spark, tmp_path, monkeypatch):
    wh = w.Warehouse(spark, str(tmp_path / "wh"))
    w.sync_static(wh, t.TEAM, team_source(spark, ("1", "a"), ("2", "a"), ("2", "z")), RUNS[0])
    w.sync_static(wh, t.TEAM, team_source(spark, ("1", "b"), ("2", "a"), ("2", "z")), RUNS[1])
    compared, status = [], w.snapshot_status
    monkeypatch.setattr(w, "snapshot_status", lambda source, stored, *a, **b: (compared.append(named(stored)), status(source, stored, *a, **b))[1])
    assert w.sync_static(wh, t.TEAM, team_source(spark, ("1", "a"), ("2", "a"), ("2", "z")), RUNS[2]).counts == {"changed": 1, "unchanged": 1}
    assert compared == [[("1", "b", RUNS[1]), ("2", "a", RUNS[0]), ("2", "z", RUNS[0])]]


# ------------------------------------------------------------------ marts


def team_rows(spark, rows):
    schema = type(t.DIM_TEAM.schema)([t.DIM_TEAM.schema[n] for n in ("business_key", *t.DIM_TEAM.attributes, "load_timestamp")])
    return spark.createDataFrame([(key, name, "A", "c", None, None, stamp) for key, name, stamp in rows], schema)


def player_rows(spark, rows):
    schema = type(t.DIM_PLAYER.schema)([t.DIM_PLAYER.schema[n] for n in ("business_key", *t.DIM_PLAYER.attributes, "load_timestamp")])
    return spark.createDataFrame([(key, name, "f", "l", "G", 1, stamp) for key, name, stamp in rows], schema)


def shot_rows(spark, rows):
    names = [*t.FACT_SHOTS.key, *t.FACT_SHOTS.attributes, "load_timestamp"]
    schema = type(t.FACT_SHOTS.schema)([t.FACT_SHOTS.schema[n] for n in names])
    made = [(g, player, 1, 5, sec, team, 1, season - 2009, made_, "2PT Field Goal", 1.0, 2.0, 9, season, stamp) for g, player, sec, team, season, made_, stamp in rows]
    return spark.createDataFrame(made, schema)


def side_rows(spark, rows):
    names = [*t.FACT_GAMES.key, *t.FACT_GAMES.attributes, "load_timestamp"]
    schema = type(t.FACT_GAMES.schema)([t.FACT_GAMES.schema[n] for n in names])
    return spark.createDataFrame([(g, team, season - 2009, True, pts, 40, 80, 10, 25, 30, season, stamp) for g, team, season, pts, stamp in rows], schema)


@pytest.fixture
def loaded(spark, tmp_path):
    wh = w.Warehouse(spark, str(tmp_path / "wh"))
    years = [(y, f"{y}", RUNS[0]) for y in (2010, 2011, 2012)]
    w.load_upsert(wh, t.DIM_TIME, spark.createDataFrame(years, "season_year int, season_name string, load_timestamp timestamp_ntz"))
    w.load_upsert(wh, t.DIM_ZONE, spark.createDataFrame([("z", "n", "r", "a", RUNS[0])], "basic_zone string, zone_name string, zone_range string, zone_abb string, load_timestamp timestamp_ntz"))
    w.load_history(wh, t.DIM_TEAM, team_rows(spark, [("1", "One", RUNS[0]), ("2", "Two", RUNS[0])]), RUNS[0])
    w.load_history(wh, t.DIM_PLAYER, player_rows(spark, [("7", "P", RUNS[0])]), RUNS[0])
    w.load_upsert(wh, t.FACT_SHOTS, shot_rows(spark, [(1, 7, 1, 1, 2010, True, RUNS[0]), (2, 7, 1, 2, 2011, True, RUNS[0]), (3, 7, 1, 1, 2012, False, RUNS[0]),
                                                      (4, 8, 1, 1, 2012, True, RUNS[0])]))
    w.load_upsert(wh, t.FACT_GAMES, side_rows(spark, [(1, 1, 2010, 90, RUNS[0]), (2, 2, 2011, 80, RUNS[0]), (3, 1, 2012, 70, RUNS[0])]))
    w.load_marts(wh, RUNS[0])
    return wh


MARTS = (("player_shot_efficiency", t.PLAYER_SHOT_EFFICIENCY), ("team_attack_efficiency", t.TEAM_ATTACK_EFFICIENCY), ("three_point_trends", t.THREE_POINT_TRENDS))


def mart_rows(wh):
    return {name: sorted(map(str, wh.read("dm", name, schema).drop("load_timestamp").collect())) for name, schema in MARTS}


def refreshed(wh, run):
    """Seasons rewritten per mart; the marts must equal those of a full rebuild from the same tables."""
    before = {name: files(wh.path("dm", name)) for name, _ in MARTS}
    w.load_marts(wh, run)
    touched = {name: {f.split("/")[0].removeprefix("season_year=") for f in before[name] ^ files(wh.path("dm", name))} for name, _ in MARTS}
    whole = w.Warehouse(wh.spark, wh.root + "_whole")
    for table in (t.DIM_TIME, t.DIM_ZONE, t.DIM_TEAM, t.DIM_PLAYER, t.FACT_SHOTS, t.FACT_GAMES):
        wh.table(table).write.mode("overwrite").parquet(whole.path("dds", table.name))
    for name, _ in MARTS:
        publish.delete_path(wh.spark, whole.path("dm", name))
    w.load_marts(whole, run)
    assert mart_rows(wh) == mart_rows(whole)
    return [touched[name] for name, _ in MARTS]


def test_marts_fold_changed_seasons_alone(loaded, spark):
    assert refreshed(loaded, RUNS[1]) == [set(), set(), set()]  # nothing changed since
    w.load_upsert(loaded, t.FACT_SHOTS, shot_rows(spark, [(2, 7, 1, 2, 2011, False, RUNS[2])]))
    assert refreshed(loaded, RUNS[2]) == [{"2011"}, set(), set()]
    w.load_upsert(loaded, t.FACT_GAMES, side_rows(spark, [(9, 2, 2012, 60, RUNS[3])]))
    assert refreshed(loaded, RUNS[3]) == [set(), {"2012"}, {"2012"}]


def test_a_moved_fact_refolds_both_seasons_and_an_empty_one_goes(loaded, spark):
    w.load_upsert(loaded, t.FACT_GAMES, side_rows(spark, [(2, 2, 2012, 85, RUNS[1])]))
    assert refreshed(loaded, RUNS[1]) == [set(), {"2011", "2012"}, {"2011", "2012"}]
    assert not [f for f in files(loaded.path("dm", "three_point_trends")) if f.startswith("season_year=2011")]


def test_a_changed_team_and_a_new_player_bring_in_their_seasons(loaded, spark):
    w.load_history(loaded, t.DIM_TEAM, team_rows(spark, [("2", "Renamed", RUNS[1])]), RUNS[1])
    assert refreshed(loaded, RUNS[1]) == [{"2011"}] * 3
    # A player who was unknown when his shots came: the mart had no row of his.
    w.load_history(loaded, t.DIM_PLAYER, player_rows(spark, [("8", "Late", RUNS[2])]), RUNS[2])
    assert refreshed(loaded, RUNS[2]) == [{"2012"}, set(), set()]
    w.load_history(loaded, t.DIM_TEAM, team_rows(spark, [("2", "Renamed", RUNS[3])]), RUNS[3])  # newer, but the same
    assert refreshed(loaded, RUNS[3]) == [set()] * 3


def test_a_refresh_that_dies_is_done_again(loaded, spark, monkeypatch):
    w.load_upsert(loaded, t.FACT_SHOTS, shot_rows(spark, [(2, 7, 1, 2, 2011, False, RUNS[1])]))
    monkeypatch.setattr(w, "refresh_partitions", stopped)
    with pytest.raises(Stopped):
        w.load_marts(loaded, RUNS[1])
    monkeypatch.undo()
    assert refreshed(loaded, RUNS[2]) == [{"2011"}, set(), set()]
    assert changes.recorded(spark, loaded.changed).isEmpty()


def test_a_mart_that_would_lose_all_rows_stays(loaded, spark, frame):
    path, key = loaded.path("dm", "m"), ["k"]
    rows = frame([("a", 2010), ("b", 2011)], "k string, season_year int")
    assert publish.refresh_partitions(rows, path, key, "m", "season_year", None) == 2
    assert publish.refresh_partitions(rows.where("false"), path, key, "m", "season_year", [2010, 2011]) == 0
    assert publish.refresh_partitions(rows.where("false"), path, key, "m", "season_year", None) == 0
    assert spark.read.parquet(path).count() == 2
    assert publish.refresh_partitions(rows.where("false"), path, key, "m", "season_year", [2010]) == 0
    assert [r.k for r in spark.read.parquet(path).collect()] == ["b"]  # one season of several may go
    with pytest.raises(DuplicateKeyError):
        publish.refresh_partitions(rows.unionByName(rows), path, key, "m", "season_year", None)


def test_a_mart_of_the_older_layout_is_rebuilt(loaded, spark):
    name, schema = MARTS[1]
    rows = spark.createDataFrame(loaded.read("dm", name, schema).collect(), schema)
    publish.delete_path(spark, loaded.path("dm", name))
    publish.refresh_unless_empty(rows, loaded.path("dm", name), ["team_id", "season_year"], name)
    w.load_marts(loaded, RUNS[1])
    assert len(loaded.read("dm", name, schema).collect()) == 3 and not publish.path_exists(spark, loaded.path("dm", f"{name}/slice=all"))
