"""Merge, history, snapshot, key and quality operators on hand-made and random rows."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from hardwood.operators.audit import load_audit, null_zero_counts, season_backlog
from hardwood.operators.constraints import DuplicateKeyError, align, check_unique, fill_defaults, missing_required
from hardwood.operators.delta import known_rows, newer_than_target
from hardwood.operators.latest import latest, latest_of_few
from hardwood.operators import publish
from hardwood.operators.publish import refresh_unless_empty
from hardwood.operators.quality import MissingColumnsError, comment, quality, text_lengths
from hardwood.operators.scd2 import advance, classify, history_of
from hardwood.operators.snapshot import deleted_keys, rows_to_append, snapshot_status
from hardwood.operators.surrogate import assign_ids
from hardwood.operators.upsert import upsert
from hardwood.session import materialize
from hardwood.tables import QualityRules

DAY = [dt.datetime(2024, 1, d) for d in range(1, 29)]
ROW = "k string, q int, v string, load_timestamp timestamp_ntz"


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


# ------------------------------------------------------------ latest, delta


def test_latest_takes_the_newest_and_settles_ties(frame):
    df = frame([("a", 1, "x", DAY[0]), ("a", 1, "y", DAY[1]), ("b", 1, "q", DAY[0]), ("b", 1, "p", DAY[0]),
                ("c", None, "n", DAY[0]), ("c", None, "m", None)], ROW)
    assert rows(latest(df, ["k", "q"]), "k", "v") == [("a", "y"), ("b", "p"), ("c", "m")]


def test_latest_of_few_agrees_with_latest(frame):
    df = frame([(random.choice("abc"), 1, random.choice("xyz"), random.choice(DAY)) for _ in range(200)], ROW)
    assert rows(latest_of_few(df, ["k"], ["v"]), "k", "v") == rows(latest(df.drop("q"), ["k"]), "k", "v")


def test_delta_keeps_absent_and_newer_keys(frame):
    target = frame([("a", 1, "x", DAY[1]), ("b", 1, "x", DAY[1]), ("n", None, "x", DAY[1])], ROW)
    candidates = frame([("a", 1, "eq", DAY[1]), ("b", 1, "new", DAY[2]), ("c", 1, "abs", DAY[0]),
                        ("n", None, "eq", DAY[1])], ROW)
    delta = newer_than_target(candidates, target, ["k", "q"], nullable=["q"], carry=["v"])
    assert rows(delta, "k", "v", "known_v", "status") == [("b", "new", "x", "updated"), ("c", "abs", None, "inserted")]


@pytest.mark.parametrize("threshold", ["-1", "10m"])
def test_known_rows_with_and_without_broadcast(frame, spark, threshold):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    target = frame([("a", None, "x", DAY[1]), ("z", 1, "x", DAY[1])], ROW)
    candidates = frame([("a", None, "y", DAY[2]), ("b", 1, "y", DAY[2])], ROW)
    known = known_rows(candidates, target, ["k", "q"], ["v", "load_timestamp"], ["q"])
    delta = newer_than_target(candidates, known, ["k", "q"], carry=["v"], nullable=["q"])
    assert rows(delta, "k", "known_v", "status") == [("a", "x", "updated"), ("b", None, "inserted")]
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_upsert_over_random_batches_is_the_newest_row_per_key(frame, spark):
    random.seed(7)
    batches = [
        [(random.choice("abcdef"), random.choice([1, 2, None]), f"{b}-{i}", random.choice(DAY)) for i in range(30)]
        for b in range(4)
    ]
    target = frame([], ROW)
    for batch in batches:
        candidates = latest(frame(batch, ROW), ["k", "q"])
        target = materialize(
            upsert(target, newer_than_target(candidates, target, ["k", "q"], nullable=["q"]), ["k", "q"], ["q"]), "t")
    best = {}
    for batch in batches:  # an equal stamp never replaces an earlier batch's row
        newest = {}
        for k, q, v, ts in sorted(batch, key=lambda r: r[2]):
            if (k, q) not in newest or ts > newest[k, q][1]:
                newest[k, q] = (v, ts)
        for key, (v, ts) in newest.items():
            if key not in best or ts > best[key][1]:
                best[key] = (v, ts)
    assert rows(target, "k", "q", "v") == sorted(((*key, v) for key, (v, _) in best.items()), key=str)


# -------------------------------------------------------------------- scd2


HISTORY = "k string, v string, load_timestamp timestamp_ntz, valid_from timestamp_ntz, valid_to timestamp_ntz, " \
          "is_active boolean"


def step_through(frame, batches):
    """Apply batches of (key, value, stamp) in order; all versions at the end."""
    active, closed = frame([], HISTORY), []
    statuses = []
    for batch in batches:
        delta = latest(frame(batch, "k string, v string, load_timestamp timestamp_ntz"), ["k"])
        classified = materialize(classify(active, delta, ["k"], ["v"]), "c")
        statuses.append(dict(rows(classified, "k", "status")))
        step = advance(active, classified, ["k"], ["v"])
        closed += step.closed.collect()
        active = materialize(step.untouched.unionByName(step.opened), "a")
    return sorted(map(tuple, closed + active.collect()), key=str), statuses


def test_scd2_opens_closes_and_ignores(frame):
    got, statuses = step_through(frame, [
        [("a", "1", DAY[1]), ("b", None, DAY[1]), ("c", "1", DAY[5]), ("d", "1", DAY[1])],
        [("a", "2", DAY[2]), ("b", "1", DAY[2]), ("c", "9", DAY[4]), ("d", "1", DAY[2]), ("e", "1", DAY[2])],
        [("b", None, DAY[3])],
    ])
    assert statuses[1] == {"a": "updated", "b": "updated", "d": "unchanged", "e": "inserted"}
    assert got == sorted([
        ("a", "1", DAY[1], DAY[1], DAY[2], False), ("a", "2", DAY[2], DAY[2], None, True),
        ("b", None, DAY[1], DAY[1], DAY[2], False), ("b", "1", DAY[2], DAY[2], DAY[3], False),
        ("b", None, DAY[3], DAY[3], None, True),
        ("c", "1", DAY[5], DAY[5], None, True),
        ("d", "1", DAY[1], DAY[1], None, True),  # a newer stamp alone changes nothing
        ("e", "1", DAY[2], DAY[2], None, True),
    ], key=str)


def test_scd2_intervals_are_contiguous_with_one_active_version(frame):
    random.seed(3)
    batches = [[(random.choice("abcd"), random.choice("xy"), DAY[3 * b + random.randrange(3)]) for _ in range(6)]
               for b in range(5)]
    got, _ = step_through(frame, batches)
    for key in {r[0] for r in got}:
        versions = sorted((r for r in got if r[0] == key), key=lambda r: r[3])
        assert [r[5] for r in versions] == [False] * (len(versions) - 1) + [True]
        assert all(a[4] == b[3] and a[1] != b[1] for a, b in zip(versions, versions[1:]))
        assert versions[-1][4] is None


# ---------------------------------------------------------------- snapshot


def test_snapshot_compares_with_the_latest_version_only(frame):
    schema = "k string, v string"
    stage = frame([("a", "1", DAY[0]), ("a", "2", DAY[1]), ("b", "1", DAY[0]), ("gone", "1", DAY[0])],
                  f"{schema}, load_timestamp timestamp_ntz")
    source = frame([("a", "2"), ("b", "9"), ("c", "1"), ("c", "1"), (None, "1")], schema)
    status = materialize(snapshot_status(source, stage, ["k"], ["k", "v"]), "s")
    assert rows(status, "k", "v", "status") == [
        ("a", "2", "unchanged"), ("b", "9", "changed"), ("c", "1", "new"), ("gone", None, "deleted"),
        (None, "1", "new")]
    assert rows(load_audit(status), "status", "n_rows") == [
        ("changed", 1), ("deleted", 1), ("new", 2), ("unchanged", 1)]
    assert rows(deleted_keys(status, ["k"]), "description") == [("k:gone",)]
    appended = rows_to_append(status).withColumn("load_timestamp", F.lit(DAY[2]).cast("timestamp_ntz"))
    again = snapshot_status(source, stage.unionByName(appended), ["k"], ["k", "v"])
    assert rows_to_append(again).isEmpty()


# --------------------------------------------------------- keys and schemas


def test_ids_are_dense_in_key_order_and_known_ones_stay(frame):
    df = frame([(f"{i:03d}", None if i % 3 else i) for i in range(50)], "k string, known bigint")
    got = dict(rows(assign_ids(df, ["k"], "id", 100, known="known"), "k", "id"))
    assert all(got[f"{i:03d}"] == i for i in range(0, 50, 3))
    fresh = [got[f"{i:03d}"] for i in range(50) if i % 3]
    assert fresh == list(range(101, 101 + len(fresh)))
    assert rows(assign_ids(df.where("k < '000'"), ["k"], "id"), "id") == []


def test_align_unique_and_required(frame, spark):
    from pyspark.sql import types as T

    df = frame([("a", "1"), ("a", None)], "k string, v string")
    schema = T.StructType([T.StructField("v", T.IntegerType()), T.StructField("k", T.StringType()),
                           T.StructField("load_timestamp", T.TimestampNTZType()),
                           T.StructField("valid_to", T.TimestampNTZType()),
                           T.StructField("is_active", T.BooleanType())])
    epoch = dt.datetime(1970, 1, 1)
    assert rows(align(df, schema), "*") == sorted(
        [(1, "a", epoch, None, True), (None, "a", epoch, None, True)], key=str)
    with pytest.raises(ValueError):
        align(df.drop("v"), schema)
    with pytest.raises(DuplicateKeyError):
        check_unique(df, ["k"], "t")
    check_unique(df, ["k", "v"], "t")
    assert rows(df.select(missing_required(["k", "v"])), "*") == [("null_v",), (None,)]
    old = frame([("a", None)], "k string, load_timestamp timestamp_ntz")
    assert rows(fill_defaults(old, ["load_timestamp", "valid_from"]), "load_timestamp") == [(epoch,)]


def test_an_empty_mart_leaves_the_old_one(frame, spark, tmp_path):
    path = str(tmp_path / "mart")
    df = frame([("a", 1)], "k string, v int")
    assert refresh_unless_empty(df, path, ["k"], "m") == 1
    assert refresh_unless_empty(df.where("v > 1"), path, ["k"], "m") == 0
    assert rows(spark.read.parquet(path), "k", "v") == [("a", 1)]
    with pytest.raises(DuplicateKeyError):
        refresh_unless_empty(df.unionByName(df), path, ["k"], "m")
    assert rows(spark.read.parquet(path), "k", "v") == [("a", 1)]


def test_history_of_a_backlog_is_what_its_batches_give_one_by_one(frame):
    random.seed(5)
    batches = [[(random.choice("abcd"), random.choice(["x", "y", None]), DAY[3 * b + random.randrange(3)]) for _ in range(6)]
               for b in range(5)]
    got, _ = step_through(frame, batches)
    schema = "b int, k string, v string, load_timestamp timestamp_ntz"
    backlog = latest(frame([(b, *row) for b, batch in enumerate(batches) for row in batch], schema), ["b", "k"]).drop("b")
    assert rows(history_of(backlog, ["k"], ["v"]), "k", "v", "valid_from", "valid_to", "is_active") == sorted(
        [(r[0], r[1], r[3], r[4], r[5]) for r in got], key=str)


@pytest.mark.parametrize("stop", ["rows", "emptied", "ready", "exchange"])
def test_an_interrupted_exchange_is_completed_or_left_out(frame, spark, tmp_path, monkeypatch, stop):
    path = str(tmp_path / "t")
    publish.commit(frame([("a", 1), ("b", 2)], "k string, p int"), path, ["p"])
    after = frame([("a", 2), ("b", 2)], "k string, p int")

    class Stopped(Exception):
        pass

    def stopped(*args):
        raise Stopped

    if stop == "ready":
        monkeypatch.setattr(publish, "finish_pending", stopped)
    elif stop == "exchange":
        whole = publish.overwrite_partitions
        monkeypatch.setattr(publish, "overwrite_partitions", lambda *a: (whole(*a), stopped()))
    else:
        calls = iter(range(9))
        exists = {"rows": 0, "emptied": 1}[stop]
        create = spark.createDataFrame
        monkeypatch.setattr(type(spark), "createDataFrame", lambda self, *a, **b: stopped() if next(calls) == exists else create(*a, **b))
    with pytest.raises(Stopped):
        publish.commit(after, path, ["p"], ["p=1"])
    monkeypatch.undo()
    done = publish.finish_pending(spark, path)
    assert done == (stop in ("ready", "exchange"))
    assert rows(spark.read.parquet(path), "k", "p") == ([("a", 2), ("b", 2)] if done else [("a", 1), ("b", 2)])
    assert not publish.path_exists(spark, publish._pending(path)) and not publish.finish_pending(spark, path)


# ----------------------------------------------------------------- quality


def test_quality_report_counts_and_comment(frame):
    rules = QualityRules(
        required=("id", "team"), unique=("id",), null_keys_are_surplus=True, numeric=("n",),
        numeric_and_present=("id",), boolean=("b",), non_negative=("n",), between=(("y", 1800, 2023),),
    )
    df = frame([
        ("1", "t", "5", "true", "1949"), ("1", None, "-2", "FALSE", "1799"), (None, "t", "x", "maybe", None),
        ("a", "t", None, None, "2024"),
    ], "id string, team string, n string, b string, y string")
    report = quality(df, rules, "demo")
    assert report.columns == ["table", "check", "column", "n_bad", "n_rows"]
    got = {(r.check, r.column): r.n_bad for r in report.collect()}
    assert got == {
        ("missing", "id"): 1, ("missing", "team"): 1, ("format", "n"): 1, ("format", "id"): 2, ("format", "b"): 2,
        ("business_rule", "n"): 1, ("business_rule", "y"): 2, ("duplicate", "id"): 2,
    }
    remark = comment(report.collect())
    assert all(part in remark for part in ("missing id=1", "missing team=1", "duplicate id=2", "format b=2", "business_rule y=2"))
    assert {r.n_rows for r in report.collect()} == {4}
    with pytest.raises(MissingColumnsError):
        quality(df.drop("team"), rules, "demo")
    empty = quality(df.where("id = 'none'"), rules, "demo").collect()
    assert {(r.n_bad, r.n_rows) for r in empty} == {(0, 0)}


def test_duplicates_count_a_null_key_as_one_value_unless_told(frame):
    df = frame([("a", None), ("a", None), ("a", 1)], "id string, season int")
    for surplus, expected in ((False, 1), (True, 2)):
        rules = QualityRules(required=("id",), unique=("id", "season"), null_keys_are_surplus=surplus)
        report = quality(df, rules, "demo").where("check = 'duplicate'").first()
        assert (report.column, report.n_bad) == ("id, season", expected)


def test_text_lengths(frame):
    df = frame([("abc", 12345), (None, 1)], "s string, n int")
    assert rows(text_lengths(df, "t", {"s": 2, "n": 5}), "column", "max_length", "too_long") == [
        ("n", 5, False), ("s", 3, True)]


def test_backlog_and_null_zero_counts(frame):
    source = frame([(2010,), (2010,), (2011,), (None,)], "season int")
    assert rows(season_backlog(source, frame([], "season int"), "season"), "*") == [(2010, 2), (2011, 1)]
    assert rows(season_backlog(source, frame([(2010,)], "season int"), "season"), "*") == [(2011, 1)]
    assert rows(season_backlog(source, frame([(2010,), (2011,)], "season int"), "season"), "*") == []
    delta = frame([(1, None), (2, 2)], "home bigint, away bigint")
    stage = frame([("0", "1"), ("1", "0"), (None, "2")], "home string, away string")
    assert rows(null_zero_counts(delta, ["home", "away"], stage, ["home", "away"]), "*") == [
        ("null_ids", 1), ("zero_ids", 2)]
