"""Registered queries on deltas, merges, history, snapshots and keys."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hardwood.catalog import standins as s
from hardwood.functions.hashing import row_hash
from hardwood.operators.audit import load_audit, season_backlog
from hardwood.operators.delta import known_rows, newer_than_target
from hardwood.operators.latest import STAMP, latest
from hardwood.operators.scd2 import history_of
from hardwood.operators.snapshot import deleted_keys, rows_to_append, snapshot_status
from hardwood.operators.surrogate import assign_ids
from hardwood.operators.upsert import upsert
from hardwood.session import materialize

KEY = ["user_id", "event_type"]


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return s.read(spark, sf_dir, "events").select("event_id", *KEY, "value", "ts")


def latest_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest(s.read(spark, sf_dir, "events"), ["user_id"], "ts")


LATEST_PER_KEY_SQL = """
    SELECT * FROM events QUALIFY row_number() OVER (
        PARTITION BY user_id ORDER BY ts DESC, event_id, event_type, value, props) = 1
"""


def _newest_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest(_events(spark, sf_dir), KEY, "ts")


def _stored_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """State of the first two weeks, before anybody signed up."""
    early = _events(spark, sf_dir).where("ts < timestamp_ntz'2024-01-15 00:00:00' and event_type <> 'signup'")
    return latest(early, KEY, "ts")


_MERGE = """
    newest AS (
        SELECT event_id, user_id, event_type, value, ts FROM events
        QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id, value) = 1
    ),
    stored AS (
        SELECT event_id, user_id, event_type, value, ts FROM events
        WHERE ts < TIMESTAMP '2024-01-15 00:00:00' AND event_type <> 'signup'
        QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id, value) = 1
    )
"""


def delta_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return newer_than_target(_newest_events(spark, sf_dir), _stored_events(spark, sf_dir), KEY, "ts")


DELTA_BY_KEY_SQL = f"""
    WITH {_MERGE}
    SELECT n.*, CASE WHEN s.ts IS NULL THEN 'inserted' ELSE 'updated' END AS status
    FROM newest n LEFT JOIN stored s USING (user_id, event_type) WHERE s.ts IS NULL OR n.ts > s.ts
"""


def upsert_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored rows with ids, the newest rows merged in; known keys keep their id."""
    target = assign_ids(_stored_events(spark, sf_dir), KEY, "row_id")
    staged = materialize(_newest_events(spark, sf_dir), "candidates")
    known = known_rows(staged, target, KEY, ["ts", "row_id"])
    changes = newer_than_target(staged, known, KEY, "ts", carry=["row_id"])
    last = target.agg(F.max("row_id")).first()[0] or 0
    return upsert(target, assign_ids(changes, KEY, "row_id", last, known="known_row_id"), KEY)


UPSERT_MERGE_SQL = f"""
    WITH {_MERGE},
    target AS (SELECT *, row_number() OVER (ORDER BY user_id, event_type) AS row_id FROM stored),
    fresh AS (
        SELECT n.*, row_number() OVER (ORDER BY user_id, event_type) + (SELECT max(row_id) FROM target) AS row_id
        FROM newest n ANTI JOIN target USING (user_id, event_type)
    )
    SELECT row_id, n.event_id, n.user_id, n.event_type, n.value, n.ts
    FROM newest n JOIN target t USING (user_id, event_type)
    UNION ALL SELECT row_id, event_id, user_id, event_type, value, ts FROM fresh
"""


def scd2_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weekly batches of each user's newest event type as one history."""
    events = _events(spark, sf_dir).withColumn("week", F.date_trunc("week", "ts").cast("date"))
    batches = latest(events, ["week", "user_id"], "ts").select("week", "user_id", "event_type", "ts")
    return history_of(batches, ["user_id"], ["event_type"], "ts")


SCD2_HISTORY_SQL = """
    WITH batches AS (
        SELECT user_id, event_type, ts FROM events
        QUALIFY row_number() OVER (PARTITION BY user_id, date_trunc('week', ts) ORDER BY ts DESC, event_id) = 1
    ),
    versions AS (
        SELECT * FROM batches
        QUALIFY lag(event_type) OVER (PARTITION BY user_id ORDER BY ts) IS DISTINCT FROM event_type
    ),
    history AS (
        SELECT user_id, event_type, ts AS valid_from, lead(ts) OVER (PARTITION BY user_id ORDER BY ts) AS valid_to
        FROM versions
    )
    SELECT *, valid_to IS NULL AS is_active FROM history
"""

CUSTOMER = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]


def _snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Today's customers: debtors below -900 are gone, machinery buyers got 100 and extra blanks."""
    machinery = F.col("c_mktsegment") == "MACHINERY"
    return s.read(spark, sf_dir, "customer").where("c_acctbal >= -900").withColumns({
        "c_acctbal": F.when(machinery, F.col("c_acctbal") + 100).otherwise(F.col("c_acctbal")),
        "c_name": F.concat(F.lit(" "), "c_name", F.lit(" ")),
    })


def _stored_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stage holds all but the richest, building buyers in an old and a newer version."""
    customer = s.read(spark, sf_dir, "customer").where("c_acctbal <= 9000")
    old = customer.where("c_mktsegment = 'BUILDING'").withColumn("c_acctbal", F.col("c_acctbal") - 1)
    first, second = (F.lit(f"2024-0{m}-01 00:00:00").cast("timestamp_ntz") for m in (1, 2))
    return old.withColumn(STAMP, first).unionByName(customer.withColumn(STAMP, second))


def snapshot_sync_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snapshot_status(_snapshot(spark, sf_dir), _stored_customers(spark, sf_dir), ["c_custkey"], CUSTOMER)


_STATUS = """
    SELECT c_custkey, c_acctbal >= -900 AS here, CASE WHEN c_acctbal > 9000 THEN 'new' WHEN c_acctbal < -900 THEN 'deleted'
           WHEN c_mktsegment = 'MACHINERY' THEN 'changed' ELSE 'unchanged' END AS status,
           concat(' ', c_name, ' ') AS c_name, c_nationkey,
           CASE WHEN c_mktsegment = 'MACHINERY' THEN c_acctbal + 100 ELSE c_acctbal END AS c_acctbal, c_mktsegment
    FROM customer
"""

SNAPSHOT_SYNC_STATUS_SQL = f"""
    SELECT c_custkey, CASE WHEN here THEN c_name END AS c_name, CASE WHEN here THEN c_nationkey END AS c_nationkey,
           CASE WHEN here THEN c_acctbal END AS c_acctbal, CASE WHEN here THEN c_mktsegment END AS c_mktsegment, status
    FROM ({_STATUS})
"""


def snapshot_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rows_to_append(snapshot_sync_status(spark, sf_dir))


def deleted_key_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deleted_keys(snapshot_sync_status(spark, sf_dir), ["c_custkey"])


def load_audit_by_segment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load_audit(snapshot_sync_status(spark, sf_dir), "c_mktsegment")


def row_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = s.read(spark, sf_dir, "customer").withColumn("note", F.when(F.col("c_acctbal") > 0, F.lit(" x ")))
    return customer.select("c_custkey", row_hash(customer, [*CUSTOMER, "note"]).alias("row_hash"))


ROW_FINGERPRINTS_SQL = """
    SELECT c_custkey, md5(concat_ws(chr(31), CAST(c_custkey AS VARCHAR), c_name, CAST(c_nationkey AS VARCHAR),
        CASE WHEN floor(c_acctbal) = c_acctbal THEN CAST(CAST(c_acctbal AS BIGINT) AS VARCHAR)
             ELSE CAST(c_acctbal AS VARCHAR) END, c_mktsegment,
        CASE WHEN c_acctbal > 0 THEN 'x' ELSE '' END)) AS row_hash
    FROM customer
"""


def assign_surrogate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = s.read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber").distinct()
    return assign_ids(pairs, ["l_orderkey", "l_linenumber"], "row_id", 1000)


ASSIGN_SURROGATE_KEYS_SQL = """
    SELECT l_orderkey, l_linenumber, 1000 + row_number() OVER (ORDER BY l_orderkey, l_linenumber) AS row_id
    FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)
"""


def waiting_seasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = s.read(spark, sf_dir, "lineitem").select(F.year("l_shipdate").alias("season"))
    stage = s.read(spark, sf_dir, "orders").select(F.year("o_orderdate").alias("season"))
    return season_backlog(source, stage.where("season not in (1996, 2000)"), "season")


SEASON_BACKLOG_SQL = """
    SELECT CAST(year(l_shipdate) AS INTEGER) AS season, COUNT(*) AS n_rows FROM lineitem
    WHERE year(l_shipdate) NOT IN (SELECT year(o_orderdate) FROM orders WHERE year(o_orderdate) NOT IN (1996, 2000))
    GROUP BY 1
"""

QUERIES = {
    "latest_per_key": (latest_per_key, LATEST_PER_KEY_SQL),
    "delta_by_key": (delta_by_key, DELTA_BY_KEY_SQL),
    "upsert_merge": (upsert_merge, UPSERT_MERGE_SQL),
    "scd2_history": (scd2_history, SCD2_HISTORY_SQL),
    "snapshot_sync_status": (snapshot_sync_status, SNAPSHOT_SYNC_STATUS_SQL),
    "snapshot_append": (snapshot_append, f"""
        SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM ({_STATUS})
        WHERE status IN ('new', 'changed')"""),
    "deleted_key_report": (deleted_key_report, f"""
        SELECT c_custkey, concat('c_custkey:', c_custkey) AS description FROM ({_STATUS}) WHERE status = 'deleted'"""),
    "load_audit": (load_audit_by_segment, f"""
        SELECT c_mktsegment, status, COUNT(*) AS n_rows FROM ({SNAPSHOT_SYNC_STATUS_SQL}) GROUP BY 1, 2"""),
    "row_fingerprints": (row_fingerprints, ROW_FINGERPRINTS_SQL),
    "assign_surrogate_keys": (assign_surrogate_keys, ASSIGN_SURROGATE_KEYS_SQL),
    "season_backlog": (waiting_seasons, SEASON_BACKLOG_SQL),
}
