"""Registered queries on quality, constraints and schemas."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hardwood.catalog import standins as s
from hardwood.operators.audit import null_zero_counts
from hardwood.operators.constraints import align, missing_required, repeated_keys
from hardwood.operators.latest import latest
from hardwood.operators.quality import quality, text_lengths
from hardwood.tables import NTZ, QualityRules

RULES = {
    "orders": QualityRules(
        required=("o_orderkey", "o_custkey"), unique=("o_custkey",), null_keys_are_surplus=True,
        numeric=("o_orderpriority", "o_totalprice"), non_negative=("o_totalprice",),
        between=(("o_totalprice", 5000.0, 400000.0),),
    ),
    "lineitem": QualityRules(
        required=("l_orderkey", "l_shipdate"), unique=("l_orderkey", "l_linenumber"),
        boolean=("l_linestatus",), non_negative=("l_quantity",), between=(("l_discount", 0.0, 0.05),),
    ),
    "documents": QualityRules(
        required=("doc_id", "text"), unique=("source", "n_chars"), numeric_and_present=("source",),
        between=(("n_chars", 100.0, 10000.0),),
    ),
    "labels": QualityRules(
        required=("doc_id", "quality", "toxic"), unique=("quality", "toxic"), boolean=("quality",),
        between=(("toxic", 0.0, 0.5),),
    ),
}


def _checked(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    frame = s.read(spark, sf_dir, name)
    if name == "orders":  # open orders have lost their customer
        return frame.withColumn("o_custkey", F.when(F.col("o_orderstatus") != "P", F.col("o_custkey")))
    return frame


def quality_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    reports = [quality(_checked(spark, sf_dir, name), rules, name) for name, rules in RULES.items()]
    return reduce(DataFrame.unionByName, reports)


def _check_sql(table: str, check: str, column: str, bad: str, source: str | None = None) -> str:
    return (
        f"SELECT '{table}' AS \"table\", '{check}' AS \"check\", '{column}' AS \"column\", "
        f"CAST(count(*) FILTER ({bad}) AS BIGINT) AS n_bad, COUNT(*) AS n_rows FROM {source or table}"
    )


def _duplicates_sql(table: str, columns: str, distinct: str, source: str | None = None) -> str:
    return (
        f"SELECT '{table}', 'duplicate', '{columns}', COUNT(*) - {distinct}, COUNT(*) FROM {source or table}"
    )


_ORDERS = "(SELECT * REPLACE (CASE WHEN o_orderstatus <> 'P' THEN o_custkey END AS o_custkey) FROM orders)"
_LINE_PAIRS = "(SELECT COUNT(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem))"
_DOCUMENT_PAIRS = "(SELECT COUNT(*) FROM (SELECT DISTINCT source, n_chars FROM documents))"
_LABEL_PAIRS = "(SELECT COUNT(*) FROM (SELECT DISTINCT quality, toxic FROM labels))"

QUALITY_REPORT_SQL = " UNION ALL ".join((
    _check_sql("orders", "missing", "o_orderkey", "o_orderkey IS NULL", _ORDERS),
    _check_sql("orders", "missing", "o_custkey", "o_custkey IS NULL", _ORDERS),
    _check_sql("orders", "format", "o_orderpriority", "TRY_CAST(o_orderpriority AS DOUBLE) IS NULL", _ORDERS),
    _check_sql("orders", "format", "o_totalprice", "FALSE", _ORDERS),
    _check_sql("orders", "business_rule", "o_totalprice", "o_totalprice < 0", _ORDERS),
    _check_sql("orders", "business_rule", "o_totalprice", "o_totalprice NOT BETWEEN 5000 AND 400000", _ORDERS),
    _duplicates_sql("orders", "o_custkey", "COUNT(DISTINCT o_custkey)", _ORDERS),
    _check_sql("lineitem", "missing", "l_orderkey", "l_orderkey IS NULL"),
    _check_sql("lineitem", "missing", "l_shipdate", "l_shipdate IS NULL"),
    _check_sql("lineitem", "format", "l_linestatus", "l_linestatus NOT IN ('TRUE', 'FALSE')"),
    _check_sql("lineitem", "business_rule", "l_quantity", "l_quantity < 0"),
    _check_sql("lineitem", "business_rule", "l_discount", "l_discount NOT BETWEEN 0.0 AND CAST(0.05 AS DOUBLE)"),
    _duplicates_sql("lineitem", "l_orderkey, l_linenumber", _LINE_PAIRS),
    _check_sql("documents", "missing", "doc_id", "doc_id IS NULL"),
    _check_sql("documents", "missing", "text", "text IS NULL"),
    _check_sql("documents", "format", "source", "TRY_CAST(source AS DOUBLE) IS NULL"),
    _check_sql("documents", "business_rule", "n_chars", "n_chars NOT BETWEEN 100 AND 10000"),
    _duplicates_sql("documents", "source, n_chars", _DOCUMENT_PAIRS),
    _check_sql("labels", "missing", "doc_id", "doc_id IS NULL"),
    _check_sql("labels", "missing", "quality", "quality IS NULL"),
    _check_sql("labels", "missing", "toxic", "toxic IS NULL"),
    _check_sql("labels", "format", "quality", "TRUE"),
    _check_sql("labels", "business_rule", "toxic", "toxic > 0.5"),
    _duplicates_sql("labels", "quality, toxic", _LABEL_PAIRS),
))

# Text columns of the given tables.
TEXT_COLUMNS = {
    "customer": ("c_name", "c_mktsegment"),
    "supplier": ("s_name",),
    "part": ("p_name", "p_brand", "p_type"),
    "orders": ("o_orderstatus", "o_orderpriority"),
    "lineitem": ("l_returnflag", "l_linestatus"),
    "events": ("event_type", "props"),
    "documents": ("text", "lang", "source"),
    "pages": ("url", "html"),
    "benchmark": ("text",),
    "conversations": ("role", "text"),
    "nation": ("n_name",),
    "region": ("r_name",),
}
LENGTH_LIMIT = 100


def length_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    reports = [
        text_lengths(s.read(spark, sf_dir, name), name, {column: LENGTH_LIMIT for column in columns})
        for name, columns in TEXT_COLUMNS.items()
    ]
    return reduce(DataFrame.unionByName, reports)


LENGTH_REPORT_SQL = " UNION ALL ".join(
    f"SELECT '{name}' AS \"table\", '{column}' AS \"column\", CAST(max(length({column})) AS INTEGER) AS max_length, "
    f"{LENGTH_LIMIT} AS length_limit, max(length({column})) > {LENGTH_LIMIT} AS too_long FROM {name}"
    for name, columns in TEXT_COLUMNS.items() for column in columns
)


def null_zero_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Errors lose their user in the delta; user 0 is the stage's sentinel."""
    stage = s.read(spark, sf_dir, "events")
    delta = latest(stage, ["user_id", "event_type"], "ts").withColumn(
        "user_id", F.when(F.col("event_type") != "error", F.col("user_id"))
    )
    return null_zero_counts(delta, ["user_id"], stage, ["user_id"])


NULL_ZERO_REPORT_SQL = """
    SELECT 'null_ids' AS "check", COUNT(DISTINCT user_id) AS n_rows FROM events WHERE event_type = 'error'
    UNION ALL SELECT 'zero_ids', COUNT(*) FROM events WHERE user_id = 0
"""


def unique_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_keys(s.read(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


UNIQUE_CHECK_SQL = """
    SELECT l_orderkey, l_linenumber, COUNT(*) AS n_rows FROM lineitem GROUP BY 1, 2 HAVING COUNT(*) > 1
"""

ALIGNED = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("user_id", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("load_timestamp", NTZ),
    T.StructField("valid_from", NTZ),
    T.StructField("valid_to", NTZ),
    T.StructField("is_active", T.BooleanType()),
])


def schema_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align(s.read(spark, sf_dir, "events").withColumnRenamed("ts", "valid_from"), ALIGNED)


SCHEMA_ALIGN_SQL = """
    SELECT event_id, CAST(user_id AS VARCHAR) AS user_id, value, TIMESTAMP '1970-01-01 00:00:00' AS load_timestamp,
           ts AS valid_from, CAST(NULL AS TIMESTAMP) AS valid_to, TRUE AS is_active
    FROM events
"""


def required_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that lack a required value, each under the first one missing."""
    orders = _checked(spark, sf_dir, "orders").withColumn(
        "o_orderpriority", F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority"))
    )
    reason = missing_required(["o_orderkey", "o_custkey", "o_orderpriority"])
    return orders.withColumn("reason", reason).where(F.col("reason").isNotNull()).select("o_orderkey", "reason")


REQUIRED_REJECTS_SQL = """
    SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 'null_o_custkey' ELSE 'null_o_orderpriority' END AS reason
    FROM orders WHERE o_orderstatus = 'P' OR o_orderpriority = '5-LOW'
"""

QUERIES = {
    "quality_report": (quality_report, QUALITY_REPORT_SQL),
    "length_report": (length_report, LENGTH_REPORT_SQL),
    "null_zero_report": (null_zero_report, NULL_ZERO_REPORT_SQL),
    "unique_check": (unique_check, UNIQUE_CHECK_SQL),
    "schema_align": (schema_align, SCHEMA_ALIGN_SQL),
    "required_rejects": (required_rejects, REQUIRED_REJECTS_SQL),
}
