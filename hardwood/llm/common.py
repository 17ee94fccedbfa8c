"""Helpers shared by the operators: Arrow passes over texts, row identity, staged tables, keeping or dropping rows.

Columns that an operator adds never clash with columns a table brings along: each
operator selects the columns it needs by name and returns only its own ones.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from hardwood.session import materialize, prepare

__all__ = ["batch_pass", "fold", "fresh_name", "keep_rows", "meet", "one_each", "ready", "row_key", "staged", "table"]

#: Rows and bytes of one Arrow batch, whichever is reached first: a batch of long texts stays small in a Python worker.
BATCH_ROWS, BATCH_BYTES = 512, 1 << 25


def ready(spark: SparkSession) -> SparkSession:
    """The session with the settings the operators rely on.

    Python workers find this package where the driver found it; a cluster without that folder is given it by ``--py-files``.
    """
    prepare(spark)
    environment, root = spark.sparkContext.environment, str(Path(__file__).resolve().parents[2])
    known = environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in known:
        environment["PYTHONPATH"] = os.pathsep.join(filter(None, [root, *known]))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return ready(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def batch_pass(df: DataFrame, schema: str | StructType, make: Callable[[], Callable[[pa.RecordBatch], Iterable[pa.RecordBatch]]]) -> DataFrame:
    """``make()`` once per task gives the function that turns one Arrow batch into result batches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = make()
        for batch in batches:
            if batch.num_rows:
                yield from step(batch)

    return df.mapInArrow(run, schema)


def staged(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once below ``spark.checkpoint.dir`` and read back: survives lost executors."""
    return materialize(df, label)


def row_key() -> Column:
    """With ``doc_id``, the identity of a row: equal only for repeated rows (null ids and texts count as values)."""
    return F.xxhash64("doc_id", "text")


def fold(label: str) -> Column:
    """Integer in 0..2^32-1 of a document id, as ``crc32`` of its decimal text (a null id counts as empty text)."""
    return F.crc32(F.coalesce(F.col(label).cast("string"), F.lit("")).cast("binary"))


def keep_rows(docs: DataFrame, verdicts: DataFrame) -> DataFrame:
    """Rows of ``docs`` that ``verdicts`` (doc_id, row_key, kept) does not reject; of repeated rows one.

    Only what is rejected or repeated is joined, so that a small share is
    broadcast; texts are shuffled only if that share is large.
    """
    row, mark_id, mark_key = (fresh_name(docs, n) for n in ("mark_row", "mark_id", "mark_key"))
    marks = staged(
        verdicts.groupBy("doc_id", "row_key").agg(F.max("kept").alias("kept"), F.count("*").alias("n"))
        .filter("not kept or n > 1").select(F.col("doc_id").alias(mark_id), F.col("row_key").alias(mark_key), "kept"),
        "marks",
    )
    keyed = docs.withColumn(row, row_key())
    same = (F.col(row) == F.col(mark_key)) & F.col("doc_id").eqNullSafe(F.col(mark_id))
    single = keyed.join(marks.drop("kept"), same, "left_anti").select(docs.columns)
    if marks.filter("kept").isEmpty():
        return single
    repeated = keyed.join(marks.filter("kept").drop("kept"), same, "left_semi").dropDuplicates(["doc_id", row])
    return single.unionByName(repeated.select(docs.columns))


#: A key with more than one row in so many is hot; there are at most this many such keys, so a table of them is bounded.
HOT_SHARE = 1000


def meet(rows: DataFrame, table: DataFrame, *key: str) -> DataFrame:
    """Inner join of staged ``rows`` to a staged ``table`` that is unique on ``key`` and counts in ``n`` how often a key occurs.

    Rows of hot keys meet a broadcast of these keys (``HOT_SHARE`` at most) where they lie; the others are shuffled, and no task gets a hot key.
    """
    total = table.agg(F.sum("n")).first()[0] or 0
    hot = F.broadcast(table.filter(F.col("n") * HOT_SHARE > total))
    if hot.isEmpty():
        return rows.join(table, list(key))
    often = rows.join(hot, list(key))
    seldom = rows.join(hot.select(*key), list(key), "left_anti").join(table.filter(F.col("n") * HOT_SHARE <= total), list(key))
    return often.unionByName(seldom)


def fresh_name(df: DataFrame, name: str) -> str:
    """``name``, with as many underscores as it takes for ``df`` to have no such column."""
    while name in {c.lower() for c in df.columns}:
        name += "_"
    return name


def one_each(verdicts: DataFrame, group: str) -> DataFrame:
    """``verdicts`` with one kept row key for each value of ``group``: of several (rows that share an id), the smallest."""
    several = staged(
        verdicts.filter("kept").groupBy(F.col(group).alias("kept_group")).agg(F.min("row_key").alias("kept_key"), F.max("row_key").alias("last_key"))
        .filter("kept_key != last_key").select("kept_group", "kept_key"),
        "several",
    )
    joined = verdicts.join(several, F.col(group).eqNullSafe(F.col("kept_group")), "left")
    kept = F.col("kept") & (F.col("kept_key").isNull() | (F.col("row_key") == F.col("kept_key")))
    return joined.select("doc_id", "row_key", kept.alias("kept"))
