"""Writing merged tables back to parquet."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hardwood.operators.buckets import BUCKET, bucket_of, folder, in_partitions
from hardwood.operators.constraints import check_unique
from hardwood.operators.delta import INSERTED, UPDATED
from hardwood.operators.upsert import without_keys
from hardwood.session import materialize
from hardwood.storage import delete_path, path_exists


def overwrite_partitions(df: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """Replace exactly the partitions ``df`` has rows for; ``df`` may read the same path.

    Rebalancing splits a partition that holds most of the rows over several
    tasks and files, and gathers small ones.
    """
    constant = list(partition_by) in (["slice"], ["run"])
    (
        (df.hint("rebalance") if constant else df.hint("rebalance", *partition_by))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by)
        .parquet(path)
    )


def _pending(path: str) -> str:
    return f"{path.rstrip('/')}__pending"


def commit(df: DataFrame, path: str, partition_by: Sequence[str], emptied: Sequence[str] = ()) -> None:
    """Exchange the partitions ``df`` has rows for, and drop the ``emptied`` ones (``column=value``), all or none.

    The new partitions are first written whole beside the table and marked ready.
    A run that dies before the mark has changed nothing; one that dies after it
    is completed by ``finish_pending``, which every load calls before it reads.
    Exchanging the same partitions twice gives the same table.
    """
    spark, pending = df.sparkSession, _pending(path)
    delete_path(spark, pending)
    df.write.parquet(f"{pending}/rows")
    spark.createDataFrame([(name,) for name in emptied], "name string").coalesce(1).write.parquet(f"{pending}/emptied")
    spark.createDataFrame([(name,) for name in partition_by], "name string").coalesce(1).write.parquet(f"{pending}/ready")
    finish_pending(spark, path)


def finish_pending(spark: SparkSession, path: str) -> bool:
    """Complete an exchange that an earlier run marked ready, or clear one it did not. True if rows were exchanged."""
    pending = _pending(path)
    ready = path_exists(spark, f"{pending}/ready/_SUCCESS")
    if ready:
        partition_by = [row.name for row in spark.read.parquet(f"{pending}/ready").collect()]
        overwrite_partitions(spark.read.parquet(f"{pending}/rows"), path, partition_by)
        for row in spark.read.schema("name string").parquet(f"{pending}/emptied").collect():
            delete_path(spark, f"{path}/{row.name}")
    # The mark goes first: where a folder is not deleted at once, a stop in between must not leave a mark without rows.
    for left in (f"{pending}/ready", pending):
        if path_exists(spark, left):
            delete_path(spark, left)
    return ready


def replace_whole(df: DataFrame, path: str, key: Sequence[str], name: str) -> None:
    """Replace a table, as one constant partition, that ``df`` itself may have read.

    Unlike a plain overwrite this keeps the old rows, and with them the ids that
    facts refer to, until the new ones are complete.
    """
    check_unique(df, key, name)
    commit(df.withColumn("slice", F.lit("all")), path, ["slice"])


def refresh_unless_empty(df: DataFrame, path: str, key: Sequence[str], name: str) -> int:
    """Full refresh of a mart; an empty result leaves the old rows in place. Returns the number of rows written.

    The rows are written beside the old ones, counted and checked there, and then exchanged.
    """
    spark = df.sparkSession
    finish_pending(spark, path)
    staged = materialize(df, name)
    rows = staged.count()
    if rows:
        replace_whole(staged, path, key, name)
    return rows


def refresh_partitions(df: DataFrame, path: str, key: Sequence[str], name: str, partition: str, values: Sequence | None) -> int:
    """Refresh the ``values`` of a mart's partition column, or all of it (None), from ``df``, which holds their rows alone.

    Gives what a full refresh would: partitions that no longer have rows are dropped, but a mart that would lose its last row
    stays as it is. Returns the number of rows written. The partitions are exchanged all or none.
    """
    spark = df.sparkSession
    finish_pending(spark, path)
    staged = materialize(df, name)
    filled = {row[0]: row[1] for row in staged.groupBy(partition).count().collect()}
    unsliced = path_exists(spark, f"{path}/slice=all")  # as ``refresh_unless_empty`` would have left it
    stored: set = set()
    if path_exists(spark, path) and not unsliced:
        stored = {row[0] for row in spark.read.schema(df.select(partition).schema).parquet(path).distinct().collect()}
    replaced = stored if values is None else stored & set(values)
    if not filled and not stored - replaced:
        return 0
    check_unique(staged, key, name)
    gone = [folder([partition], [value]) for value in sorted(replaced - set(filled))]
    commit(staged, path, [partition], [*gone, *(["slice=all"] if unsliced else [])])
    return sum(filled.values())


def publish_changes(
    target: DataFrame, changes: DataFrame, path: str, partition: str, key: Sequence[str], nullable: Sequence[str], buckets: int | None = None
) -> None:
    """Merge staged ``changes`` into a partitioned table, touching only the partitions they name.

    With ``buckets`` a partition falls into that many key-hash buckets (``target`` then has the column ``bucket``), and only buckets
    that hold a changed row are rewritten. Corrections come first: the old and the new place of each changed row are exchanged together, all or
    none, since a correction may move a row; a place that loses its last row is dropped, which a dynamic overwrite
    would not do. Then new keys are appended. A run that dies between the two has stored whole corrections, and the next load finds the rest.

    ``changes`` are checked to be unique, and so are the rewritten places: new keys are absent from the target by ``status``.
    """
    levels = [partition, BUCKET] if buckets else [partition]
    columns = [name for name in target.columns if name != BUCKET]
    if buckets:
        changes = changes.withColumn(BUCKET, bucket_of(target.schema, key, buckets))
    check_unique(changes, key, path)
    updated = changes.where(F.col("status") == UPDATED)
    moves = updated.select(partition, f"known_{partition}", *levels[1:]).distinct().collect()
    if moves:
        touched = {(row[0], *row[2:]) for row in moves} | {(row[1], *row[2:]) for row in moves if row[1] is not None}
        kept = without_keys(target.where(in_partitions(levels, touched)), updated, key, nullable)
        rows = materialize(kept.select(*columns, *levels[1:]).unionByName(updated.select(*columns, *levels[1:])), "touched")
        check_unique(rows, key, path)
        filled = {tuple(row) for row in rows.select(*levels).distinct().collect()}
        commit(rows, path, levels, [folder(levels, values) for values in sorted(touched - filled)])
    fresh = changes.where(F.col("status") == INSERTED).select(*columns, *levels[1:])
    if not fresh.isEmpty():
        fresh.hint("rebalance", *levels).write.mode("append").partitionBy(*levels).parquet(path)
