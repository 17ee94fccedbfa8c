"""Type-2 history: close the running version, open the next."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hardwood.functions.cleaning import any_distinct
from hardwood.operators.delta import INSERTED, UNCHANGED, UPDATED
from hardwood.operators.latest import STAMP

VALIDITY = ("valid_from", "valid_to", "is_active")


@dataclass(frozen=True)
class HistoryStep:
    """The three row sets one delta produces."""

    closed: DataFrame
    opened: DataFrame
    untouched: DataFrame


def classify(active: DataFrame, delta: DataFrame, keys: Sequence[str], attributes: Sequence[str],
             stamp: str = STAMP) -> DataFrame:
    """Delta rows with ``status``: inserted, updated or unchanged. Rows not newer than the active version drop out."""
    running = active.select(
        *keys, *(F.col(name).alias(f"known_{name}") for name in (*attributes, stamp)), F.lit(True).alias("_known")
    )
    differs = any_distinct([(F.col(name), F.col(f"known_{name}")) for name in attributes])
    status = F.when(F.col("_known").isNull(), INSERTED).when(differs, UPDATED).otherwise(UNCHANGED)
    return (
        delta.join(running, list(keys), "left")
        .where(F.col("_known").isNull() | (F.col(stamp) > F.col(f"known_{stamp}")))
        .select(*keys, *attributes, stamp, status.alias("status"))
    )


def advance(active: DataFrame, classified: DataFrame, keys: Sequence[str], attributes: Sequence[str],
            stamp: str = STAMP) -> HistoryStep:
    """Apply classified rows to the active slice.

    Every key has exactly one active version, so closed history is neither read
    nor rewritten. ``opened`` rows carry no surrogate id yet.
    """
    switch = classified.where(F.col("status") == UPDATED).select(*keys, F.col(stamp).alias("_closes"))
    closed = active.join(switch, list(keys)).select(
        *(c for c in active.columns if c not in ("valid_to", "is_active")),
        F.col("_closes").alias("valid_to"),
        F.lit(False).alias("is_active"),
    ).select(active.columns)
    opened = classified.where(F.col("status") != UNCHANGED).select(
        *keys, *attributes, stamp,
        F.col(stamp).alias("valid_from"),
        F.lit(None).cast(active.schema["valid_to"].dataType).alias("valid_to"),
        F.lit(True).alias("is_active"),
    )
    untouched = active.join(switch, list(keys), "left_anti")
    return HistoryStep(closed, opened, untouched.select(active.columns))


def history_of(batches: DataFrame, keys: Sequence[str], attributes: Sequence[str], stamp: str = STAMP) -> DataFrame:
    """The history that merging a backlog of batches one after another would give, in one plan.

    ``batches`` holds one row per key and batch. A row opens a version where an
    attribute differs from the key's row before; the version closes when the next one opens. Rows of a key meet in one
    task: as many as there are batches, whatever the number of source rows.
    """
    by_key = Window.partitionBy(*keys).orderBy(stamp)
    first = F.lag(F.lit(True)).over(by_key).isNull()
    differs = any_distinct([(F.col(name), F.lag(name).over(by_key)) for name in attributes])
    opened = batches.withColumn("_opens", first | differs).where("_opens")
    closes = F.lead(stamp).over(by_key)
    return opened.select(
        *keys, *attributes, F.col(stamp).alias("valid_from"), closes.alias("valid_to"), closes.isNull().alias("is_active")
    )
