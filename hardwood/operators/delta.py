"""Per-key incremental extraction."""

from __future__ import annotations

from collections.abc import Collection, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hardwood.operators.latest import STAMP

INSERTED = "inserted"
UPDATED = "updated"
UNCHANGED = "unchanged"


def key_match(keys: Sequence[str], nullable: Collection[str], left: str, right: str) -> Column:
    """Join condition on ``keys``; NULL equals NULL for the nullable ones only.

    Plain equality lets the join reuse a shuffle on the same keys, so it is kept
    wherever a key cannot be NULL.
    """
    condition = F.lit(True)
    for key in keys:
        a, b = F.col(f"{left}.{key}"), F.col(f"{right}.{key}")
        condition = condition & (a.eqNullSafe(b) if key in nullable else a == b)
    return condition


def known_rows(
    candidates: DataFrame,
    target: DataFrame,
    keys: Sequence[str],
    carry: Sequence[str],
    nullable: Collection[str] = (),
) -> DataFrame:
    """The ``carry`` columns of those target rows whose key occurs in staged ``candidates``.

    A long target meets a short delta on most days. The planner knows the size
    of the staged delta: below the session's broadcast threshold the target is
    read without a shuffle, beyond it both sides are shuffled on the key, and the
    join that follows uses that partitioning again.
    """
    slim, wanted = target.select(*keys, *carry).alias("t"), candidates.select(*keys).alias("c")
    return slim.join(wanted, key_match(keys, nullable, "t", "c"), "left_semi")


def newer_than_target(
    candidates: DataFrame,
    target: DataFrame,
    keys: Sequence[str],
    stamp: str = STAMP,
    carry: Sequence[str] = (),
    nullable: Collection[str] = (),
) -> DataFrame:
    """Candidates whose key is absent from ``target`` or stored with an older stamp.

    ``candidates`` and ``target`` hold one row per key. Adds ``status`` and, for
    each carried target column, ``known_<column>``.
    """
    known = target.select(
        *keys, F.col(stamp).alias(f"known_{stamp}"), *(F.col(name).alias(f"known_{name}") for name in carry),
        F.lit(True).alias("_known"),
    )
    joined = candidates.alias("c").join(known.alias("k"), key_match(keys, nullable, "c", "k"), "left")
    return (
        joined.where(F.col("_known").isNull() | (F.col(f"c.{stamp}") > F.col(f"known_{stamp}")))
        .select(
            "c.*",
            *(F.col(f"known_{name}") for name in carry),
            F.when(F.col("_known").isNull(), INSERTED).otherwise(UPDATED).alias("status"),
        )
    )
