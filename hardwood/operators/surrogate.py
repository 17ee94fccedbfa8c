"""Dense surrogate ids without a single-partition window."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hardwood.session import materialize

# monotonically_increasing_id() keeps the row position in its lower 33 bits.
_POSITION_BITS = 33


def assign_ids(
    rows: DataFrame, natural_key: Sequence[str], id_column: str, after: int = 0, known: str | None = None
) -> DataFrame:
    """Add ids ``after + 1, after + 2, ...`` in natural-key order.

    Rows whose ``known`` column holds an id keep it and come last, so the new ids
    have no gaps. Rows are range-partitioned and sorted on their unique natural
    key, and written once with their partition number and position. One count
    per partition then reaches the driver, and every id follows from plain
    arithmetic. The result reads the written rows, so it also serves as the
    staged copy of ``rows``.
    """
    order = [F.col(name) for name in natural_key]
    if known is not None:
        order.insert(0, F.col(known).isNotNull())
    ordered = (
        rows.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_position", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << _POSITION_BITS) - 1)))
    )
    staged = materialize(ordered, f"ids-{id_column}")
    sizes = dict(staged.groupBy("_part").agg(F.max("_position") + 1).collect())
    starts = accumulate((sizes.get(part, 0) for part in range(max(sizes, default=0))), initial=after)
    # One number per written partition, as a constant: looking it up needs no join, and
    # the planner goes on seeing the true size of the staged rows.
    start = F.split(F.lit(",".join(map(str, starts))), ",")[F.col("_part")].cast("bigint")
    fresh = start + F.col("_position") + 1
    value = fresh if known is None else F.coalesce(F.col(known), fresh)
    return staged.select(value.alias(id_column), *(name for name in rows.columns if name != known))
