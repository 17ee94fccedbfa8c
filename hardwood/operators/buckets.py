"""Key-hash buckets: the partition level below the season, so that a correction rewrites a share of a season."""

from __future__ import annotations

from collections.abc import Collection, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BUCKET = "bucket"


def bucket_of(schema: T.StructType, key: Sequence[str], buckets: int) -> Column:
    """Bucket of a row by its key alone, in the types of ``schema``: a row that moves to another season keeps its bucket."""
    return F.pmod(F.xxhash64(*(F.col(name).cast(schema[name].dataType) for name in key)), F.lit(buckets)).cast("int")


def touched_buckets(rows: DataFrame, schema: T.StructType, key: Sequence[str], buckets: int) -> list[int]:
    """Buckets that staged ``rows`` fall into; at most ``buckets`` numbers."""
    return sorted(row[0] for row in rows.select(bucket_of(schema, key, buckets)).distinct().collect())


def in_partitions(levels: Sequence[str], touched: Collection[tuple]) -> Column:
    """Rows of the ``touched`` partitions, as a condition on partition columns alone, so that no other folder is listed or read.

    ``touched`` holds the values of one or two levels. Buckets are grouped by season: one term per season.
    """
    if len(levels) == 1:
        return F.col(levels[0]).isin(*(values[0] for values in touched))
    by_first: dict = {}
    for first, second in touched:
        by_first.setdefault(first, set()).add(second)
    condition = F.lit(False)
    for first in sorted(by_first):
        condition = condition | ((F.col(levels[0]) == first) & F.col(levels[1]).isin(*sorted(by_first[first])))
    return condition


def folder(levels: Sequence[str], values: Sequence) -> str:
    """Path of one partition below its table."""
    return "/".join(f"{level}={value}" for level, value in zip(levels, values))
