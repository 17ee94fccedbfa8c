"""Session settings and the shared work folder."""

from __future__ import annotations

import contextvars
import tempfile
import uuid
from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from typing import TypeVar

from pyspark.sql import DataFrame, SparkSession

RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Joins followed by unionByName over several merge rounds fail to zip
    # partitions on 4.1 when unions try to keep their children's partitioning.
    "spark.sql.unionOutputPartitioning": "false",
}


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings every job here relies on to a given session."""
    for name, value in RUNTIME_SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def local_session(cores: str = "*", partitions: int = 8) -> SparkSession:
    """A single-machine session for tests and benchmarks."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("hardwood")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        # Recording the Python call site of every column call triples the time to build a plan.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return prepare(spark)


def shared_dir(spark: SparkSession) -> str:
    """Folder that every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local master, as in tests, may do without it: on a cluster a temporary
    folder would exist on one machine alone, and leaving the setting out is an error.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="hardwood-"))
    return context.getCheckpointDir()


_opened: contextvars.ContextVar[list[str] | None] = contextvars.ContextVar("opened", default=None)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder; deleted at the end of the ``scratch_run`` it is asked for in."""
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    if (opened := _opened.get()) is not None:
        opened.append(path)
    return path


@contextmanager
def scratch_run(delete: Callable[[str], None]) -> Iterator[None]:
    """Delete what was staged inside, at the end, when its consumers have committed."""
    opened: list[str] = []
    token = _opened.set(opened)
    try:
        yield
    finally:
        _opened.reset(token)
        for path in opened:
            delete(path)


Result = TypeVar("Result")


def together(*jobs: Callable[[], Result]) -> list[Result]:
    """Independent Spark jobs submitted from threads of one session; their results in order."""
    with ThreadPoolExecutor(max_workers=max(1, len(jobs))) as pool:
        running = [pool.submit(contextvars.copy_context().run, job) for job in jobs]
        return [job.result() for job in running]


def materialize(df: DataFrame, label: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Write ``df`` once below the shared folder and return it read back.

    Cuts lineage the way a checkpoint does, survives lost executors, and gives
    the planner true file sizes for the joins that follow.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.partitionBy(*partition_by).parquet(path)
    return spark.read.schema(df.schema).parquet(path).select(df.columns)
