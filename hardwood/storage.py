"""Paths on whatever file system they name."""

from __future__ import annotations

from pyspark.sql import SparkSession


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether anything is stored under ``path``, on whatever file system it names."""
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop_path)


def delete_path(spark: SparkSession, path: str) -> None:
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop_path, True)
