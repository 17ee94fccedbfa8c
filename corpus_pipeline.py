"""From raw documents to token ids: toxic documents go, copies and near copies go, languages are mixed, texts are encoded.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hardwood.llm import exact_dedup, mixing, pieces, simhash, toxicity
from hardwood.llm.common import ready, table
from hardwood.llm.queries import LEAST_COPIES, MIX_WEIGHTS, domains, learnable, tokenizer_file
from hardwood.session import scratch_path, scratch_run
from hardwood.sources.stage import delete_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below 0.5 for toxicity."""
    return toxicity.without_toxic(docs, learnable(table(spark, sf_dir, "labels"), "toxic", 5, 0))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest id."""
    ready(spark)
    return exact_dedup.without_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of linked fingerprints the document with the smallest id."""
    ready(spark)
    return simhash.without_near_copies(docs)


def mix_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated until the languages' expected tokens have the target weights."""
    ready(spark)
    return mixing.mixed(docs, domains(docs), MIX_WEIGHTS, LEAST_COPIES)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids and round_trip of each document."""
    ready(spark)
    return pieces.encode_documents(docs, tokenizer_file()).select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", "round_trip")


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("simhash_near_dedup", drop_near_copies),
    ("mixing", mix_languages),
    ("sentencepiece", encode),
]

#: The classifiers and the fingerprints have no SQL; tests/llm/test_pipeline.py checks the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage returns is written and read again before the next.

    Once a stage's rows are written, what it staged on the way is deleted, and so are the rows of the stage before.
    """
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, name)
        with scratch_run(lambda p: delete_path(spark, p)):
            stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.schema(docs.schema).parquet(path)
        if before:
            delete_path(spark, before)
        before = path
    return STAGES[-1][1](spark, docs, sf_dir)
