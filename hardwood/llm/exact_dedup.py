"""Exact deduplication of documents by content-defined chunk recipes.

Method: one pass over the texts lower-cases A-Z, cuts the UTF-8 bytes where a
hash of the last eight bytes says so (so equal passages give equal chunks wherever they lie), and
returns per chunk a 64-bit name and a 128-bit proof (from SHA-256). Names are verified over the
whole corpus: a name that stands for more than one proof is replaced by name and
proof together. A document's recipe is the ordered list of its verified
identifiers; documents with equal recipes are equal. Texts are read once and never shuffled.

Defined results: a null text counts as empty, and all empty texts form one
group; null ids are smallest (a group of null ids alone keeps null); repeated rows count as members and are
all returned, each with its group's result; an empty table gives an empty table;
other columns are ignored. Texts are never cut off.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hardwood.llm.common import batch_pass, keep_rows, one_each, row_key, staged

#: Chunk sizes in bytes: none is shorter (but the last), the mean of what is added to that, none is longer.
LEAST, MEAN, MOST = 1024, 4096, 65536
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def chunk_ends(data: bytes, least: int = LEAST, mean: int = MEAN, most: int = MOST) -> list[int]:
    """Ends of the chunks of ``data``; the last one is its length. Empty data have no chunk."""
    if not data:
        return []
    n, ends, start = len(data), [], 0
    if n > least + 8:
        raw = np.frombuffer(data, np.uint8)
        windows = np.lib.stride_tricks.sliding_window_view(raw, 8)
        # The hash of a window decides about the place behind it.
        words = np.ascontiguousarray(windows).view("<u8").ravel()
        marks = (np.flatnonzero((words * _MULTIPLIER) >> np.uint64(40) < np.uint64((1 << 24) // mean)) + 8).tolist()
        for mark in [*marks, n]:
            while mark - start > most:
                start += most
                ends.append(start)
            if mark - start >= least and mark < n:
                ends.append(mark)
                start = mark
    if start < n:
        ends.append(n)
    return ends


def _recipes() -> object:
    def step(batch: pa.RecordBatch):
        digests, names, proofs = [], [], []
        for text in batch.column(2).to_pylist():
            data = (text or "").encode().lower()  # bytes.lower() changes A-Z alone
            digests.append(hashlib.sha256(data).hexdigest())
            ends = chunk_ends(data)
            found = [hashlib.sha256(data[a:b]).digest() for a, b in zip([0, *ends], ends)]
            names.append([int.from_bytes(d[:8], "little", signed=True) for d in found])
            proofs.append([d[8:24] for d in found])
        yield pa.record_batch(
            [batch.column(0), batch.column(1), pa.array(digests), pa.array(names, pa.list_(pa.int64())), pa.array(proofs, pa.list_(pa.binary()))],
            ["doc_id", "row_key", "text_sha256", "names", "proofs"],
        )

    return step


def recipes(docs: DataFrame) -> DataFrame:
    """doc_id, row_key, text_sha256 and recipe, the ordered verified chunk identifiers, per row (one pass over texts)."""
    schema = "doc_id long, row_key long, text_sha256 string, names array<long>, proofs array<binary>"
    chunked = staged(batch_pass(docs.select("doc_id", row_key().alias("row_key"), "text"), schema, _recipes), "chunks")
    pieces = chunked.select(F.explode(F.arrays_zip("names", "proofs")).alias("c")).select(
        F.col("c.names").alias("name"), F.expr("xxhash64(c.proofs)").alias("proof_hash"), F.hash("c.proofs").alias("proof_hash2")
    )
    # Folded before the shuffle: a chunk that a third of all documents share is one row per task.
    doubtful = pieces.groupBy("name").agg(
        (F.min("proof_hash") != F.max("proof_hash")).alias("a"), (F.min("proof_hash2") != F.max("proof_hash2")).alias("b")
    ).filter("a or b").select("name")
    doubtful = staged(doubtful, "doubtful")
    whole = chunked.withColumn("recipe", F.transform("names", lambda x: x.cast("string")))
    if not doubtful.isEmpty():
        # Rows with a doubtful name carry the proofs of all their chunks; no other row can equal them.
        held = chunked.select("doc_id", "row_key", F.explode("names").alias("name")).join(doubtful, "name", "left_semi")
        held = held.select(F.col("doc_id").alias("h_id"), F.col("row_key").alias("h_key")).distinct().withColumn("held", F.lit(True))
        whole = chunked.join(held, chunked.doc_id.eqNullSafe(held.h_id) & (chunked.row_key == held.h_key), "left").withColumn(
            "recipe", F.transform("names", lambda x, i: F.when(F.col("held"), F.concat(x.cast("string"), F.lit(":"), F.hex(F.get("proofs", i)))).otherwise(x.cast("string")))
        )
    return whole.select("doc_id", "row_key", "text_sha256", F.array_join("recipe", ",").alias("recipe"))


def exact_groups(docs: DataFrame) -> DataFrame:
    """doc_id, row_key, keep_id, group_size, kept and text_sha256 per row of ``docs``; of equal texts the largest id stays."""
    rows = recipes(docs)
    # Only groups of two and more meet their rows again; a row that meets none is alone.
    groups = rows.groupBy("recipe").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size")).filter("group_size > 1")
    joined = rows.join(staged(groups, "groups"), "recipe", "left")
    alone = F.col("group_size").isNull()
    keep_id = F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id"))
    return joined.select(
        "doc_id", "row_key", keep_id.alias("keep_id"), F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        F.col("doc_id").eqNullSafe(keep_id).alias("kept"), "text_sha256",
    )


def without_copies(docs: DataFrame) -> DataFrame:
    """One row of ``docs``, all columns, of each group of equal texts: the largest id."""
    groups = staged(exact_groups(docs), "exact_groups")
    return keep_rows(docs, one_each(groups, "text_sha256"))
