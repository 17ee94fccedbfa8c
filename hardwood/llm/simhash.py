"""Near-duplicate documents by 64-bit SimHash fingerprints.

Method: a byte-position inverted index with count filtering. Two fingerprints
that differ in at most four bits differ in at most four of their eight bytes, so
they share at least four bytes at the same positions. The index posts every distinct
fingerprint under positional bytes, three positions at a time: the triples of ``POSTED`` are chosen so that any
four positions contain one of them, so no pair is missed, and a posting is 2^16 times shorter than one of a
single byte. In the join of a posting with itself, the shared positional bytes
of a pair are tallied; a pair with fewer than four is dropped, as is one that a
smaller triple has met already (so each pair comes once), and the rest are verified by their differing bits.

Copies share a fingerprint and count as one entry of the index. Dense groups are joined to stars first, so that only
pairs still apart are emitted. Linked fingerprints are joined to components; each row then takes its fingerprint's component.

Defined results: a text without words (null, empty, white space) has fingerprint
zero and is linked like any other; a row with a null id is returned with the
component of its fingerprint (null if all ids of the component are null); repeated rows are all
returned; an empty table gives an empty table; other columns are ignored. Texts are never cut off.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hardwood.llm.common import batch_pass, keep_rows, one_each, row_key, staged
from hardwood.llm.components import components

SHINGLE_WORDS, BITS_APART, BYTES_SHARED = 4, 4, 4


def covering_triples() -> list[tuple[int, int, int]]:
    """Triples of the eight positions such that any four positions contain one.

    The positions fall into a ring of three groups (3, 3 and 2). A triple counts if it lies in one
    group, or has two in a group and one in the next: any four positions have either.
    """
    group = [0, 0, 0, 1, 1, 1, 2, 2]

    def counts(triple: tuple[int, int, int]) -> bool:
        size = [sum(group[p] == g for p in triple) for g in range(3)]
        return 3 in size or any(size[g] == 2 and size[(g + 1) % 3] == 1 for g in range(3))

    return [t for t in combinations(range(8), 3) if counts(t)]


POSTED = covering_triples()


def fingerprint(text: str | None, words: int = SHINGLE_WORDS) -> int:
    """Bit i is 1 if over half of the shingles' XXH64 values have it; no words: 0."""
    import xxhash

    found = (text or "").encode().lower().split()  # splits at 0x20 and 0x09-0x0D alone
    if not found:
        return 0
    joined, ends = b" ".join(found), (np.cumsum([len(w) + 1 for w in found]) - 1).tolist()
    starts = [0, *(e + 1 for e in ends)]
    spans = zip(starts, ends[words - 1 :]) if len(found) >= words else [(0, len(joined))]
    digest = xxhash.xxh64_intdigest
    ones, n, block = np.zeros(64, np.int64), 0, []
    for a, b in spans:
        block.append(digest(joined[a:b], 42))
        if len(block) == 65536:
            ones, n, block = ones + _ones(block), n + len(block), []
    ones, n = ones + _ones(block), n + len(block)
    return int(np.packbits(ones * 2 > n, bitorder="little").view("<u8")[0])


def _ones(values: list[int]) -> np.ndarray:
    """How many of the values have each bit."""
    if not values:
        return np.zeros(64, np.int64)
    return np.unpackbits(np.array(values, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)


def _fingerprints():
    def step(batch: pa.RecordBatch):
        found = np.array([fingerprint(t) for t in batch.column(2).to_pylist()], "<u8").view("<i8")
        yield pa.record_batch([batch.column(0), batch.column(1), pa.array(found)], ["doc_id", "row_key", "fp"])

    return step


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, row_key and fp (the fingerprint's bits as a signed long) of every row."""
    return batch_pass(docs.select("doc_id", row_key().alias("row_key"), "text"), "doc_id long, row_key long, fp long", _fingerprints)


def _byte(fp: Column, position: int) -> Column:
    return F.shiftrightunsigned(fp, 8 * position).bitwiseAND(F.lit(255))


def postings(distinct: DataFrame) -> DataFrame:
    """The index: fp and posting (a triple's number, then its three bytes) of every distinct fingerprint."""

    def posting(index: int, triple: tuple[int, int, int]) -> Column:
        return reduce(lambda key, p: F.shiftleft(key, 8).bitwiseOR(_byte(F.col("fp"), p)), triple, F.lit(index).cast("long"))

    return distinct.select("fp", F.explode(F.array(*[posting(i, t) for i, t in enumerate(POSTED)])).alias("posting"))


def _near(a: str, b: str, posting: str) -> Column:
    """Counting, then verification: the pair shares enough positional bytes, differs in few bits, and has not met in a smaller triple."""
    apart = F.col(a).bitwiseXOR(F.col(b))
    equal = [_byte(apart, p) == 0 for p in range(8)]
    shared = reduce(lambda x, y: x + y, [e.cast("int") for e in equal])
    first = reduce(
        lambda rest, it: F.when(equal[it[1][0]] & equal[it[1][1]] & equal[it[1][2]], F.lit(it[0])).otherwise(rest),
        reversed(list(enumerate(POSTED))), F.lit(-1),
    )
    return (shared >= BYTES_SHARED) & (F.bit_count(apart) <= BITS_APART) & (first == F.shiftright(F.col(posting), 24))


def links(index: DataFrame) -> DataFrame:
    """All pairs a < b of the index's fingerprints that differ in at most four bits, each once.

    With a column ``root``, only pairs of different roots, and only postings that hold several are read.
    """
    unlike = F.lit(True)
    if "root" in index.columns:
        mixed = index.groupBy("posting").agg(F.min("root").alias("low"), F.max("root").alias("high")).filter("low != high")
        index = index.join(mixed.select("posting"), "posting", "left_semi")
        unlike = F.col("a.root") != F.col("b.root")
    a, b = index.alias("a"), index.alias("b")
    found = (F.col("a.posting") == F.col("b.posting")) & (F.col("a.fp") < F.col("b.fp")) & unlike & _near("a.fp", "b.fp", "a.posting")
    return a.join(b, found).select(F.col("a.fp").alias("a"), F.col("b.fp").alias("b"))


def star_links(index: DataFrame) -> DataFrame:
    """Links of each posting's fingerprints to its smallest one, where they are near: at most one per entry."""
    centers = index.groupBy("posting").agg(F.min("fp").alias("center"))
    near = (F.col("fp") != F.col("center")) & (F.bit_count(F.col("fp").bitwiseXOR(F.col("center"))) <= BITS_APART)
    return index.join(centers, "posting").filter(near).select(F.col("fp").alias("a"), F.col("center").alias("b")).distinct()


def roots_of(distinct: DataFrame) -> DataFrame:
    """node and root of every linked fingerprint of ``distinct``.

    A dense group of near copies would give links by the square of its size. So postings are first joined to
    stars, and only what is still apart then meets pair by pair; the components are those of all links.
    """
    index = postings(distinct)
    stars = staged(components(star_links(index)), "stars")
    rooted = index.join(stars, F.col("fp") == F.col("node"), "left").select("fp", "posting", F.coalesce("root", "fp").alias("root"))
    return components(links(rooted).unionByName(stars.select(F.col("node").alias("a"), F.col("root").alias("b"))))


def near_groups(docs: DataFrame) -> DataFrame:
    """doc_id, row_key, root (a fingerprint, one per component), fingerprint (16 hex digits) and component_id of every row of ``docs``."""
    rows = staged(fingerprints(docs), "fingerprints")
    classes = staged(rows.groupBy("fp").agg(F.min("doc_id").alias("low_id"), F.count("*").alias("n")), "classes")
    roots = roots_of(classes.select("fp"))
    rooted = classes.join(roots, classes.fp == roots.node, "left").select("fp", "low_id", "n", F.coalesce("root", "fp").alias("root"))
    low = rooted.groupBy("root").agg(F.min("low_id").alias("component_id"), F.sum("n").alias("n"))
    # Fingerprints of one row alone need no lookup.
    found = staged(rooted.select("fp", "root").join(low.filter("n > 1"), "root").select("fp", "component_id", F.col("root").alias("met")), "components")
    return rows.join(found, "fp", "left").select(
        "doc_id", "row_key", F.coalesce("met", "fp").alias("root"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.when(F.col("met").isNotNull(), F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
    )


def without_near_copies(docs: DataFrame) -> DataFrame:
    """One row of ``docs``, all columns, of each component: the smallest id."""
    groups = staged(near_groups(docs), "near_groups")
    kept = groups.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
    return keep_rows(docs, one_each(kept, "root"))
