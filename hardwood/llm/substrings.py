"""Substring deduplication: words in windows that also start in an earlier document are removed.

Method: a sparse de Bruijn graph of the corpus's words, compacted by Spark joins.

1. Edges are runs of ``EDGE`` words. One pass over the texts selects, in every window, the edges of the least hash, so
   that equal windows select equal edges wherever they lie, and about one edge in eighteen is kept. Between neighbouring selected
   edges of a text (and its beginning and end) lies a link: the hash of all words from one to the other.
2. Edges that occur under one id alone are dropped by an aggregate; no repeated window holds such an edge.
3. A repeated edge branches backwards if its occurrences have different links before it, and forwards likewise. Links between edges that
   do not branch compact to paths: every occurrence of a path has the same words from end to end, so one record stands for
   all windows inside. Windows across a branch (at most a few around each) get a record each.
4. Records carry source coordinates (document, first word, number of words) and 128 bits of SHA-256 of the bytes there.
   Records are equal only if these agree; the smallest id among equal ones decides.

Hashes of 64 bits only propose: a false repeated edge costs time, and equal links need equal edges and equal link hashes (128 bits).

Defined results: a null, empty or white text has no words; its ``kept_sha256`` is that of the empty text. Rows with one id don't remove
words from each other; a row with a null id has no place in the order: it keeps its words and removes none.
Repeated rows are all returned, with equal results; an empty table gives an empty table; other columns are
ignored. Texts are never cut off.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hardwood.llm.common import batch_pass, meet, row_key, staged

WINDOW, EDGE = 50, 16
#: Words whose hashes a worker remembers at once.
REMEMBERED = 200_000
_BASE = 0x9E3779B97F4A7C15
#: Records of one result batch.
_OUT = 20_000


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) >= REMEMBERED:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word, 11)
        return value


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return (x ^ (x >> np.uint64(29))) * np.uint64(0xD6E8FEB86659FD93)


def _slide(op: np.ufunc, x: np.ndarray, width: int) -> np.ndarray:
    """``op`` over every ``width`` neighbours of ``x``."""
    size = 1
    while size * 2 <= width:
        x, size = op(x[:-size], x[size:]), size * 2
    return op(x[: len(x) - (width - size)], x[width - size :]) if size < width else x


class Words:
    """The words of one text with hashes of any run of them, and the selected edges."""

    def __init__(self, text: str | None, memory: _WordHashes, window: int = WINDOW, edge: int = EDGE):
        self.words = (text or "").encode().split()  # splits at 0x20 and 0x09-0x0D alone
        self.window, self.edge, n = window, edge, len(self.words)
        self.selected = np.zeros(0, np.int64)
        if n < window:
            return
        hashes = np.fromiter(map(memory.__getitem__, self.words), np.uint64, n)
        self._undo = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n, pow(_BASE, -1, 1 << 64), np.uint64)]), dtype=np.uint64)
        powers = np.cumprod(np.full(n, _BASE, np.uint64), dtype=np.uint64)
        self._sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes * powers, dtype=np.uint64)])
        starts = np.arange(n - edge + 1)
        self.hashes = _mixed(self.run(starts, starts + edge)) | np.uint64(1)
        width = window - edge + 1
        #: Hash of the edge that each window selects.
        self.least = _slide(np.minimum, self.hashes, width)
        border = np.zeros(width - 1, np.uint64)
        self.selected = np.flatnonzero(_slide(np.maximum, np.concatenate([border, self.least, border]), width) == self.hashes)

    def run(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """A hash of the words from ``start`` up to ``end``, the same wherever they lie."""
        return (self._sums[end] - self._sums[start]) * self._undo[start]

    def links(self) -> np.ndarray:
        """Hashes of the links before, between and behind the selected edges."""
        n, at = len(self.words), self.selected
        start, end = np.concatenate([[0], at]), np.concatenate([at + self.edge, [n]])
        links = _mixed(self.run(start, end) + (end - start).astype(np.uint64) * np.uint64(_BASE))
        links[0], links[-1] = links[0] ^ np.uint64(0x5BD1E995), links[-1] ^ np.uint64(0x1B873593)
        return links

    def digest(self, start: int, end: int) -> bytes:
        return hashlib.sha256(b" ".join(self.words[start:end])).digest()[:16]


def paths(words: Words, flags: dict[int, tuple[bool, bool]]) -> list[tuple[int, int]]:
    """First and last + 1 word of the compacted paths of a text. ``flags`` says of a repeated edge whether it goes on alone backwards and forwards."""
    found, last = [], len(words.selected) - 1
    edges = words.hashes[words.selected].view(np.int64).tolist()
    at = words.selected.tolist()
    open_at: int | None = None
    for k, edge in enumerate(edges):
        if edge not in flags:
            open_at = None
            continue
        before, behind = flags[edge]
        joined = before and (k == 0 or (edges[k - 1] in flags and flags[edges[k - 1]][1]))
        if not joined or k == 0:
            open_at = 0 if joined else at[k]
        goes_on = behind and k < last and edges[k + 1] in flags and flags[edges[k + 1]][0]
        if not goes_on:
            found.append((open_at, len(words.words) if behind and k == last else at[k] + words.edge))
    return found


def _records(words: Words, flags: dict[int, tuple[bool, bool]]) -> Iterator[tuple[int, int, bytes]]:
    """Start, number of words and digest of each path, and of each window that holds a repeated edge and lies in no path."""
    inside = np.zeros(len(words.least), bool)
    for start, end in paths(words, flags):
        if end - start >= words.window:
            inside[start : end - words.window + 1] = True
            yield start, end - start, words.digest(start, end)
    wanted = np.isin(words.least.view(np.int64), np.fromiter(flags, np.int64, len(flags))) & ~inside
    for start in np.flatnonzero(wanted).tolist():
        yield start, words.window, words.digest(start, start + words.window)


def _graph_pass():
    memory = _WordHashes()

    def step(batch: pa.RecordBatch):
        counts, digests, edges, links = [], [], [], []
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
            words = Words(text, memory)
            counts.append(len(words.words))
            digests.append(hashlib.sha256(b" ".join(words.words)).hexdigest())
            some = doc_id is not None and len(words.selected) > 0
            edges.append(words.hashes[words.selected].view(np.int64) if some else [])
            links.append(words.links().view(np.int64) if some else [])
        yield pa.record_batch(
            [batch.column(0), batch.column(1), pa.array(counts, pa.int64()), pa.array(digests), pa.array(edges, pa.list_(pa.int64())), pa.array(links, pa.list_(pa.int64()))],
            ["doc_id", "row_key", "n_words", "words_sha256", "edges", "links"],
        )

    return step


def _record_pass():
    memory = _WordHashes()

    def step(batch: pa.RecordBatch):
        out: list[list] = [[], [], [], [], [], []]
        for doc_id, key, text, flags in zip(*(batch.column(k).to_pylist() for k in range(4))):
            given = {f["edge"]: (f["alone_before"], f["alone_behind"]) for f in flags}
            for start, length, digest in _records(Words(text, memory), given):
                row = doc_id, key, start, length, int.from_bytes(digest[:8], "little", signed=True), int.from_bytes(digest[8:], "little", signed=True)
                for column, value in zip(out, row):
                    column.append(value)
                if len(out[0]) >= _OUT:
                    yield _as_batch(out)
                    out = [[], [], [], [], [], []]
        if out[0]:
            yield _as_batch(out)

    return step


def _as_batch(columns: list[list]) -> pa.RecordBatch:
    return pa.record_batch([pa.array(c, pa.int64()) for c in columns], ["doc_id", "row_key", "start", "length", "name", "proof"])


def _cut_pass():
    def step(batch: pa.RecordBatch):
        removed, digests = [], []
        for text, spans in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
            words = (text or "").encode().split()
            steps = np.zeros(len(words) + 1, np.int64)
            for s in spans:
                steps[s["start"]] += 1
                steps[s["start"] + s["length"]] -= 1
            kept = np.cumsum(steps[:-1]) == 0
            removed.append(len(words) - int(kept.sum()))
            digests.append(hashlib.sha256(b" ".join(w for w, k in zip(words, kept.tolist()) if k)).hexdigest())
        yield pa.record_batch([batch.column(0), batch.column(1), pa.array(removed, pa.int64()), pa.array(digests)], ["doc_id", "row_key", "n_removed", "kept_sha256"])

    return step


def graph(docs: DataFrame) -> DataFrame:
    """doc_id, row_key, n_words, words_sha256, edges and links of every row, staged."""
    schema = "doc_id long, row_key long, n_words long, words_sha256 string, edges array<long>, links array<long>"
    return staged(batch_pass(docs.select("doc_id", row_key().alias("row_key"), "text"), schema, _graph_pass), "graph")


def repeated_edges(rows: DataFrame) -> DataFrame:
    """doc_id, row_key and flags (edge, alone_before, alone_behind) of rows that hold an edge which occurs under several ids."""
    edges = rows.select(F.explode("edges").alias("edge"), "doc_id").groupBy("edge").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"), F.count("*").alias("n"))
    shared = staged(edges.filter("low != high").select("edge", "n"), "shared_edges")
    size = F.size("edges")
    zipped = F.arrays_zip(F.col("edges").alias("edge"), F.slice("links", F.lit(1), size).alias("before"), F.slice("links", F.lit(2), size).alias("behind"))
    occurrences = rows.filter(size > 0).select("doc_id", "row_key", F.explode(zipped).alias("e")).select("doc_id", "row_key", "e.edge", "e.before", "e.behind")
    met = staged(meet(occurrences, shared, "edge").drop("n"), "shared_occurrences")
    branches = met.groupBy("edge").agg(
        (F.min("before") == F.max("before")).alias("alone_before"), (F.min("behind") == F.max("behind")).alias("alone_behind"), F.count("*").alias("n")
    )
    flagged = meet(met.select("doc_id", "row_key", "edge").distinct(), staged(branches, "branches"), "edge")
    return flagged.groupBy("doc_id", "row_key").agg(F.collect_list(F.struct("edge", "alone_before", "alone_behind")).alias("flags"))


def records(texts: DataFrame) -> DataFrame:
    """doc_id, row_key, start, length, name and proof of every path and window across a branch, for rows of (doc_id, row_key, text, flags)."""
    schema = "doc_id long, row_key long, start long, length long, name long, proof long"
    return batch_pass(texts.select("doc_id", "row_key", "text", "flags"), schema, _record_pass)


def removals(found: DataFrame) -> DataFrame:
    """doc_id, row_key and spans (start, length) of the records whose words also start under a smaller id."""
    first = found.groupBy("name", "proof").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"), F.count("*").alias("n"))
    first = staged(first.filter("low != high").drop("high"), "first_places")
    late = meet(found, first, "name", "proof").filter("low < doc_id")
    return late.groupBy("doc_id", "row_key").agg(F.collect_set(F.struct("start", "length")).alias("spans"))


def without_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed and kept_sha256 of every row of ``docs``."""
    rows = graph(docs)
    flagged = staged(repeated_edges(rows), "flagged")
    keyed = docs.select("doc_id", row_key().alias("row_key"), "text")
    # Only rows that share an edge with another id are moved, and kept for the second pass over their texts.
    texts = staged(keyed.join(flagged, ["doc_id", "row_key"]), "flagged_texts")
    spans = staged(removals(staged(records(texts), "records")), "spans")
    schema = "doc_id long, row_key long, n_removed long, kept_sha256 string"
    cut = batch_pass(texts.drop("flags").join(spans, ["doc_id", "row_key"]), schema, _cut_pass).dropDuplicates(["doc_id", "row_key"])
    cut = staged(cut, "cut").select(F.col("doc_id").alias("cut_id"), F.col("row_key").alias("cut_key"), "n_removed", "kept_sha256")
    joined = rows.drop("edges", "links").join(cut, (F.col("doc_id") == F.col("cut_id")) & (F.col("row_key") == F.col("cut_key")), "left")
    return joined.select("doc_id", "n_words", F.coalesce("n_removed", F.lit(0)).alias("n_removed"), F.coalesce("kept_sha256", "words_sha256").alias("kept_sha256"))
