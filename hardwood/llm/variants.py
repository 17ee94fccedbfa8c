"""Spelling variants: words of a corpus's vocabulary one edit apart, and the commoner form each rare word goes back to.

Method: finite-state composition. The vocabulary is an acceptor A, one edit (insertion, deletion or replacement of a code point) a
transducer T, and near pairs are what A o T o A accepts. Up to the edit both acceptors are in the same state, so the composition falls
apart by the state it reaches: all words with a common beginning, or, read backwards, a common end. Of two near words whose shorter one has m
code points, either the first m // 2 or the last m // 2 agree, so every pair lies in such a partition. A task takes
its partitions one after another: it builds the minimised acceptor of what is left of the words, walks the composition from there and enumerates the
accepted pairs; state pairs without a common end are remembered and not entered.

A partition of over ``MOST`` words is dealt again by half of what its words don't share yet, until it is small or one code point is left
(then the alphabet bounds it). So no task gathers a large group, and no pair is lost.

Defined results: a null or empty text has no words; a null id counts as empty text in the hash that deletes code points; repeated rows count
each; of several equally common near words the smallest in code-point order is the form; an empty table gives an
empty table; other columns are ignored. Texts and words of any length are taken whole.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hardwood.llm.common import batch_pass, meet, staged

LEAST_LENGTH, LEAST_COUNT, TIMES, DELETES = 6, 5, 5, 199
#: Words of a partition that one task composes at once.
MOST = 5000
RUNS = re.compile("[a-zÀ-ÿ]+")
_OUT = 20_000


def runs(doc_id: int | None, text: str | None) -> Counter:
    """How often each word occurs in a text, after lower-casing and the deletions that a hash of id and run decides."""
    counts: Counter = Counter()
    start = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    lowered = (text or "").encode().lower().decode()  # bytes.lower() changes A-Z alone
    for run, n in Counter(RUNS.findall(lowered)).items():
        h = zlib.crc32(run.encode(), start)
        if h % DELETES == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1 :]
        if len(run) >= LEAST_LENGTH:
            counts[run] += n
    return counts


def _count_pass():
    def step(batch: pa.RecordBatch):
        counts: Counter = Counter()
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            counts.update(runs(doc_id, text))
        yield pa.record_batch([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], ["word", "n"])

    return step


def vocabulary(docs: DataFrame) -> DataFrame:
    """word and n (occurrences) of all words that are long and common enough, staged."""
    counted = batch_pass(docs.select("doc_id", "text"), "word string, n long", _count_pass)
    return staged(counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= LEAST_COUNT), "vocabulary")


def minimised(words: list[str]) -> tuple[list[dict[str, int]], list[bool], int]:
    """Transitions, final marks and start of the least deterministic acceptor of ``words`` (sorted, distinct).

    Words are added in order; the states behind the last common prefix are then complete, and are replaced by
    an equal state where there is one.
    """
    edges: list[dict[str, int]] = [{}]
    final = [False]
    known: dict[tuple, int] = {}
    path = [0]
    before = ""

    def settle(down_to: int) -> None:
        while len(path) - 1 > down_to:
            state = path.pop()
            form = (final[state], *edges[state].items())
            same = known.setdefault(form, state)
            if same != state:
                edges[path[-1]][before[len(path) - 1]] = same

    for word in words:
        common = 0
        while common < len(before) and common < len(word) and before[common] == word[common]:
            common += 1
        settle(common)
        for letter in word[common:]:
            edges.append({})
            final.append(False)
            edges[path[-1]][letter] = len(edges) - 1
            path.append(len(edges) - 1)
        final[path[-1]] = True
        before = word
    settle(0)
    return edges, final, 0


def one_edit_pairs(words: list[str]) -> Iterator[tuple[str, str]]:
    """All pairs of ``words`` (distinct) one edit apart, the shorter or smaller one first, each once."""
    edges, final, start = minimised(sorted(words))
    meeting: dict[tuple[int, int], bool] = {}

    def meets(a: int, b: int) -> bool:
        """Whether some end leads from both states to acceptance."""
        if a == b:
            return True
        pair = (a, b) if a < b else (b, a)
        if pair not in meeting:
            small, large = (edges[a], edges[b]) if len(edges[a]) <= len(edges[b]) else (edges[b], edges[a])
            meeting[pair] = (final[a] and final[b]) or any(c in large and meets(s, large[c]) for c, s in small.items())
        return meeting[pair]

    def ends(a: int, b: int) -> Iterator[str]:
        stack = [(a, b, "")]
        while stack:
            x, y, read = stack.pop()
            if final[x] and final[y]:
                yield read
            stack.extend((s, edges[y][c], read + c) for c, s in edges[x].items() if c in edges[y] and meets(s, edges[y][c]))

    stack = [(start, "")]  # both acceptors in one state, no edit yet
    while stack:
        state, read = stack.pop()
        out = list(edges[state].items())
        stack.extend((s, read + c) for c, s in out)
        for k, (c, s) in enumerate(out):
            for d, t in out[k + 1 :]:
                if meets(s, t):
                    yield from ((read + min(c, d) + end, read + max(c, d) + end) for end in ends(s, t))
            # One word goes on with c, the other without it; of equal neighbours only the last counts as inserted.
            if meets(state, s):
                yield from ((read + end, read + c + end) for end in ends(state, s) if not end.startswith(c))


def _pair_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of (m, head, tail, word, n), sorted by partition; near pairs with both counts."""
    key, members = None, {}
    out: tuple[list, list, list, list] = ([], [], [], [])

    def close() -> None:
        if len(members) < 2:
            return
        m, head, tail = key
        rests = {w[len(head) : len(w) - len(tail)]: w for w in members}
        for a, b in one_edit_pairs(list(rests)):
            u, v = rests[a], rests[b]
            if min(len(u), len(v)) == m:
                for column, value in zip(out, (u, members[u], v, members[v])):
                    column.append(value)

    def taken() -> pa.RecordBatch:
        arrays = [pa.array(c, k) for c, k in zip(out, (pa.string(), pa.int64(), pa.string(), pa.int64()))]
        for column in out:
            column.clear()
        return pa.record_batch(arrays, ["word", "n", "near", "near_n"])

    for batch in batches:
        for *found, word, n in zip(*(c.to_pylist() for c in batch.columns)):
            if found != key:
                close()
                key, members = found, {}
                if len(out[0]) >= _OUT:
                    yield taken()
            members[word] = n
    close()
    if out[0]:
        yield taken()


def _dealt(words: DataFrame) -> DataFrame:
    """Rows of (word, n, m, head, tail) once more, by half of what lies between ``head`` and ``tail`` in a word of ``m`` code points: at its beginning and at its end."""
    ahead, behind = F.length("head"), F.length("tail")
    half = F.floor((F.col("m") - ahead - behind) / 2).cast("int")
    longer = F.concat("head", F.substring(F.col("word"), ahead + 1, half))
    after = F.concat(F.substring(F.col("word"), F.length("word") - behind - half + 1, half), F.col("tail"))
    kinds = F.array(F.struct(longer.alias("head"), F.col("tail").alias("tail")), F.struct(F.col("head").alias("head"), after.alias("tail")))
    return words.select("word", "n", "m", F.explode(kinds).alias("k")).select("word", "n", "m", "k.head", "k.tail")


def near_pairs(words: DataFrame, most: int = MOST) -> DataFrame:
    """word, n, near and near_n of every pair of ``words`` (word, n; distinct) one edit apart, each once, staged."""
    key = ["m", "head", "tail"]
    size = F.length("word")
    sizes = F.filter(F.array(size, size - 1), lambda m: m >= LEAST_LENGTH)
    waiting = _dealt(words.select("word", "n", F.explode(sizes).alias("m"), F.lit("").alias("head"), F.lit("").alias("tail")))
    ready = []
    while True:
        waiting = staged(waiting, "partitions").select("word", F.col("n").alias("times"), *key)
        counts = staged(waiting.groupBy(*key).agg(F.count("*").alias("n")).filter("n > 1"), "partition_sizes")
        shared = F.length("head") + F.length("tail")
        wide = (F.col("n") > most) & (F.col("m") - shared > 1)
        ready.append(waiting.join(counts.filter(~wide).select(*key), key, "left_semi").select(*key, "word", F.col("times").alias("n")))
        dense = counts.filter(wide)
        if dense.isEmpty():
            break
        waiting = _dealt(meet(waiting, dense, *key).select("word", F.col("times").alias("n"), *key))
    together = ready[0]
    for more in ready[1:]:
        together = together.unionByName(more)
    sorted_ = together.repartition(*key).sortWithinPartitions(*key)
    pairs = sorted_.mapInArrow(_pair_pass, "word string, n long, near string, near_n long")
    # A pair that shares both a beginning and an end is found in both partitions.
    return staged(pairs.dropDuplicates(["word", "near"]), "pairs")


def roots(forms: DataFrame) -> DataFrame:
    """word and root (the last word that forms lead to) for rows of (word, form). Counts grow along forms, so steps double to an end."""
    jumps = staged(forms.select("word", F.col("form").alias("root")), "jumps")
    while True:
        on = jumps.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = staged(jumps.join(on, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "jumps")
        jumps = moved.drop("moved")
        if moved.filter("moved").isEmpty():
            return jumps


def variants(docs: DataFrame, most: int = MOST) -> DataFrame:
    """word, form, root, n, n_near and form_n of every word of the vocabulary of ``docs``."""
    words = vocabulary(docs)
    pairs = near_pairs(words, most)
    both = pairs.unionByName(pairs.select(F.col("near").alias("word"), F.col("near_n").alias("n"), F.col("word").alias("near"), F.col("n").alias("near_n")))
    best = both.groupBy("word", "n").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near"))).alias("first"))
    formed = -F.col("first.less") >= TIMES * F.col("n")
    best = staged(best.select("word", "n_near", F.when(formed, F.col("first.near")).alias("form"), F.when(formed, -F.col("first.less")).alias("form_n")), "forms")
    last = roots(best.filter("form is not null"))
    return words.join(best, "word", "left").join(last, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), "form_n"
    )
