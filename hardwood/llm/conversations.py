"""Conversation repair: the cheapest edits that make a conversation ``(s?(ua)+)?``, by role initials.

Method: bidirectional Dijkstra over the edit lattice. A node is a number of rows used and a state of the pattern; edits are its
links: keep a row, give it another role, delete it, insert an empty one. One heap grows from the first node, one
backwards from the accepting ones, the cheaper first. When they meet, both go on until no link can add a crossing of the same cost;
of all crossings the one with the least concatenated audit is taken. At equal cost nodes are settled in row order, so
that labels are final when they are used: two equally cheap ways to one node never are a beginning of each other, so the
least parts give the least whole.

Rows are dealt by ranges of conversation and turn, without their texts, so that one very long conversation lies in many
tasks. A task walks its conversations. What may go on in another task, and any conversation of over ``BLOCK`` rows, is searched
block by block from every state to every state, and blocks are combined pair by pair; the pieces of a conversation cut by
a range are combined last. The repaired texts are then written in one pass that streams rows behind their audit.

Faults: blank, else duplicate (role and text were there before in the conversation), else truncated. Defined results: a null role or
text is one space; a null turn comes first and counts for no gap; rows of one turn are in order of role and MD5 of the text;
equal rows of one turn are copies, of which the first counts; rows with a null id form one conversation; an empty role has no
initial, and a role with another initial than s, u or a can't be kept. A
conversation without rows has zeros and empty texts; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from heapq import heappop, heappush
from itertools import groupby

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hardwood.llm.common import batch_pass, meet, staged

#: Costs of the edits, and of keeping or renaming a truncated row besides.
DELETE, RENAME, INSERT, TRUNCATED = 4, 3, 3, 3
#: The pattern: state and role initial give the next state (0 nothing yet, 1 behind s, 2 behind u, 3 behind a).
NEXT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (3, "u"): 2, (2, "a"): 3}
ACCEPTING = (0, 3)
NAMES = {"u": "user", "a": "assistant"}
LEGAL = ("su", "ua", "au")
#: Rows that one search spans.
BLOCK = 64
REMEMBERED = 50_000
_WHITE = " \t\n\x0b\x0c\r"

Node = tuple[int, int]
Row = tuple[str, str]  # initial and fault
Table = dict[tuple[int, int], tuple[int, str]]


def _onward(rows: tuple[Row, ...], node: Node) -> Iterator[tuple[Node, int, str]]:
    i, q = node
    for letter in NAMES:
        if (q, letter) in NEXT:
            yield (i, NEXT[q, letter]), INSERT, "I"
    if i == len(rows):
        return
    initial, fault = rows[i]
    yield (i + 1, q), DELETE, "D"
    if fault not in ("blank", "duplicate"):
        more = TRUNCATED if fault == "truncated" else 0
        if (q, initial) in NEXT:
            yield (i + 1, NEXT[q, initial]), more, "K"
        for letter in NAMES:
            if (q, letter) in NEXT:
                yield (i + 1, NEXT[q, letter]), RENAME + more, "R"


def _backward(rows: tuple[Row, ...], node: Node) -> Iterator[tuple[Node, int, str]]:
    i, q = node
    before = [(p, letter) for (p, letter), to in NEXT.items() if to == q]
    for p, letter in before:
        if letter in NAMES:
            yield (i, p), INSERT, "I"
    if i == 0:
        return
    initial, fault = rows[i - 1]
    yield (i - 1, q), DELETE, "D"
    if fault not in ("blank", "duplicate"):
        more = TRUNCATED if fault == "truncated" else 0
        for p, letter in before:
            if letter == initial:
                yield (i - 1, p), more, "K"
            if letter in NAMES:
                yield (i - 1, p), RENAME + more, "R"


def search(rows: tuple[Row, ...], entry: int, exits: Iterable[int]) -> tuple[int, str] | None:
    """Least cost, and the least audit at that cost, from state ``entry`` before ``rows`` to one of ``exits`` behind them."""
    # Labels are cost and audit; heaps are by cost, then in the direction of free links.
    ahead: dict[Node, tuple[int, str]] = {(0, entry): (0, "")}
    behind: dict[Node, tuple[int, str]] = {(len(rows), q): (0, "") for q in exits}
    heap_a = [(0, 0, (0, entry))]
    heap_b = [(0, -i, (i, q)) for i, q in behind]
    done_a: set[Node] = set()
    done_b: set[Node] = set()
    met = min((behind[n][0] for n in behind if n in ahead), default=None)
    while heap_a and heap_b and (met is None or heap_a[0][0] + heap_b[0][0] <= met):
        forward = heap_a[0][0] <= heap_b[0][0]
        heap, labels, others, done = (heap_a, ahead, behind, done_a) if forward else (heap_b, behind, ahead, done_b)
        _, _, node = heappop(heap)
        if node in done:
            continue
        done.add(node)
        cost, audit = labels[node]
        for to, step, letter in (_onward if forward else _backward)(rows, node):
            label = (cost + step, audit + letter if forward else letter + audit)
            if to not in labels or label < labels[to]:
                labels[to] = label
                heappush(heap, (label[0], to[0] if forward else -to[0], to))
                if to in others:
                    total = label[0] + others[to][0]
                    met = total if met is None else min(met, total)
    return min(((ahead[n][0] + behind[n][0], ahead[n][1] + behind[n][1]) for n in ahead if n in behind), default=None)


def combined(first: Table, second: Table) -> Table:
    """Best ways through two neighbouring pieces, by entry and exit state."""
    found: Table = {}
    for (q, middle), (cost, audit) in first.items():
        for (entry, r), (more, rest) in second.items():
            if entry == middle:
                known = found.get((q, r))
                if known is None or cost + more < known[0] or (cost + more == known[0] and audit + rest < known[1]):
                    found[q, r] = (cost + more, audit + rest)
    return found


class _Walk:
    """Best ways through the rows of one piece of a conversation, block by block."""

    def __init__(self, memory: dict, whole_start: bool):
        self.memory, self.entries = memory, (0,) if whole_start else (0, 1, 2, 3)
        self.rows: list[Row] = []
        self.pieces: list[tuple[int, Table]] = []  # size class and ways; neighbours of one class are combined
        self.first: str | None = None
        self.last: str | None = None
        self.illegal = 0

    def add(self, initial: str, fault: str) -> None:
        if self.last is not None:
            self.illegal += self.last + initial not in LEGAL
        else:
            self.first = initial
        self.last = initial
        self.rows.append((initial, fault))
        if len(self.rows) == BLOCK:
            self._close_block()

    def _search(self, rows: tuple[Row, ...], entry: int, exits: tuple[int, ...]) -> tuple[int, str] | None:
        key = (rows, entry, exits)
        if key not in self.memory:
            if len(self.memory) >= REMEMBERED:
                self.memory.clear()
            self.memory[key] = search(rows, entry, exits)
        return self.memory[key]

    def _close_block(self) -> None:
        rows, self.rows = tuple(self.rows), []
        entries = self.entries if not self.pieces else (0, 1, 2, 3)
        ways = {(q, r): way for q in entries for r in range(4) if (way := self._search(rows, q, (r,))) is not None}
        self.pieces.append((0, ways))
        while len(self.pieces) > 1 and self.pieces[-1][0] == self.pieces[-2][0]:
            (size, right), (_, left) = self.pieces.pop(), self.pieces.pop()
            self.pieces.append((size + 1, combined(left, right)))

    def ways(self) -> Table:
        if self.rows:
            self._close_block()
        whole = self.pieces.pop()[1]
        while self.pieces:
            whole = combined(self.pieces.pop()[1], whole)
        return whole

    def best(self) -> tuple[int, str]:
        if not self.pieces:
            return self._search(tuple(self.rows), 0, ACCEPTING)
        return accepted(self.ways())


def accepted(ways: Table) -> tuple[int, str]:
    return min(ways[0, q] for q in ACCEPTING if (0, q) in ways)


def _walk_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of (known, conv, initial, blank, truncated, is_first, times) in order: a piece for each conversation of the task."""
    memory: dict = {}
    part = TaskContext.get().partitionId()
    out: list[tuple] = []

    def record(key: tuple, walk: _Walk, edge: bool) -> None:
        ways = walk.ways() if edge else dict([((0, ACCEPTING[0]), walk.best())])
        listed = [{"entry": q, "exit": r, "cost": c, "audit": a} for (q, r), (c, a) in ways.items()]
        out.append((*key, part, edge, walk.first, walk.last, walk.illegal, listed))

    key, walk, starts = None, None, True
    for batch in batches:
        for known, conv, initial, blank, truncated, is_first, times in zip(*(c.to_pylist() for c in batch.columns)):
            if (known, conv) != key:
                if key is not None:
                    record(key, walk, starts)
                    starts = False
                    if len(out) >= 512:
                        yield _pieces_batch(out)
                        out.clear()
                key, walk = (known, conv), _Walk(memory, key is not None)
            for k in range(times):
                walk.add(initial, "blank" if blank else "duplicate" if k or not is_first else "truncated" if truncated else "")
    if key is not None:
        record(key, walk, True)  # the last one of a task may go on in the next
        yield _pieces_batch(out)


_PIECES = "known boolean, conv string, part int, edge boolean, first string, last string, illegal long, ways array<struct<entry: int, exit: int, cost: long, audit: string>>"
_WAYS = pa.list_(pa.struct([("entry", pa.int32()), ("exit", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())]))


def _pieces_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.bool_(), pa.string(), pa.int32(), pa.bool_(), pa.string(), pa.string(), pa.int64(), _WAYS)
    names = ("known", "conv", "part", "edge", "first", "last", "illegal", "ways")
    return pa.record_batch([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], names)


def _joined_pass():
    def step(batch: pa.RecordBatch):
        costs, audits, illegal = [], [], []
        for pieces in batch.column(2).to_pylist():
            pieces.sort(key=lambda p: p["part"])
            whole, wrong, before = None, 0, None
            for p in pieces:
                ways = {(w["entry"], w["exit"]): (w["cost"], w["audit"]) for w in p["ways"]}
                whole = ways if whole is None else combined(whole, ways)
                wrong += p["illegal"] + (before is not None and before + p["first"] not in LEGAL)
                before = p["last"]
            cost, audit = accepted(whole)
            costs.append(cost)
            audits.append(audit)
            illegal.append(wrong)
        yield pa.record_batch([batch.column(0), batch.column(1), pa.array(illegal, pa.int64()), pa.array(costs, pa.int64()), pa.array(audits, pa.string())], ["known", "conv", "illegal", "cost", "audit"])

    return step


def replayed(audit: str, rows: Iterator[tuple[str, str]]) -> Iterator[tuple[str, str]]:
    """Role and text of the repaired rows: the edits of ``audit`` on ``rows``, which are read one by one."""
    state = 0
    for edit in audit:
        letter = next((x for x in NAMES if (state, x) in NEXT), "")
        if edit == "I":
            yield NAMES[letter], ""
        else:
            role, text = next(rows)
            if edit == "D":
                continue
            if edit == "K":
                letter = role[:1]
            yield (role if edit == "K" else NAMES[letter]), text
        state = NEXT[state, letter]


def _in_order(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, str | None, str, str]]:
    for batch in batches:
        for known, conv, audit, role, text, copies in zip(*(c.to_pylist() for c in batch.columns)):
            for _ in range(copies):
                yield (known, conv), audit, role, text


def _repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, Iterator[tuple[str, str]]]]:
    """Conversation and repaired rows, for rows sorted behind their audit. Rows are streamed: one batch is held."""
    for key, rows in groupby(_in_order(batches), key=lambda r: r[0]):
        audit = next(rows)[1]
        yield key, replayed(audit, ((role, text) for _, _, role, text in rows))


def _digest_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    out: list[tuple] = []
    for key, rows in _repaired(batches):
        digest = hashlib.sha256()
        for k, (role, text) in enumerate(rows):
            digest.update(f"{chr(10) if k else ''}{role}:{text}".encode())
        out.append((*key, digest.hexdigest()))
        if len(out) >= 4096:
            yield pa.record_batch([pa.array(c) for c in zip(*out)], ["known", "conv", "repaired_sha256"])
            out = []
    if out:
        yield pa.record_batch([pa.array(c) for c in zip(*out)], ["known", "conv", "repaired_sha256"])


def _turn_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["known", "conv", "place", "role", "text"]
    out, held = [], 0
    for key, rows in _repaired(batches):
        for place, (role, text) in enumerate(rows):
            out.append((*key, place, role, text))
            held += len(text)
            if len(out) >= 4096 or held > 1 << 24:
                yield pa.record_batch([pa.array(c) for c in zip(*out)], names)
                out, held = [], 0
    if out:
        yield pa.record_batch([pa.array(c) for c in zip(*out)], names)


CONV, TURN = ["known", "conv"], ["dated", "turn"]


def _keyed(rows: DataFrame) -> DataFrame:
    """Rows with keys without nulls, and role, text and copies; extra columns are left behind."""
    copies = F.col("copies").cast("int") if "copies" in rows.columns else F.lit(1)
    return rows.select(
        F.col("conv_id").isNotNull().alias("known"), F.coalesce(F.col("conv_id").cast("string"), F.lit("")).alias("conv"),
        F.col("turn").isNotNull().alias("dated"), F.coalesce(F.col("turn").cast("long"), F.lit(0)).alias("turn"),
        F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"), copies.alias("copies"),
    ).withColumn("name", F.md5(F.col("text").cast("binary")))


def faults(rows: DataFrame) -> DataFrame:
    """known, conv, dated, turn, role, name, blank, truncated, times and is_first of every distinct row of a turn, staged."""
    seen = F.translate("text", _WHITE, "")
    blank = seen == ""
    truncated = ~blank & ~F.substring(seen, -1, 1).isin(".", "!", "?")
    light = rows.select(*CONV, *TURN, "role", "name", blank.alias("blank"), truncated.alias("truncated"), "copies")
    folded = staged(light.groupBy(*CONV, *TURN, "role", "name", "blank", "truncated").agg(F.sum("copies").alias("times")), "turns")
    first = folded.groupBy(*CONV, "role", "name").agg(F.min(F.struct(*TURN)).alias("earliest"), F.count("*").alias("n"))
    met = meet(folded, staged(first, "first_turns"), *CONV, "role", "name")
    return staged(met.withColumn("is_first", F.struct(*TURN) == F.col("earliest")).drop("earliest", "n"), "faults")


def repairs(marked: DataFrame) -> DataFrame:
    """known, conv, illegal, cost and audit of every conversation of ``faults``, staged."""
    order = [*CONV, *TURN, "role", "name"]
    dealt = marked.repartitionByRange(*order).sortWithinPartitions(*order)
    walked = dealt.select(*CONV, F.substring("role", 1, 1).alias("initial"), "blank", "truncated", "is_first", "times").mapInArrow(_walk_pass, _PIECES)
    pieces = staged(walked, "pieces")
    whole = pieces.filter("not edge").select(*CONV, "illegal", F.get("ways", F.lit(0)).alias("w")).select(*CONV, "illegal", "w.cost", "w.audit")
    # At most two pieces of each task may go on in another one.
    cut = pieces.filter("edge").groupBy(*CONV).agg(F.collect_list(F.struct("part", "first", "last", "illegal", "ways")).alias("pieces"))
    joined = batch_pass(cut, "known boolean, conv string, illegal long, cost long, audit string", _joined_pass)
    return staged(whole.unionByName(joined), "audits")


def _behind_audits(rows: DataFrame, audits: DataFrame) -> DataFrame:
    """The rows of each conversation in order, behind one row with its audit, in one task."""
    heads = audits.select(*CONV, F.lit(0).alias("kind"), "audit", F.lit(False).alias("dated"), F.lit(0).cast("long").alias("turn"), F.lit("").alias("role"),
                          F.lit("").alias("name"), F.lit("").alias("text"), F.lit(1).alias("copies"))
    bodies = rows.select(*CONV, F.lit(1).alias("kind"), F.lit(None).cast("string").alias("audit"), *TURN, "role", "name", "text", "copies")
    order = [*CONV, "kind", *TURN, "role", "name"]
    return heads.unionByName(bodies).repartition(*CONV).sortWithinPartitions(*order).select(*CONV, "audit", "role", "text", "copies")


def repaired_turns(rows: DataFrame) -> DataFrame:
    """conv_id (text), place, role and text of the repaired conversations of ``rows`` (conv_id, turn, role, text and, if given, copies)."""
    keyed = _keyed(rows)
    found = _behind_audits(keyed, repairs(faults(keyed))).mapInArrow(_turn_pass, "known boolean, conv string, place long, role string, text string")
    return found.select(F.when(F.col("known"), F.col("conv")).alias("conv_id"), "place", "role", "text")


def repair(rows: DataFrame, every: DataFrame) -> DataFrame:
    """gaps, blank, duplicate, truncated, illegal, cost, audit and repaired_sha256 of every ``conv_id`` in ``every``."""
    keyed = _keyed(rows)
    marked = faults(keyed)
    audits = repairs(marked)
    digests = _behind_audits(keyed, audits).mapInArrow(_digest_pass, "known boolean, conv string, repaired_sha256 string")
    sound = ~F.col("blank") & F.col("is_first")
    by_turn = marked.groupBy(*CONV, *TURN).agg(
        F.sum(F.when(F.col("blank"), F.col("times")).otherwise(0)).alias("blank"),
        F.sum(F.when(F.col("blank"), 0).otherwise(F.col("times") - F.col("is_first").cast("int"))).alias("duplicate"),
        F.sum((sound & F.col("truncated")).cast("long")).alias("truncated"),
    )
    at = F.when(F.col("dated"), F.col("turn"))
    counts = by_turn.groupBy(*CONV).agg(
        F.coalesce(F.max(at) - F.min(at) + 1 - F.count(at), F.lit(0)).alias("gaps"), *(F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated"))
    )
    ids = every.select("conv_id").distinct().select("conv_id", F.col("conv_id").isNotNull().alias("known"), F.coalesce(F.col("conv_id").cast("string"), F.lit("")).alias("conv"))
    joined = ids.join(counts, CONV, "left").join(audits, CONV, "left").join(digests, CONV, "left")
    numbers = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return joined.select("conv_id", *numbers, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"))
