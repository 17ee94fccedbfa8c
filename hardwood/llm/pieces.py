"""SentencePiece encoding and decoding for merge-type vocabularies.

Method: a score-ordered agenda of adjacent symbol pairs. A text is written with
a leading space mark and cut where no piece of the vocabulary reaches across:
before a run of space marks and around line feeds. Within a cut, adjacent
symbols whose concatenation is a piece wait on a heap, best score first, then
leftmost; the best pair is merged and its two new neighbours join the heap until
the heap is empty. Symbols that are no piece fall back to byte pieces. Short cuts,
nearly all of a text, are merged many at a time: there the agenda of each cut is
a row of pair ranks, and every round merges the best pair of each cut.

What comes out is this module's own coding. The sentencepiece library only checks
it: every cut that a task meets for the first time is encoded by the library as
well, one call per Arrow batch, and the ids of every text are decoded by both.
``n_library`` counts the cuts whose ids differ, and one more if the decoded text
does (none is known).

Defined results: a null text counts as empty and gives the begin and end ids
alone; repeated rows are encoded each; an empty table gives an empty table;
other columns are ignored. Texts are never cut off.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Callable, Iterable
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from hardwood.llm.common import batch_pass

SPACE = "▁"
#: Cuts remembered per Python worker, and the longest one that is remembered and merged together with others.
MEMORY, SHORT = 250_000, 48
#: Rank of a pair that makes no piece.
NO_PAIR = 1 << 30


class MergeVocabulary:
    """A merge-type model: its pieces, their scores, and both directions of coding."""

    def __init__(self, model_file: str):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=model_file)
        lib, size = self.library, self.library.get_piece_size()
        self.begin, self.end, self.unknown = lib.bos_id(), lib.eos_id(), lib.unk_id()
        special = {i for i in range(size) if lib.is_control(i) or lib.is_unknown(i) or lib.is_unused(i)}
        byte_ids = [i for i in range(size) if lib.is_byte(i)]
        self.byte_of = {int(lib.id_to_piece(i)[3:-1], 16): i for i in byte_ids}
        self.rank = {
            lib.id_to_piece(i): (-lib.get_score(i), i) for i in range(size) if i not in special and not lib.is_byte(i)
        }
        # A cut is sound only where no piece spans it.
        pieces = self.rank
        self.cuts = not any(re.search(f"[^{SPACE}]{SPACE}", p) or ("\n" in p) for p in pieces)
        self.cutter = re.compile(f"{SPACE}*[^{SPACE}\n]+|{SPACE}+|\n")
        values = {i: bytes([b]) for b, i in self.byte_of.items()}
        values |= {i: p.replace(SPACE, " ").encode() for p, (_, i) in pieces.items()}
        self.bytes_of = [values.get(i, b" \xe2\x81\x87 " if i == self.unknown else b"") for i in range(size)]

        self._number_symbols()

    def _number_symbols(self) -> None:
        """Numbers for pieces and their characters, and the sorted table of pairs that make a piece."""
        names = list(dict.fromkeys([*self.rank, *(c for p in self.rank for c in p)]))
        number = {name: k for k, name in enumerate(names)}
        # Pieces of equal score rank equal: then the leftmost goes first.
        levels = {score: k for k, score in enumerate(sorted({score for score, _ in self.rank.values()}))}
        self.width = len(names)
        pairs = sorted(
            (number[p[:k]] * self.width + number[p[k:]], levels[score], number[p])
            for p, (score, _) in self.rank.items() for k in range(1, len(p)) if p[:k] in number and p[k:] in number
        )
        self.pair_key, self.pair_level, self.pair_made = (np.array(x, np.int64) for x in zip(*pairs))
        self.number, self.names = number, names
        #: Id of each numbered symbol, -1 if it is no piece.
        self.symbol_id = np.array([self.rank[s][1] if s in self.rank else -1 for s in names], np.int64)

    def _pairs(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and resulting symbol of adjacent symbols."""
        key = left * self.width + right
        at = np.minimum(np.searchsorted(self.pair_key, key), len(self.pair_key) - 1)
        found = (self.pair_key[at] == key) & (left >= 0) & (right >= 0)
        return np.where(found, self.pair_level[at], NO_PAIR), self.pair_made[at]

    def merge_many(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of many short cuts, one after the other, and how many each has.

        Each round pops the best pair of every cut's agenda; a cut without a pair leaves.
        """
        get = self.number.get
        # Characters that no piece holds get numbers below zero and take part in no pair.
        symbols = np.array([get(c, -1 - ord(c)) for c in "".join(parts)], np.int64)
        owner = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
        ended: list[tuple[np.ndarray, np.ndarray]] = []

        def ranks(at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            after = np.minimum(at + 1, len(symbols) - 1)
            level, made = self._pairs(symbols[at], symbols[after])
            return np.where((after > at) & (owner[after] == owner[at]), level, NO_PAIR), made

        level, made = ranks(np.arange(len(symbols)))
        while len(symbols):
            first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            # Rank, then position: the least is the best pair, leftmost among equals.
            best = np.minimum.reduceat((level << 32) + np.arange(len(symbols)), first)
            more = (best >> 32) < NO_PAIR
            best = best[more] & 0xFFFFFFFF
            symbols[best] = made[best]
            stay = np.repeat(more, np.diff(np.r_[first, len(symbols)]))
            ended.append((owner[~stay], symbols[~stay]))
            stay[best + 1] = False
            here = np.cumsum(stay)[best] - 1
            symbols, owner, level, made = symbols[stay], owner[stay], level[stay], made[stay]
            for at in (here, here[here > 0] - 1):
                level[at], made[at] = ranks(at)
        owner, symbols = (np.concatenate(x) if ended else np.empty(0, np.int64) for x in (list(zip(*ended)) or ([], [])))
        order = np.argsort(owner, kind="stable")
        owner, symbols = owner[order], symbols[order]
        single = np.where(symbols >= 0, self.symbol_id[symbols], -1)
        if len(several := np.flatnonzero(single < 0)):
            # Byte pieces of symbols that are no piece take the symbol's place.
            names = [self.names[s] if s >= 0 else chr(-1 - s) for s in symbols[several].tolist()]
            ids = [[self.byte_of.get(b, self.unknown) for b in name.encode()] for name in names]
            times = np.ones(len(single), np.int64)
            times[several] = [len(x) for x in ids]
            owner, single, filled = np.repeat(owner, times), np.repeat(single, times), np.repeat(single < 0, times)
            single[filled] = [i for x in ids for i in x]
        return single.astype("<u4"), np.bincount(owner, minlength=len(parts))

    def merge(self, symbols: list[str]) -> list[int]:
        """Ids of one cut by the agenda, as a heap."""
        rank, n = self.rank, len(symbols)
        left, right = list(range(-1, n - 1)), list(range(1, n + 1))
        agenda: list[tuple[float, int, str, int]] = []

        def propose(i: int, j: int) -> None:
            known = rank.get(pair := symbols[i] + symbols[j])
            if known:
                heapq.heappush(agenda, (known[0], i, pair, j))

        for i in range(n - 1):
            propose(i, i + 1)
        while agenda:
            _, i, pair, j = heapq.heappop(agenda)
            # Stale if either side was merged since: then their texts no longer make this pair.
            if not symbols[i] or not symbols[j] or right[i] != j or symbols[i] + symbols[j] != pair:
                continue
            symbols[i], symbols[j] = pair, ""
            right[i] = after = right[j]
            if after < n:
                left[after] = i
                propose(i, after)
            if left[i] >= 0:
                propose(left[i], i)
        ids: list[int] = []
        for symbol in symbols:
            if symbol in rank:
                ids.append(rank[symbol][1])
            elif symbol:
                ids.extend(self.byte_of.get(b, self.unknown) for b in symbol.encode())
        return ids

    def cut(self, text: str) -> list[str]:
        """Cuts of a text with space marks; together they are the whole text."""
        if not text:
            return []
        marked = SPACE + text.replace(" ", SPACE)
        return self.cutter.findall(marked) if self.cuts else [marked]

    def encode(self, text: str) -> list[int]:
        return [i for part in self.cut(text) for i in self.merge(list(part))]

    def by_library(self, parts: list[str]) -> list[list[int]]:
        """The library's ids of cuts; a cut without a leading space mark is put behind a line feed to keep one away."""
        given = [p[1:] if p.startswith(SPACE) else "\n" + p for p in parts]
        lead = len(self.library.encode("\n"))
        found = self.library.encode([g.replace(SPACE, " ") for g in given], num_threads=1)
        # A lone space mark becomes an empty text, which the library gives no ids.
        return [
            self.merge([SPACE]) if p == SPACE else ids if p.startswith(SPACE) else ids[lead:]
            for p, ids in zip(parts, found)
        ]

    def decode(self, ids: Iterable[int]) -> str:
        """Text of ids: begin and end vanish, bytes are joined, the leading space that encoding added goes."""
        return self.decode_bytes(ids).decode("utf-8", errors="replace")

    def decode_checked(self, ids: list[int]) -> tuple[str, bool]:
        """Text of ids, and whether the library's differs."""
        text = self.decode(ids)
        return text, self.library.decode(ids) != text

    def decode_bytes(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids)).removeprefix(b" ")


@lru_cache(maxsize=2)
def vocabulary(model_file: str) -> MergeVocabulary:
    return MergeVocabulary(model_file)


def _split(ids: np.ndarray, counts: np.ndarray) -> list[bytes]:
    """Bytes of each run of ids."""
    packed, ends = ids.tobytes(), np.cumsum(4 * counts).tolist()
    return [packed[a:b] for a, b in zip([0, *ends], ends)]


@lru_cache(maxsize=2)
def coder(model_file: str) -> Callable[[list[str]], list[tuple[bytes, int]]]:
    """Encodes the texts of one batch: ids as little-endian unsigned 32-bit integers, and how many cuts the library codes otherwise.

    One per Python worker. Short cuts are remembered between batches, within bounds.
    """
    vocab = vocabulary(model_file)
    known: dict[str, bytes] = {}
    odd: set[str] = set()
    begin, end = (np.array([i], "<u4").tobytes() for i in (vocab.begin, vocab.end))

    def encode(texts: list[str]) -> list[tuple[bytes, int]]:
        if len(known) > MEMORY:
            known.clear()
            odd.clear()
        cuts = [vocab.cut(t) for t in texts]
        fresh = list(set().union(*cuts).difference(known))
        short = [p for p in fresh if len(p) <= SHORT]
        long = [p for p in fresh if len(p) > SHORT]
        ids, counts = vocab.merge_many(short)
        own = _split(ids, counts)
        own += [np.array(vocab.merge(list(p)), "<u4").tobytes() for p in long]
        found = vocab.by_library([*short, *long])
        library = _split(np.fromiter((i for x in found for i in x), "<u4"), np.array([len(x) for x in found], np.int64))
        if own != library:
            odd.update(p for p, a, b in zip([*short, *long], own, library) if a != b)
        known.update(zip([*short, *long], own))
        coded = [
            (b"".join([begin, *map(known.__getitem__, parts), end]), sum(p in odd for p in parts) if odd else 0) for parts in cuts
        ]
        for part in long:
            del known[part]
        return coded

    return encode


def encode_documents(docs: DataFrame, model_file: str) -> DataFrame:
    """doc_id, ids (array of int, with begin and end ids), round_trip (they decode to the text) and n_library for every row of ``docs``."""

    def make():
        vocab, encode = vocabulary(model_file), coder(model_file)

        def step(batch: pa.RecordBatch):
            texts = [t or "" for t in batch.column(1).to_pylist()]
            packed, odd = zip(*encode(texts))
            ids = [np.frombuffer(p, "<u4").astype(np.int32) for p in packed]
            decoded = [vocab.decode_checked(i.tolist()) for i in ids]
            back = [d == t for (d, _), t in zip(decoded, texts)]
            odd = [n + differs for n, (_, differs) in zip(odd, decoded)]
            yield pa.record_batch(
                [batch.column(0), pa.array(ids, pa.list_(pa.int32())), pa.array(back, pa.bool_()), pa.array(odd, pa.int64())],
                ["doc_id", "ids", "round_trip", "n_library"],
            )

        return step

    return batch_pass(docs.select("doc_id", "text"), "doc_id long, ids array<int>, round_trip boolean, n_library long", make)


def decode_documents(tokens: DataFrame, model_file: str) -> DataFrame:
    """doc_id and text for rows of (doc_id, ids)."""

    def make():
        vocab = vocabulary(model_file)

        def step(batch: pa.RecordBatch):
            texts = [vocab.decode(ids or []) for ids in batch.column(1).to_pylist()]
            yield pa.record_batch([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

        return step

    return batch_pass(tokens.select("doc_id", "ids"), "doc_id long, text string", make)


def digest_documents(docs: DataFrame, model_file: str) -> DataFrame:
    """Counts and digests of the coding of every row, in one pass that returns no ids: n_tokens, ids_sha256, decoded_sha256."""

    def make():
        vocab, encode = vocabulary(model_file), coder(model_file)

        def step(batch: pa.RecordBatch):
            rows = []
            for packed, odd in encode([t or "" for t in batch.column(1).to_pylist()]):
                text, differs = vocab.decode_checked(np.frombuffer(packed, "<u4").tolist())
                rows.append((len(packed) // 4, hashlib.sha256(packed).hexdigest(), hashlib.sha256(text.encode()).hexdigest(), odd + differs))
            counts, packed, texts, odd = zip(*rows)
            yield pa.record_batch(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(packed), pa.array(texts), pa.array(odd, pa.int64())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "n_library"],
            )

        return step

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, n_library long"
    return batch_pass(docs.select("doc_id", "text"), schema, make)
