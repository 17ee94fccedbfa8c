"""A text classifier: averaged hashed subword embeddings under a linear softmax, trained by stochastic gradient descent.

A text is its runs of letters, lower-cased; a word's subwords are the character sequences of 1 to 3 code points of
``<word>``, hashed to ``BUCKETS`` embeddings. The text's vector is the mean embedding of all its subwords, and
class probabilities are a softmax of a linear map of it, at a temperature fitted on rows that training
left out. As the map is linear, a word's share of the logits is added up once per
word and remembered, so whole texts of any length are read in one pass.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

import numpy as np

BUCKETS, WIDTH, LONGEST = 1 << 15, 16, 3
LETTERS = re.compile(r"[^\W\d_]+")
#: Words of one training example: texts are cut to such pieces, so that short texts are learned too.
PIECE_WORDS = 30
#: Steps that training takes at least.
LEAST_STEPS = 200
#: Words a worker remembers.
MEMORY = 400_000
_STEP = np.uint64(0x100000001B3)
_MIX = np.uint64(0x9E3779B97F4A7C15)


def subwords(words: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all subwords of ``words``, and for each the place of its word."""
    if not words:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    marked = "".join(f"<{w}>" for w in words)
    codes = np.frombuffer(marked.encode("utf-32-le"), "<u4").astype(np.uint64)
    lengths = np.array([len(w) + 2 for w in words])
    owner = np.repeat(np.arange(len(words)), lengths)
    found, owners = [], []
    value = np.zeros(len(codes), np.uint64)
    for n in range(1, LONGEST + 1):
        if n > len(codes):
            break
        value = (value[: len(codes) - n + 1] * _STEP) ^ codes[n - 1 :]
        inside = owner[n - 1 :] == owner[: len(codes) - n + 1]
        mixed = ((value + np.uint64(n)) * _MIX) >> np.uint64(49)
        found.append(mixed[inside])
        owners.append(owner[: len(codes) - n + 1][inside])
    return np.concatenate(found).astype(np.int64), np.concatenate(owners)


def letters(text: str | None) -> list[str]:
    """Runs of letters, lower-cased. ``LETTERS`` also takes numerals that are no letters (fractions, superscripts, Roman ones): words with such are split at them."""
    found = LETTERS.findall(text.lower()) if text else []
    if all(map(str.isalpha, found)):
        return found
    return [part for word in found for part in "".join(c if c.isalpha() else " " for c in word).split()]


class SubwordModel:
    """``names``: the classes. Fitted values are plain arrays; an instance is shipped to tasks by broadcast or closure."""

    def __init__(self, names: Sequence[str], table: np.ndarray, bias: np.ndarray, threshold: float = 0.0):
        self.names, self.table, self.bias, self.threshold = list(names), table, bias, threshold

    def logits(self, texts: Sequence[str | None], memory: dict) -> np.ndarray:
        """Logits of each text; a text without letters gets the bias. ``memory`` is kept by the caller between batches."""
        k = len(self.names)
        known, rows = memory.setdefault("known", {}), memory.setdefault("rows", [np.zeros((0, k + 1), np.float32)])
        if len(known) > MEMORY:
            known.clear()
            rows[0] = np.zeros((0, k + 1), np.float32)
        words = [letters(t) for t in texts]
        fresh = list(set().union(*words).difference(known)) if words else []
        if fresh:
            buckets, owner = subwords(fresh)
            share = np.zeros((len(fresh), k + 1), np.float32)
            for c in range(k):
                share[:, c] = np.bincount(owner, self.table[buckets, c], minlength=len(fresh))
            share[:, k] = np.bincount(owner, minlength=len(fresh))
            known.update(zip(fresh, range(len(rows[0]), len(rows[0]) + len(fresh))))
            rows[0] = np.concatenate([rows[0], share])
        out = np.tile(self.bias, (len(words), 1))
        for i, found in enumerate(words):
            if found:
                total = rows[0][np.fromiter(map(known.__getitem__, found), np.int64, len(found))].sum(axis=0, dtype=np.float64)
                out[i] += total[:k] / total[k]
        return out

    def probabilities(self, texts: Sequence[str | None], memory: dict) -> np.ndarray:
        return softmax(self.logits(texts, memory))


def softmax(logits: np.ndarray) -> np.ndarray:
    raised = np.exp(logits - logits.max(axis=1, keepdims=True))
    return raised / raised.sum(axis=1, keepdims=True)


def pieces(text: str | None) -> list[list[str]]:
    """Training examples of a text: all its words, ``PIECE_WORDS`` at a time."""
    words = letters(text)
    return [words[i : i + PIECE_WORDS] for i in range(0, len(words), PIECE_WORDS)]


def train(
    names: Sequence[str], examples: Sequence[tuple[int, Sequence[str]]], left_out: Sequence[tuple[int, Sequence[str]]],
    epochs: int = 3, rate: float = 0.3, batch: int = 64, seed: int = 7, wanted: float = 0.99,
) -> SubwordModel:
    """Fit on (class, words) ``examples``; the temperature and the rejection threshold on ``left_out``.

    The threshold is the least probability above which at least ``wanted`` of the left-out texts are right.
    Without examples every class is equally likely.
    """
    k, rng = len(names), np.random.default_rng(seed)
    if not examples:
        return SubwordModel(names, np.zeros((BUCKETS, k), np.float32), np.zeros(k))
    label = np.array([c for c, _ in examples])
    bags = [subwords(w)[0].astype(np.int32) for _, w in examples]
    vectors = rng.normal(0, 1 / WIDTH, (BUCKETS, WIDTH)).astype(np.float32)
    weight, bias = np.zeros((k, WIDTH), np.float32), np.zeros(k, np.float32)
    # A small set is gone through more often.
    epochs = max(epochs, -(-LEAST_STEPS // -(-len(bags) // batch)))
    rounds, at = epochs * -(-len(bags) // batch), 0
    for _ in range(epochs):
        order = rng.permutation(len(bags))
        for start in range(0, len(order), batch):
            chosen = order[start : start + batch]
            sizes = np.array([len(bags[i]) for i in chosen])
            index, owner = np.concatenate([bags[i] for i in chosen]), np.repeat(np.arange(len(chosen)), sizes)
            mean = np.add.reduceat(vectors[index], np.r_[0, np.cumsum(sizes)[:-1]]) / sizes[:, None]
            wrong = softmax(mean @ weight.T + bias)
            wrong[np.arange(len(chosen)), label[chosen]] -= 1
            step = rate * (1 - at / rounds)
            back = (wrong @ weight) / sizes[:, None]
            weight -= step * wrong.T @ mean / len(chosen) * 8
            bias -= step * wrong.mean(axis=0)
            np.add.at(vectors, index, (-step * back[owner]).astype(np.float32))
            at += 1
    model = SubwordModel(names, (vectors @ weight.T).astype(np.float32), bias.astype(np.float64))
    if left_out:
        _calibrate(model, left_out, wanted)
    return model


def _calibrate(model: SubwordModel, left_out: Sequence[tuple[int, Sequence[str]]], wanted: float) -> None:
    logits = model.logits([" ".join(w) for _, w in left_out], {})
    truth = np.array([c for c, _ in left_out])

    def loss(t: float) -> float:
        return -np.log(softmax(logits / t)[np.arange(len(truth)), truth] + 1e-12).mean()

    temperature = min(np.geomspace(0.05, 5, 60), key=loss)
    model.table, model.bias = (model.table / temperature).astype(np.float32), model.bias / temperature
    given = softmax(logits / temperature)
    top, right = given.max(axis=1), given.argmax(axis=1) == truth
    order = np.argsort(-top)
    good = np.flatnonzero(np.cumsum(right[order]) >= wanted * np.arange(1, len(order) + 1))
    model.threshold = float(top[order][good[-1]]) if len(good) else 1.0
