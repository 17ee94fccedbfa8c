"""Quality classifier: a regularised quadratic discriminant over transformed document statistics.

Statistics of a whole text (lengths, shares of characters, repetition, words) are made roughly normal by
logarithms and square roots. The class means and covariances are fitted on all labelled rows: Spark adds up
counts, sums and products per class and task, so the fit has no sample and only a few matrices reach the driver.
Each covariance is shrunk towards the pooled one and its diagonal. The score is the logistic of the difference of log
densities, from Mahalanobis distances by Cholesky factors that are computed once and shipped with the model.

Defined results: a null or empty text has all statistics 0 and gets the score
of such texts; repeated rows are each scored; ids with several labels count once, with the lower one; a class with
fewer than two rows takes the pooled covariance; with one class alone, or none, all rows get
that class's smoothed share; an empty table gives an empty table; other columns are ignored. Texts are never cut off.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hardwood.llm.common import batch_pass, row_key, staged

STATISTICS = (
    "log_chars", "log_words", "mean_word", "long_words", "letters", "digits", "capitals", "symbols", "pipes", "exclamations",
    "other_marks", "line_words", "repeated_lines", "distinct_words", "repeated_next", "repeated_pairs", "top_word", "capital_words", "ended_lines",
)
#: Weights of the pooled covariance and of its diagonal in each class covariance, and a floor of the variances.
POOLED, DIAGONAL, FLOOR = 0.15, 0.10, 1e-4
#: Scores are tempered: the statistics are not independent of each other in the tails.
TEMPER = 0.5

_UPPER, _DIGITS, _SYMBOLS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b"#*$%&<>@\\^_`{}~=+/"
_MARKS, _SPACE = b".,;:'\"()[]-", b" \t\n\r\x0b\x0c"


def statistics_of(text: str | None) -> list[float]:
    """The transformed statistics of a whole text; words are runs without ASCII white space."""
    raw = (text or "").encode()
    words = raw.split()
    if not words:
        return [0.0] * len(STATISTICS)
    size, n = len(raw), len(words)

    def share(characters: bytes) -> float:
        return ((size - len(raw.translate(None, characters))) / size) ** 0.5

    lower = raw.lower().split()
    counts = Counter(lower)
    lines = [line.strip() for line in raw.split(b"\n")]
    lines = [line for line in lines if line]
    lengths = np.fromiter(map(len, words), np.int64, n)
    following = sum(map(bytes.__eq__, lower, lower[1:]))
    pairs = len(set(zip(lower, lower[1:])))
    return [
        np.log1p(size), np.log1p(n), np.log(lengths.mean()), (lengths > 14).mean() ** 0.5,
        1 - share(_UPPER + _DIGITS + _SYMBOLS + _MARKS + b"|!?" + _SPACE), share(_DIGITS), share(_UPPER), share(_SYMBOLS), share(b"|"), share(b"!?"),
        share(_MARKS), np.log(n / len(lines)), (1 - len(set(lines)) / len(lines)) ** 0.5, (len(counts) / n) ** 0.5,
        (following / n) ** 0.5, (1 - pairs / max(1, n - 1)) ** 0.5 if n > 1 else 0.0, (max(counts.values()) / n) ** 0.5,
        (sum(map(bytes.isupper, words)) / n) ** 0.5, (sum(line.endswith((b".", b"!", b"?")) for line in lines) / len(lines)) ** 0.5,
    ]


def statistics(docs: DataFrame) -> DataFrame:
    """doc_id, row_key and the statistics of every row, from whole texts in one pass."""

    def make():
        def step(batch: pa.RecordBatch):
            x = [statistics_of(t) for t in batch.column(2).to_pylist()]
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(x, pa.list_(pa.float64()))], ["doc_id", "row_key", "x"])

        return step

    return batch_pass(docs.select("doc_id", row_key().alias("row_key"), "text"), "doc_id long, row_key long, x array<double>", make)


@dataclass
class Discriminant:
    """Per class its mean, the inverse of the Cholesky factor, and half the log determinant."""

    means: list[np.ndarray]
    whiteners: list[np.ndarray]
    halves: list[float]
    prior: float

    def score(self, x: np.ndarray) -> np.ndarray:
        if not self.means:
            return np.full(len(x), self.prior)
        density = [-0.5 * (((x - m) @ w.T) ** 2).sum(axis=1) - h for m, w, h in zip(self.means, self.whiteners, self.halves)]
        margin = TEMPER * (density[1] - density[0]) + np.log(self.prior / (1 - self.prior))
        return 1 / (1 + np.exp(-np.clip(margin, -500, 500)))


def moments(rows: DataFrame) -> list[tuple[float, np.ndarray, np.ndarray]]:
    """Count, sum and sum of products of x (label, x) for labels 0 and 1; added up per task, then over tasks."""
    d = len(STATISTICS)

    def make():
        def step(batch: pa.RecordBatch):
            labels = np.array(batch.column(0).to_pylist())
            x = np.array(batch.column(1).to_pylist(), np.float64).reshape(len(labels), d)
            for label in np.unique(labels):
                of = x[labels == label]
                for place, value in enumerate(np.r_[len(of), of.sum(axis=0), (of.T @ of).ravel()]):
                    yield label, place, value

        def pack(batch: pa.RecordBatch):
            label, place, value = zip(*step(batch))
            yield pa.record_batch([pa.array(label, pa.int32()), pa.array(place, pa.int32()), pa.array(value, pa.float64())], ["label", "place", "value"])

        return pack

    sums = batch_pass(rows.select("label", "x"), "label int, place int, value double", make).groupBy("label", "place").agg(F.sum("value").alias("value"))
    found = {(r.label, r.place): r.value for r in sums.collect()}

    def of(label: int) -> tuple[float, np.ndarray, np.ndarray]:
        flat = np.array([found.get((label, p), 0.0) for p in range(1 + d + d * d)])
        return flat[0], flat[1 : 1 + d], flat[1 + d :].reshape(d, d)

    return [of(0), of(1)]


def fit(sums: list[tuple[float, np.ndarray, np.ndarray]]) -> Discriminant:
    n = [s[0] for s in sums]
    prior = (n[1] + 1) / (sum(n) + 2)
    if not all(n):
        return Discriminant([], [], [], prior)
    means = [s / k for k, s, _ in sums]
    scatter = [p - k * np.outer(m, m) for (k, _, p), m in zip(sums, means)]
    pooled = sum(scatter) / max(1.0, sum(n) - 2)
    model = Discriminant(means, [], [], prior)
    for k, s in zip(n, scatter):
        own = s / (k - 1) if k > 1 else pooled
        cov = (1 - POOLED - DIAGONAL) * own + POOLED * pooled + DIAGONAL * np.diag(np.diag(pooled)) + FLOOR * np.eye(len(own))
        factor = np.linalg.cholesky(cov)
        model.whiteners.append(np.linalg.inv(factor))
        model.halves.append(float(np.log(np.diag(factor)).sum()))
    return model


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, row_key and score of every row of ``docs``; ``labels`` is (doc_id, label 0 or 1) of rows to learn from."""
    rows = staged(statistics(docs), "statistics")
    known = labels.dropna(subset=["doc_id", "label"]).groupBy("doc_id").agg(F.min("label").cast("int").alias("label"))
    model = fit(moments(rows.join(known, "doc_id").select("label", "x")))

    def make():
        def step(batch: pa.RecordBatch):
            x = np.array(batch.column(2).to_pylist(), np.float64).reshape(batch.num_rows, len(STATISTICS))
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(model.score(x), pa.float64())], ["doc_id", "row_key", "score"])

        return step

    return batch_pass(rows, "doc_id long, row_key long, score double", make)
