"""Mixing documents to target weights of domains, with soft membership.

Method: a classifier fitted on a labelled table (doc_id, domain) gives every document a posterior over
domains. Distributed projected-gradient least squares then finds nonnegative rates r of documents such that the
expected token totals sum_i r_i t_i p_i match the targets: it minimises the sum over domains of (total - target)^2 / now, where
``now`` is the total at rate 1. From r = 1 each step moves a document's rate against
the gradient per token of the document, which depends on its posterior alone, and projects it onto r >= 0. So a document's rate
follows from its posterior and the gradients of the steps so far (a few numbers a
step): a pass adds up the totals from rows folded by posterior, no state is kept or joined, and the work
of a step doesn't depend on any one source's share.

Posteriors are rounded to ``GRID`` parts, so rows with equal ones fold together. A rate becomes copies: its whole part, and one
more if a hash of the document is below the fraction.

Defined results: a null or empty text has no tokens; its posterior is that of no words, and its
rate follows as for others; repeated rows get equal results; a
domain that no document can belong to is left out of the targets, which are scaled to
1 again; without a labelled row all rates are 1; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import json
import warnings
from collections.abc import Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hardwood.llm.common import batch_pass, fresh_name, row_key, staged
from hardwood.llm.language import fit
from hardwood.llm.subwords import SubwordModel

GRID, CLOSE = 200, 1e-6
#: Steps after which fitting stops in any case; whether it came close enough is reported.
STEPS = 60
PER_DOMAIN = 250


def _parts(texts: list[str | None], model: SubwordModel, memory: dict) -> pa.Array:
    """Posteriors of texts in parts of ``GRID``."""
    parts = np.rint(model.probabilities(texts, memory) * GRID).astype(np.int32) if model.names else np.zeros((len(texts), 0), np.int32)
    return pa.array(list(parts), pa.list_(pa.int32()))


def posteriors(docs: DataFrame, model: SubwordModel) -> DataFrame:
    """doc_id, row_key, tokens (words of a text) and posterior (array of parts of ``GRID``, in the order of the model's names)."""

    def make():
        memory: dict = {}

        def step(batch: pa.RecordBatch):
            texts = batch.column(2).to_pylist()
            tokens = [len((t or "").encode().split()) for t in texts]
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(tokens, pa.int64()), _parts(texts, model, memory)], ["doc_id", "row_key", "tokens", "posterior"])

        return step

    schema = "doc_id long, row_key long, tokens long, posterior array<int>"
    return batch_pass(docs.select("doc_id", row_key().alias("row_key"), "text"), schema, make)


def with_posterior(docs: DataFrame, model: SubwordModel, name: str) -> DataFrame:
    """All columns of ``docs`` and the posterior of each row as ``name``; rows stay where they are."""
    at = docs.columns.index("text")

    def make():
        memory: dict = {}

        def step(batch: pa.RecordBatch):
            yield pa.RecordBatch.from_arrays([*batch.columns, _parts(batch.column(at).to_pylist(), model, memory)], names=[*batch.schema.names, name])

        return step

    return batch_pass(docs, T.StructType([*docs.schema.fields, T.StructField(name, T.ArrayType(T.IntegerType()))]), make)


@dataclass
class Mixture:
    """Fitted rates: the gradient of each step, and what the totals came to."""

    names: list[str]
    gradients: list[list[float]]
    targets: list[float]
    reached: list[float]
    converged: bool = True

    @property
    def residual(self) -> float:
        """Largest distance of a total from its target, as a share of all targets."""
        return max((abs(a - b) for a, b in zip(self.reached, self.targets)), default=0.0) / (sum(self.targets) or 1.0)

    def rate(self, posterior: Column) -> Column:
        """Rate of a posterior: the steps replayed."""
        return replay(posterior, self.gradients)


def replay(posterior: Column, gradients: list[list[float]]) -> Column:
    """1, moved by each gradient along the posterior and kept at 0 or more, in turn."""
    if not gradients:
        return F.lit(1.0)
    # One literal, which the planner folds: thousands of numbers as single columns take it longer than the rows do.
    steps = F.from_json(F.lit(json.dumps(gradients)), "array<array<double>>")

    def along(g: Column) -> Column:
        return F.aggregate(F.zip_with(g, posterior, lambda a, b: a * b / F.lit(float(GRID))), F.lit(0.0), lambda x, y: x + y)

    return F.aggregate(steps, F.lit(1.0), lambda r, g: F.greatest(F.lit(0.0), r - along(g)))


def fit_rates(shares: DataFrame, names: list[str], weights: Mapping[str, float], total_tokens: float | None = None) -> Mixture:
    """Rates for rows of (tokens, posterior).

    ``total_tokens`` is what all targets add up to; by default as many as it takes for no domain to shrink:
    the largest ratio of a domain's tokens to its weight. A domain without a weight keeps its share.
    """
    folded = staged(shares.groupBy("posterior").agg(F.sum("tokens").cast("double").alias("tokens")), "folded")

    def totals(gradients: list[list[float]]) -> np.ndarray:
        at = folded.withColumn("rate", replay(F.col("posterior"), gradients))
        row = at.agg(*[F.sum(F.col("rate") * F.col("tokens") * F.get("posterior", F.lit(k)) / GRID) for k in range(len(names))]).first()
        return np.array([x or 0.0 for x in row])

    if not names:
        return Mixture([], [], [], [])
    now = totals([])
    share = now / now.sum() if now.sum() else now
    weight = np.array([max(0.0, float(weights.get(n, share[k]))) if now[k] > 0 else 0.0 for k, n in enumerate(names)])
    if not weight.sum():
        return Mixture(names, [], now.tolist(), now.tolist())
    weight = weight / weight.sum()
    whole = total_tokens if total_tokens is not None else max(now[k] / weight[k] for k in range(len(names)) if weight[k])
    target, scale = whole * weight, np.where(now > 0, now, 1.0)
    gradients: list[list[float]] = []
    reached = now
    converged = False
    for _ in range(STEPS):
        if np.abs(reached - target).max() <= CLOSE * whole:
            converged = True
            break
        # Posteriors sum to about 1, so with these weights the curvature is 1 at most, and a step of 1 is safe.
        gradients.append(((reached - target) / scale).tolist())
        before, reached = reached, totals(gradients)
        if np.abs(reached - before).max() <= CLOSE * CLOSE * whole:
            break  # the least distance that nonnegative rates allow; the targets are out of reach
    fitted = Mixture(names, gradients, target.tolist(), reached.tolist(), converged)
    if not converged:
        warnings.warn(f"totals stay {fitted.residual:.2g} of all tokens from their targets after {len(gradients)} steps", stacklevel=2)
    return fitted


def copies(rate: Column, key: Column, least: int = 0) -> Column:
    """Whole copies for a rate, ``least`` or more: the fraction is decided by a hash of the row, the same at every run."""
    draw = F.pmod(F.xxhash64(key, F.lit("copies")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    return F.greatest(F.lit(least), F.floor(rate) + (draw < rate - F.floor(rate)).cast("long")).cast("int")


def fit_mix(
    docs: DataFrame, labels: DataFrame, weights: Mapping[str, float] | None = None, total_tokens: float | None = None
) -> tuple[DataFrame, SubwordModel, Mixture]:
    """doc_id, row_key, tokens and posterior of every row, staged, the classifier, and the fitted mixture.

    ``labels`` is (doc_id, label); ``weights`` is by domain, equal ones by default.
    """
    model = fit(docs, labels, PER_DOMAIN)
    shares = staged(posteriors(docs, model), "posteriors")
    return shares, model, fit_rates(shares, model.names, weights or dict.fromkeys(model.names, 1.0), total_tokens)


def _rounded(fitted: Mixture, posterior: Column) -> Column:
    return F.round(fitted.rate(posterior), 6)


def mix(
    docs: DataFrame, labels: DataFrame, weights: Mapping[str, float] | None = None, total_tokens: float | None = None, least: int = 0
) -> tuple[DataFrame, Mixture]:
    """doc_id, row_key, tokens, posterior, rate and copies of every row, and the fitted mixture."""
    shares, _, fitted = fit_mix(docs, labels, weights, total_tokens)
    rated = shares.withColumn("rate", _rounded(fitted, F.col("posterior")))
    return rated.withColumn("copies", copies(F.col("rate"), F.col("row_key"), least)), fitted


def mixed(docs: DataFrame, labels: DataFrame, weights: Mapping[str, float], least: int = 0, total_tokens: float | None = None) -> DataFrame:
    """Each row of ``docs``, all columns, as often as its rate says.

    A rate follows from the posterior alone, so the rows are read and classified once more and repeated where they lie: nothing is joined or shuffled.
    """
    _, model, fitted = fit_mix(docs, labels, weights, total_tokens)
    posterior, rate, one = (fresh_name(docs, n) for n in ("mix_posterior", "mix_rate", "mix_one"))
    rated = with_posterior(docs, model, posterior).withColumn(rate, _rounded(fitted, F.col(posterior)))
    often = copies(F.col(rate), row_key(), least)
    return rated.withColumn(one, F.explode(F.array_repeat(F.lit(1), often))).select(docs.columns)
