"""Bounded, repeatable samples of labelled rows, to fit classifiers on the driver."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hardwood.llm.common import staged

#: Places that sampled rows are dealt to; parts of a sample are ranges or remainders of places.
PLACES = 1 << 20
_RANGE = 1 << 40


def labelled_sample(labels: DataFrame, id_name: str, label: Column, per_class: int) -> DataFrame:
    """doc_id, label and place of about ``per_class`` rows of each label (all, if there are no more), chosen by a hash of the id.

    A label with n rows keeps those in the lowest ``per_class`` / n of the hash's range, so no task gathers a label's
    rows; the number kept is binomial, and twice ``per_class`` is out of reach for the hundreds used here. ``place`` is a second hash.
    Rows without id or label are left out, and ids with several labels count once, with the least.
    """
    rows = labels.select(F.col(id_name).alias("doc_id"), label.alias("label")).dropna()
    one = staged(rows.groupBy("doc_id").agg(F.min("label").alias("label")), "labelled")
    counts = staged(one.groupBy(F.col("label").alias("of_label")).agg(F.count("*").alias("n")), "label_counts")
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(_RANGE))
    return one.join(counts, F.col("label") == F.col("of_label")).filter(draw.cast("double") * F.col("n") < F.lit(per_class) * F.lit(_RANGE).cast("double")).select(
        "doc_id", "label", F.pmod(F.xxhash64("doc_id", F.lit("place")), F.lit(PLACES)).cast("int").alias("place")
    )


def with_texts(docs: DataFrame, sample: DataFrame) -> DataFrame:
    """doc_id, label, place and whole text of the sampled rows, staged. The sample is bounded, so it is broadcast."""
    chosen = staged(sample, "sample")
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    return staged(texts.select("doc_id", "label", "place", "text"), "sampled_texts")
