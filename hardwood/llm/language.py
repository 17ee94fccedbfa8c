"""Language identification: averaged hashed subword embeddings, a linear softmax, calibrated rejection.

The model (``subwords``) is fitted in numpy on the driver, on whole texts of at most ``PER_LANGUAGE`` labelled
rows of each language, and applied to every whole text in one pass.

Defined results: a null text, or one without a letter, gets ``und`` and score 0;
``rejected`` marks predictions whose calibrated probability is below the threshold at
which 99 % of left-out texts were right; ties go to the language that sorts first;
repeated rows are each returned; without any labelled row all
predictions are ``und``; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hardwood.llm.common import batch_pass
from hardwood.llm.sampling import labelled_sample, with_texts
from hardwood.llm.subwords import SubwordModel, letters, pieces, train

PER_LANGUAGE = 300
#: Every so many sampled rows of a class is kept from training, for calibration.
LEFT_OUT = 5


def fit(docs: DataFrame, labels: DataFrame, per_class: int = PER_LANGUAGE) -> SubwordModel:
    """A model of the classes in ``labels`` (doc_id, label), from texts of ``docs``. The sample is read by the driver: it is bounded."""
    rows = with_texts(docs, labelled_sample(labels, "doc_id", F.col("label"), per_class)).collect()
    rows.sort(key=lambda r: (r.label, r.place, r.text or ""))
    names = sorted({r.label for r in rows})
    examples, left_out = [], []
    for r in rows:
        (left_out if r.place % LEFT_OUT == 0 else examples).extend((names.index(r.label), p) for p in pieces(r.text))
    return train(names, examples, left_out)


def predict(docs: DataFrame, model: SubwordModel) -> DataFrame:
    """doc_id, lang_pred, score and rejected of every row."""

    def make():
        memory: dict = {}

        def step(batch: pa.RecordBatch):
            texts = batch.column(1).to_pylist()
            names, scores, rejected = [], [], []
            for text, given in zip(texts, model.probabilities(texts, memory) if model.names else [None] * len(texts)):
                known = given is not None and bool(letters(text))
                names.append(model.names[int(np.argmax(given))] if known else "und")
                scores.append(float(given.max()) if known else 0.0)
                rejected.append(not known or scores[-1] < model.threshold)
            yield pa.record_batch(
                [batch.column(0), pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(rejected, pa.bool_())],
                ["doc_id", "lang_pred", "score", "rejected"],
            )

        return step

    return batch_pass(docs.select("doc_id", "text"), "doc_id long, lang_pred string, score double, rejected boolean", make)
