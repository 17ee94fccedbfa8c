"""The registered queries and the pipeline on the smallest tables."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from compare import connect, difference
from hardwood.llm import exact_dedup, mixing, pieces, queries, simhash
from hardwood.llm.common import table

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", queries.SQL)
def test_query_matches_sql(spark, name):
    assert difference(spark, connect(SF_DIR), SF_DIR, queries.QUERIES[name], queries.SQL[name]) is None


def test_all_operators_are_registered():
    names = [*entry.queries()]
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 14)) and "pipeline" in names


def test_stages_keep_columns_and_their_decisions_hold(spark):
    docs = table(spark, SF_DIR, "documents")
    before = docs.collect()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        input_, docs = docs, exact_dedup.staged(stage(spark, docs, SF_DIR), "stage")
        rows = docs.collect()
        assert docs.columns == table(spark, SF_DIR, "documents").columns
        known = {r.doc_id: r for r in before}
        assert all(known[r.doc_id] == r for r in rows)
        texts = [(r.text or "").encode().lower() for r in rows]
        if name == "toxicity":
            bad = {r.doc_id for r in queries.op1_toxicity(spark, SF_DIR).filter("predicted = 1").collect()}
            assert {r.doc_id for r in rows} == {*known} - bad
        elif name == "exact_dedup":
            largest = {}
            for r in before:
                key = (r.text or "").encode().lower()
                largest[key] = max(largest.get(key, r.doc_id), r.doc_id)
            assert sorted(r.doc_id for r in rows) == sorted(largest.values())
        elif name == "simhash_near_dedup":
            prints = [simhash.fingerprint(r.text) for r in rows]
            assert all((a ^ b).bit_count() > 4 for i, a in enumerate(prints) for b in prints[:i])
            kept = {r.doc_id for r in rows}
            for r in before:  # what went is near something smaller
                assert r.doc_id in kept or any(
                    (simhash.fingerprint(r.text) ^ simhash.fingerprint(o.text)).bit_count() <= 4 for o in before if o.doc_id != r.doc_id
                )
        else:
            often = mixing.mix(input_, queries.domains(input_), queries.MIX_WEIGHTS, least=queries.LEAST_COPIES)[0].collect()
            assert Counter(r.doc_id for r in rows) == Counter({r.doc_id: r.copies for r in often}) and max(r.copies for r in often) > 1
        assert texts
        before = rows
    vocab = pieces.vocabulary(queries.tokenizer_file())
    by_id = {r.doc_id: r.text or "" for r in before}
    tokens = corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR).collect()
    assert len(tokens) == len(before)
    for r in tokens:
        assert r.ids == vocab.library.encode(by_id[r.doc_id], add_bos=True, add_eos=True) and r.n_tokens == len(r.ids) and r.round_trip


def test_run_applies_all_stages(spark):
    rows = corpus_pipeline.run(spark, SF_DIR).collect()
    assert rows and {len(r.ids) == r.n_tokens for r in rows} == {True}


def test_run_on_odd_tables(spark, tmp_path):
    """Empty documents; then null ids, texts and languages, repeated rows and clashing columns."""
    docs, labels = table(spark, SF_DIR, "documents"), table(spark, SF_DIR, "labels")
    labels.write.parquet(f"{tmp_path}/none/labels.parquet")
    docs.filter("false").write.parquet(f"{tmp_path}/none/documents.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/none").collect() == []
    odd = docs.limit(60).unionByName(docs.limit(2))
    odd = odd.unionByName(spark.createDataFrame([(None, None, None, None, None), (None, "no id", "en", "s", 1), (9001, None, "en", "s", 0), (9002, "", None, None, 0)], docs.schema))
    for name in ("kept", "mix_posterior", "mix_rate", "mix_one", "row_key", "fp", "recipe", "score", "copies"):
        odd = odd.withColumn(name, F.lit("clash"))
    odd.write.parquet(f"{tmp_path}/odd/documents.parquet")
    labels.write.parquet(f"{tmp_path}/odd/labels.parquet")
    rows = corpus_pipeline.run(spark, f"{tmp_path}/odd").collect()
    assert rows and all(r.round_trip for r in rows)
