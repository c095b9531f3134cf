from __future__ import annotations

import importlib

import pyarrow.parquet as pq

from factloom.llm import toxicity
from tests_llm_reference import brute_pipeline


def test_stages_against_a_plain_run(spark, tmp_path):
    pipeline = importlib.import_module("corpus_pipeline")
    sf = "/root/testdata/sf0.001"
    docs = pq.read_table(f"{sf}/documents.parquet").to_pylist()
    bench = pq.read_table(f"{sf}/benchmark.parquet").to_pylist()
    model = toxicity.fit(spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet"))
    want = brute_pipeline(docs, bench, model)
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in pipeline.run(spark, sf).collect()}
    assert got == want
    assert [n for n, _ in pipeline.STAGES][0] == "toxicity" and len(pipeline.STAGES) == 5


def test_stages_keep_the_columns(spark):
    pipeline = importlib.import_module("corpus_pipeline")
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for _, stage in pipeline.STAGES[:-1]:
        assert stage(spark, docs, sf).columns == docs.columns
