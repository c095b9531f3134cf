from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from factloom.llm import topk


def brute(rows, is_query, k):
    """All scores of every query, in whole numbers."""
    good = [(i, [int(np.floor(256 * float(np.float32(c)))) for c in v]) for i, v in rows if i is not None and v and all(c is not None and np.isfinite(c) for c in v)]
    out = []
    for q, x in good:
        if is_query(q):
            scored = sorted((-sum(a * b for a, b in zip(x, y, strict=True)), i) for i, y in good if i != q)[:k]
            out += [(q, r, i, -s) for r, (s, i) in enumerate(scored, 1)]
    return sorted(out)


def got(df):
    return sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in df.collect())


def test_exact_with_ties(spark, monkeypatch):
    monkeypatch.setattr(topk, "CANDIDATE_BLOCK", 64)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 7)
    monkeypatch.setattr(topk, "STEP", 8)
    monkeypatch.setattr(topk, "GROUP", 1)
    monkeypatch.setattr(topk, "PIVOT_SAMPLE", 50)
    rng = np.random.default_rng(0)
    vectors = [v.tolist() for v in rng.normal(0, 0.2, (300, 12)).astype(np.float32)]
    vectors[40:140] = [vectors[7]] * 100  # a common vector: ties by id
    rows = [(i, v) for i, v in enumerate(vectors)]
    rows += [(400, None), (450, [float("nan")] * 12), (500, [None] + [0.1] * 11), (550, [float("inf")] * 12), (None, vectors[0])]
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<float>, score string").repartition(3)
    assert got(topk.top_k(df, F.col("vec_id") % 50 == 0)) == brute(rows, lambda i: i % 50 == 0, 5)


def test_few_rows(spark):
    df = spark.createDataFrame([(0, [1.0, 2.0]), (1, [0.5, 0.5])], "vec_id long, embedding array<float>")
    assert got(topk.top_k(df, F.col("vec_id") % 50 == 0)) == [(0, 1, 1, 256 * 128 + 512 * 128)]
    assert topk.top_k(df.limit(0), F.col("vec_id") % 50 == 0).count() == 0
    assert topk.top_k(df.where("vec_id = 0"), F.col("vec_id") % 50 == 0).count() == 0


def test_bounds_hold_and_large_values_stay_exact():
    rng = np.random.default_rng(1)
    for scale in (1, 10**6, 10**8):
        rows = np.floor(rng.normal(0, 50, (200, 9)) * scale)
        pivots = topk.choose_pivots(rows[:50], 8)
        known = [top[-1][1] for _, top, *_ in topk.best(rows[:5], np.arange(5), rows[100:150], np.arange(100, 150), pivots, 5)]
        some = topk.best(rows[:5], np.arange(5), rows, np.arange(200), pivots, 5, known)
        found = [(q, i, s) for q, top, *_ in topk.best(rows[:5], np.arange(5), rows, np.arange(200), pivots, 5) for i, s in top]
        assert found == [(q, i, s) for q, top, *_ in some for i, s in top]
        want = []
        for q in range(5):
            scored = sorted((-sum(int(a) * int(b) for a, b in zip(rows[q], rows[i], strict=True)), i) for i in range(200) if i != q)[:5]
            want += [(q, i, -s) for s, i in scored]
        assert found == want


def test_far_blocks_are_passed_over():
    """Two clusters: a query of one evaluates nothing of the other, and little of its own."""
    rng = np.random.default_rng(4)
    near, far = (np.floor(c + rng.normal(0, 3, (400, 8))) for c in (100, -100))
    pivots = topk.choose_pivots(np.concatenate([near[:20], far[:20]]), 8)
    known = [top[-1][1] for _, top, *_ in topk.best(near[:3], np.arange(3), near[100:200], np.arange(100, 200), pivots, 5)]
    assert [x[1:] for x in topk.best(near[:3], np.arange(3), far, np.arange(1000, 1400), pivots, 5, known)] == [([], 0, 400)] * 3


def test_clusters_are_neither_shuffled_nor_evaluated(spark):
    """Of forty clusters a query meets its own and few others."""
    rng = np.random.default_rng(6)
    middle = rng.normal(0, 1, (40, 8))
    middle /= np.linalg.norm(middle, axis=1, keepdims=True)
    rows = [(i, (middle[i % 40] + rng.normal(0, 0.01, 8)).tolist()) for i in range(4000)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    search = topk.Search(df, F.col("vec_id") % 50 == 0, 5, "vec_id", "embedding", 256.0, 64)
    found = search.found()
    sent = {(r["cell"], r["part"], r["q_ids"]) for r in search.begun.where("part is not null").collect()}
    pairs = sum(len(q) // 8 for _, _, q in sent)  # queries sent to a block
    assert pairs < 0.1 * 80 * search.blocks.count()
    assert 80 * 5 <= found.agg(F.sum("evaluated")).first()[0] < 0.1 * 80 * 3999
    assert got(topk.top_k(df, F.col("vec_id") % 50 == 0)) == sorted((q, r, i, -s) for q in range(0, 4000, 50) for r, (s, i) in enumerate(_scored(rows, q), 1))


def _scored(rows, q):
    x = np.floor(256 * np.array([v for _, v in rows]))
    return sorted((-int(s), i) for i, s in enumerate(x @ x[q]) if i != q)[:5]


def test_work_and_errors(spark):
    rng = np.random.default_rng(2)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.normal(0, 1, (300, 4)))]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    seen = topk.work(df, F.col("vec_id") % 50 == 0).first()
    assert seen["candidates"] == 6 * 299 and 0 < seen["evaluated"] < seen["candidates"]
    large = spark.createDataFrame([(0, [1e15, 1.0]), (1, [1e15, 1.0])], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="64 bits"):
        topk.top_k(large, F.col("vec_id") % 50 == 0).collect()
    with pytest.raises(Exception, match="unlike lengths"):
        topk.top_k(spark.createDataFrame([(0, [1.0]), (1, [1.0, 2.0])], "vec_id long, embedding array<double>"), F.col("vec_id") % 50 == 0).collect()
