from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from factloom.llm import hnsw
from factloom.llm.common import table
from pyspark.sql import functions as F

SCHEMA = "vec_id long, embedding array<double>, score string"


def brute(rows, k=5, every=50):
    usable = [(i, np.array(v, float)) for i, v, *_ in rows if i is not None and v and all(c is not None and np.isfinite(c) for c in v) and any(v)]
    out = {}
    for i, q in usable:
        if i % every == 0:
            top = sorted((-float((x * q).sum() / (np.sqrt((x * x).sum()) * np.sqrt((q * q).sum()))), j) for j, x in usable if j != i)[:k]
            out[i] = [(j, -s) for s, j in top]
    return out


def found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        assert r["rank"] == len(out.setdefault(r["query_id"], [])) + 1
        out[r["query_id"]].append((r["vec_id"], r["score"]))
    return out


def test_recall_on_the_given_table(spark, sf_dir):
    """At least 0.9 of the true neighbours, with scores that are exactly theirs and every query answered in full."""
    vectors = table(spark, sf_dir.replace("0.001", "0.1"), "embeddings")
    want = brute([(r["vec_id"], r["embedding"]) for r in vectors.collect()])
    for shard_rows in (4096, 500):
        got = found(hnsw.search(hnsw.index(vectors, shard_rows=shard_rows), vectors.where("vec_id % 50 = 0")))
        assert set(got) == set(want) and all(len(v) == 5 for v in got.values())
        assert sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want) >= 0.9 * 5 * len(want)
        scores = {(q, i): s for q, v in want.items() for i, s in v}
        assert all(abs(scores[q, i] - s) < 1e-12 for q, v in got.items() for i, s in v if (q, i) in scores)


def test_clusters_and_copies_stay_reachable():
    """Half of the rows are near copies of one vector, some equal ones besides: each is found from any."""
    draw = np.random.default_rng(3)
    near = draw.normal(size=16) + 1e-3 * draw.normal(size=(600, 16))
    x = np.concatenate([near, draw.normal(size=(600, 16)), np.repeat(draw.normal(size=(1, 16)), 50, axis=0)])
    ids = np.arange(len(x))
    row = next(hnsw._indexed((0,), pd.DataFrame({"id": ids, "v": list(x), "copies": 1})).itertuples())
    shard = hnsw._loaded(row)
    assert sorted(shard.ids.tolist()) == ids.tolist() and len(shard.vectors) == 1201
    want = brute([(int(i), v.tolist()) for i, v in zip(ids, x, strict=True)])
    got = {q: [i for _, i, _ in shard.nearest(x[q], q, 5, hnsw.EF_SEARCH)] for q in want}
    assert sum(len(set(got[q]) & {i for i, _ in want[q]}) for q in want) >= 0.9 * 5 * len(want)
    assert got[1200] == [1201, 1202, 1203, 1204, 1205]  # equal scores, smaller ids first


def test_levels_are_flat_arrays_of_neighbours():
    x = np.random.default_rng(4).normal(size=(700, 8))
    row = next(hnsw._indexed((3,), pd.DataFrame({"id": np.arange(700), "v": list(x), "copies": 1})).itertuples())
    shard = hnsw._loaded(row)
    assert row.shard == 3 and row.counts[0] == 700 and list(row.counts) == sorted(row.counts, reverse=True) and len(row.counts) > 1
    assert len(row.neighbours) == 700 * 2 * hnsw.LINKS + sum(row.counts[1:]) * hnsw.LINKS
    for n, links in zip(row.counts, shard.links, strict=True):
        assert links.max() < n and all(len(set(r[r >= 0])) == (r >= 0).sum() and i not in r for i, r in enumerate(links))
    again = next(hnsw._indexed((3,), pd.DataFrame({"id": np.arange(700), "v": list(x), "copies": 1})).itertuples())
    assert np.array_equal(row.neighbours, again.neighbours)


def test_odd_rows(spark):
    rows = [
        (0, [1.0, 0.0], "a"), (1, [2.0, 0.0], "a"), (2, [0.0, 1.0], None), (3, None, "a"), (4, [], "a"), (5, [0.0, 0.0], "a"), (6, [1.0, None], "a"),
        (7, [float("nan"), 1.0], "a"), (8, [float("inf"), 1.0], "a"), (None, [1.0, 0.0], "a"), (9, [-1.0, 0.0], "a"), (9, [-1.0, 0.0], "a"), (50, [1e200, 1e200], "b"), (100, [1e-200, 0.0], "b"),
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    got = found(hnsw.nearest(df, F.col("vec_id") % 50 == 0, k=10))
    half = 0.5**0.5
    close = lambda got, want: [i for i, _ in got] == [i for i, _ in want] and all(abs(a - b) < 1e-12 for (_, a), (_, b) in zip(got, want, strict=True))
    assert set(got) == {0, 50, 100}
    assert close(got[0], [(1, 1.0), (100, 1.0), (50, half), (2, 0.0), (9, -1.0), (9, -1.0)])  # fewer than k give all
    assert close(got[100], [(0, 1.0), (1, 1.0), (50, half), (2, 0.0), (9, -1.0), (9, -1.0)])
    assert [i for i, _ in found(hnsw.nearest(df, F.col("vec_id") == 0, k=5))[0]] == [1, 100, 50, 2, 9]


def test_empty_and_unlike(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert hnsw.nearest(empty, F.col("vec_id") % 50 == 0).collect() == []
    with pytest.raises(Exception, match="unlike lengths"):
        hnsw.nearest(spark.createDataFrame([(0, [1.0], "a"), (1, [1.0, 2.0], "b")], SCHEMA), F.col("vec_id") == 0).collect()


def test_queries_of_all_shards_stay_off_the_driver(spark):
    """Neither the graphs nor the queries, once for each shard, are broadcast; blocks meet every shard all the same."""
    draw = np.random.default_rng(5)
    rows = spark.createDataFrame([(i, x.tolist(), "a") for i, x in enumerate(draw.normal(size=(400, 8)))], SCHEMA)
    got = hnsw.search(hnsw.index(rows, shard_rows=40), rows.where("vec_id % 5 = 0"))
    assert "Broadcast" not in got._jdf.queryExecution().executedPlan().toString()
    want = brute([(r.vec_id, r.embedding) for r in rows.collect()], every=5)
    assert {q: [i for i, _ in v] for q, v in found(got).items()} == {q: [i for i, _ in v] for q, v in want.items()}
