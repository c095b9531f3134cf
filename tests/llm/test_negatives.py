from __future__ import annotations

import math
import random

import numpy as np
import pytest
from factloom.llm import negatives
from pyspark.sql import functions as F

SCHEMA = "vec_id long, embedding array<double>, label int, score string"


def brute(rows, n_positives=5, n_negatives=3, every=50, scale=256):
    use = [(i, y, [math.floor(scale * c) for c in v]) for i, v, y, *_ in rows if i is not None and y is not None and v and all(c is not None and math.isfinite(c) for c in v)]
    out = []
    for a, label, q in {(i, y, tuple(v)) for i, y, v in use if i % every == 0}:
        scored = sorted((-sum(p * c for p, c in zip(q, v, strict=True)), i, y) for i, y, v in use if i != a)
        for s, i, _ in [x for x in scored if x[2] == label][:n_positives]:
            fits = [(n, j) for n, j, y in scored if y != label and 50 * -s <= 100 * -n <= 95 * -s]
            out += [(a, i, r, j, -s, -n) for r, (n, j) in enumerate(fits[:n_negatives], 1)]
    return sorted(out)


def found(df):
    return sorted((r["anchor_id"], r["positive_id"], r["rank"], r["negative_id"], r["positive_score"], r["negative_score"]) for r in df.collect())


def run(spark, rows, **more):
    return found(negatives.hard_negatives(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 50 == 0, F.col("label"), **more))


@pytest.mark.parametrize("spread", [1.0, 0.05])
def test_equals_brute_force(spark, spread):
    """Noise and clusters, in shards of a few leaves."""
    assert negatives.LEAF < 700
    draw = np.random.default_rng(int(spread * 100))
    middle = draw.normal(size=(12, 6)) / 2
    rows = [(int(i), (middle[i % 12] + spread * draw.normal(size=6)).tolist(), int(draw.integers(4)), "x") for i in range(3000)]
    want = brute(rows)
    assert len(want) > 100
    assert run(spark, rows, shard_rows=1500) == want


def test_ties_copies_and_rows_that_take_no_part(spark):
    draw = random.Random(5)
    rows = [(i, [draw.choice([0.0, 0.5, 1.0]) for _ in range(3)], draw.choice([0, 1, None]), "x") for i in range(200)]
    rows += rows[40:60] + [(0, [1.0, 1.0, 1.0], 1, "again"), (300, None, 1, ""), (301, [], 1, ""), (302, [1.0, None, 1.0], 1, ""), (303, [float("nan"), 1.0, 1.0], 1, ""), (None, [1.0, 1.0, 1.0], 1, ""), (350, [-1.0, -1.0, -1.0], 0, "")]
    want = brute(rows)
    assert want
    assert run(spark, rows) == want


def test_pruning_on_clusters(monkeypatch):
    """A window inside of a cluster is found without scoring most rows."""
    draw = np.random.default_rng(1)
    middle = draw.normal(size=(64, 8)) * 100
    x = np.repeat(middle, 64, axis=0) + draw.normal(size=(4096, 8))
    x = np.floor(1000 * x / np.linalg.norm(x, axis=1, keepdims=True))
    monkeypatch.setattr(negatives, "LEAF", 32)
    nodes, spans, order = negatives.grown(x)
    labels = np.array([str(i % 3) for i in range(4096)], object)
    tree = negatives.Tree(nodes, spans, x[order], order, labels[order], np.ones(4096, np.int64))
    scored = 0
    for q in range(0, 4096, 512):
        search = negatives.Search(tree, x[q], q, labels[q])
        top = search.first(3, False)
        want = sorted((-int(x[i] @ x[q]), i) for i in range(4096) if labels[i] != labels[q])[:3]
        assert [(-s, i) for s, i, _ in top] == want
        scored += search.scored
    assert scored < 0.25 * 8 * 4096


def test_large_values_and_errors(spark):
    assert run(spark, [(0, [2.0**40, 1.0], 0, ""), (1, [1.0, 2.0], 0, ""), (2, [0.75, 2.0], 1, "")], scale=1.0) == brute([(0, [2.0**40, 1.0], 0), (1, [1.0, 2.0], 0), (2, [0.75, 2.0], 1)], scale=1)
    with pytest.raises(Exception, match="64 bits"):
        run(spark, [(0, [2.0**60], 0, ""), (1, [2.0**60], 0, "")])
    with pytest.raises(Exception, match="unlike lengths"):
        run(spark, [(0, [1.0], 0, ""), (1, [1.0, 2.0], 0, "")])
    assert run(spark, []) == []
