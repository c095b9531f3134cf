from __future__ import annotations

import math
import random
import zlib

import numpy as np
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from factloom.llm import toxicity


def test_risk_learns_from_positive_and_unlabelled():
    rng = random.Random(0)
    neutral, bad = [f"word{i}x" for i in range(300)], ["vilething", "nastyword", "fouleries"]

    def doc(toxic):
        words = rng.choices(neutral, k=40)
        return toxicity.document_features(" ".join([*words, *(rng.choices(bad, k=3) if toxic else [])]))

    positive, unlabelled = [doc(True) for _ in range(200)], [doc(i % 10 == 0) for i in range(1000)]
    model = toxicity.train(positive, unlabelled, 0.1)
    dense = model.dense()
    score = lambda f: dense[f].sum() + model.bias
    toxic, clean = [score(doc(True)) for _ in range(200)], [score(doc(False)) for _ in range(200)]
    assert np.mean([t > c for t in toxic for c in clean]) > 0.98


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    rows = toxicity.score(docs, labels).join(labels, "doc_id").where("held_out").collect()
    y, s = np.array([r.toxic for r in rows]), np.array([r.score for r in rows])
    order = np.argsort(s, kind="stable")
    rank = np.empty(len(s))
    rank[order] = np.arange(1, len(s) + 1)
    auc = (rank[y == 1].sum() - y.sum() * (y.sum() + 1) / 2) / (y.sum() * (len(y) - y.sum()))
    predicted = np.array([r.predicted for r in rows])
    precision, recall = (predicted & y).sum() / max(1, predicted.sum()), (predicted & y).sum() / y.sum()
    print("held out", len(y), y.sum(), auc, precision, recall)
    assert auc > 0.9 and precision > 0.85 and recall > 0.75
    assert all(r.predicted == (r.score >= 0.7) and 0 <= r.score <= 1 for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)


def test_labels_of_the_held_out_fold_change_nothing(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    other = labels.withColumn("toxic", F.when(toxicity.held_out("doc_id"), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = toxicity.fit(docs, labels), toxicity.fit(docs, other)
    assert np.array_equal(a.weight, b.weight) and a.bias == b.bias


def test_cases(spark):
    docs = spark.createDataFrame([(1, None, 0.5), (None, "x y", 0.5), (2, "", 0.5), (2, "", 0.5), (3, "longword " * 30_000, None)], "doc_id long, text string, score double")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    rows = toxicity.score(docs, none).collect()
    assert len(rows) == 5 and not any(r.predicted for r in rows) and not any(r.score is None for r in rows)
    assert toxicity.score(docs.limit(0), none).count() == 0
    assert toxicity.keep_clean(docs, none).columns == docs.columns
    assert pq is not None


def _labelled(spark, toxic, n=60, labelled=None):
    rng = random.Random(4)
    neutral = [f"word{chr(97 + i % 26)}{chr(97 + i // 26)}x" for i in range(300)]
    texts = [" ".join([*rng.choices(neutral, k=30), *(["vilething", "nastyword"] if i in toxic else [])]) for i in range(n)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return docs, spark.createDataFrame([(i, int(i in toxic)) for i in (labelled or range(n))], "doc_id long, toxic int")


def test_few_toxic_labels_reject_nothing(spark):
    trained = [i for i in range(60) if zlib.crc32(str(i).encode()) % 3 != 1]
    for toxic in (trained[:1], trained[:2]):
        docs, labels = _labelled(spark, set(toxic), labelled=trained[:30])
        assert not any(r.predicted for r in toxicity.score(docs, labels).collect())
        assert toxicity.keep_clean(docs, labels).count() == docs.count()


def test_labels_of_every_document_still_train(spark):
    toxic = set(range(0, 60, 4))
    docs, labels = _labelled(spark, toxic)
    assert {r.doc_id for r in toxicity.score(docs, labels).collect() if r.predicted} == toxic


def test_a_model_that_scores_all_alike_is_not_calibrated():
    for index, weight, x in (([], [], np.zeros((2, 0))), ([7], [1.5], np.zeros((2, 1)))):
        model = toxicity.Classifier(np.array(index, np.int32), np.array(weight), -20.0)
        assert toxicity.calibrate(model, x, np.array([1, 0])) is model


def plain_risk(w, b, xp, xu, prior):
    """The non-negative risk by loops: (risk, second term, both terms apart)."""
    loss = lambda x, y: 1 / (1 + math.exp(y * (sum(a * c for a, c in zip(x, w, strict=True)) + b)))
    p_plus, p_minus = sum(loss(x, 1) for x in xp) / len(xp), sum(loss(x, -1) for x in xp) / len(xp)
    rest = sum(loss(x, -1) for x in xu) / len(xu) - prior * p_minus
    return prior * p_plus + max(0.0, rest), rest


def test_risk_and_its_gradient_match_a_plain_computation():
    rng = np.random.default_rng(5)
    for prior, signs in ((0.1, {True}), (0.9, {True, False})):
        seen = set()
        for _ in range(60):
            xp, xu = rng.integers(0, 2, (7, 4)).astype(float), rng.integers(0, 2, (11, 4)).astype(float)
            w, b = rng.normal(size=4) * 2, float(rng.normal())
            if prior == 0.9:
                xp[:], xu[:, 0] = 1, 0  # P alone has the first feature, so its part of U is overrated
                w[0] = 6
            value, rest, step = toxicity.risk(w, b, xp, xu, prior)
            want, plain_rest = plain_risk(w, b, xp, xu, prior)
            assert abs(value - want) < 1e-9 and abs(rest - plain_rest) < 1e-9
            # The step is the slope of the risk, or against that of the second term where that is negative.
            of = lambda z: plain_risk(z[:4], z[4], xp, xu, prior)
            at, slope = np.append(w, b), np.zeros(5)
            for i in range(5):
                h = np.zeros(5)
                h[i] = 1e-5
                slope[i] = (of(at + h)[0] - of(at - h)[0]) / 2e-5 if rest > 0 else -(of(at + h)[1] - of(at - h)[1]) / 2e-5
            if abs(rest) > 1e-4:
                assert np.allclose(step, slope, atol=1e-6)
                seen.add(rest > 0)
        assert seen <= {True, False} and seen & signs


def test_documents_and_counts_train_the_same_model(spark):
    """What is counted and collected by Spark gives the model of plain lists."""
    toxic = set(range(0, 60, 4))
    docs, labels = _labelled(spark, toxic)
    trained = [i for i in range(60) if zlib.crc32(str(i).encode()) % 3 != 1]
    rows = {r.doc_id: toxicity.document_features(r.text) for r in docs.collect()}
    order = {r.doc_id: r.h for r in docs.select("doc_id", F.xxhash64("doc_id").alias("h")).collect()}
    trained.sort(key=order.get)
    prior = sum(i in toxic for i in trained) / len(trained)
    plain = toxicity.train([rows[i] for i in trained if i in toxic], [rows[i] for i in trained], prior)
    plain = toxicity.calibrate(plain, np.array([toxicity.held(rows[i], plain.index) for i in trained]), np.array([int(i in toxic) for i in trained]))
    model = toxicity.fit(docs, labels)
    assert np.array_equal(model.index, plain.index) and np.allclose(model.weight, plain.weight) and abs(model.bias - plain.bias) < 1e-9


def test_clashing_columns_and_repeated_ids(spark):
    toxic = set(range(0, 60, 4))
    docs, labels = _labelled(spark, toxic)
    clash = docs.unionByName(docs).unionByName(docs.where("doc_id = 0")).selectExpr("*", "1 as parts", "2 as id", "3 as toxic", "4 as x", "5 as f", "text as part")
    rows = toxicity.score(clash, labels.selectExpr("*", "0 as id", "1 as parts")).collect()
    assert len(rows) == 121 and {r.doc_id for r in rows if r.predicted} == toxic
    assert toxicity.keep_clean(clash, labels).columns == clash.columns
