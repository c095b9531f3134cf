"""Toxicity by non-negative positive-unlabelled learning.

A linear classifier on hashed features of a document's words (the word and its leading characters) is trained in numpy
from confirmed toxic documents (P) and text whose labels are not used (U, drawn from all documents outside of the
held-out fold, labelled or not, so that U is distributed as all documents are). With class prior pi the risk is
pi * R_p(+1) + max(0, R_u(-1) - pi * R_p(-1)) under the sigmoid loss; where the second term is negative the step goes
the other way, as the non-negative estimator asks. pi is the share of toxic documents among the labelled ones of the
training folds; it stands for the share among all documents, from which the labelled ones are taken to be drawn at
random. Labels 0 are used for the prior and for placing the cut, never as training examples. Labels are read only from
rows outside of the held-out fold.

The classifier is fitted on bounded samples (MAX_POSITIVE, MAX_UNLABELLED, MAX_CALIBRATION documents, taken in the
order of a hash of their id, whole texts); scoring runs over every row. What reaches the driver is bounded whatever the
texts hold: two counts for each of DIMENSIONS features, and SCREENED bits for each sampled document.

Cases: a null or empty text has no words and gets the score of that; without a confirmed toxic document in the training
folds, or where too few of them (under LEAST_POSITIVE) share any feature, nothing is learnt, every score is near 0 and
no document is rejected; a null id is never labelled, and is not held out; labels that repeat an id count as toxic if
one of them is; of rows that share a sampled id one is learnt from (the smallest text by hash); repeated rows score
alike; an empty table gives an empty table; other columns are kept by `keep_clean` and ignored by `score`.
"""

from __future__ import annotations

import re
import zlib
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factloom.llm.common import materialise, settle

MAX_POSITIVE, MAX_UNLABELLED, MAX_CALIBRATION = 3000, 6000, 3000
DIMENSIONS = 1 << 18
#: Features kept for training: those whose share of P most exceeds their share of U.
SCREENED = 3000
LEAST_POSITIVE, LEAST_GAIN = 3, 4
THRESHOLD = 0.7
WORD = re.compile(r"[^\W\d_]+")
PREFIXES = (4, 5, 6)
CACHE_ENTRIES = 100_000


def features(word: str) -> tuple[int, ...]:
    """Hashed features of a lower-case word: itself and its leading characters."""
    names = [f"={word}", *(f"^{word[:k]}" for k in PREFIXES if len(word) > k)]
    return tuple(zlib.crc32(n.encode("utf-8", "replace")) % DIMENSIONS for n in names)


def document_features(text: str | None) -> np.ndarray:
    """Distinct features of a whole text."""
    words = set(WORD.findall((text or "").lower()))
    return np.unique(np.fromiter((f for w in words for f in features(w)), np.int32))


class Classifier:
    """weight of each hashed feature, bias; score = sigmoid(bias + sum of the weights of the distinct features)."""

    def __init__(self, index: np.ndarray, weight: np.ndarray, bias: float):
        self.index, self.weight, self.bias = index, weight, bias

    def dense(self) -> np.ndarray:
        out = np.zeros(DIMENSIONS)
        out[self.index] = self.weight
        return out


def screen(in_p: np.ndarray, n_p: int, in_u: np.ndarray, n_u: int) -> np.ndarray:
    """The features to learn from, ascending: those that more of P hold than of U, by the excess over what chance makes.

    in_p, in_u: how many documents of P and of U hold each feature. A feature that toxic text has no more often than
    other text tells nothing that the risk could use."""
    share_p, share_u = in_p / max(1, n_p), (in_u + 0.5) / (n_u + 1)
    gain = np.where(in_p >= LEAST_POSITIVE, (share_p - share_u) / np.sqrt(share_u * (1 - np.minimum(share_u, 0.999)) / max(1, n_p)), -np.inf)
    best = np.argsort(-gain, kind="stable")[:SCREENED]
    return np.sort(best[gain[best] > LEAST_GAIN]).astype(np.int32)


def risk(w: np.ndarray, b: float, xp: np.ndarray, xu: np.ndarray, prior: float) -> tuple[float, float, np.ndarray]:
    """(non-negative risk, its second term before the cut at 0, direction of the step: weights, then bias)."""
    sigmoid = lambda z: 1 / (1 + np.exp(-np.clip(z, -30, 30)))
    gu, gp = sigmoid(xu @ w + b), sigmoid(xp @ w + b)  # the loss of -1; that of +1 is 1 - it
    slope = lambda x, g: np.append(x.T @ (g * (1 - g)), (g * (1 - g)).sum()) / len(x)
    rest = float(gu.mean() - prior * gp.mean())
    positive, negative = -prior * slope(xp, gp), slope(xu, gu) - prior * slope(xp, gp)
    return float(prior * (1 - gp).mean()) + max(0.0, rest), rest, positive + negative if rest >= 0 else -negative


def minimise(xp: np.ndarray, xu: np.ndarray, prior: float, epochs: int = 40, batch: int = 512, rate: float = 0.05, decay: float = 2e-4, seed: int = 3) -> tuple[np.ndarray, float]:
    """(weights, bias) that Adam finds over mini-batches of both; weights shrink towards 0 by `decay` each step (L1)."""
    rng = np.random.default_rng(seed)
    w, b = np.zeros(xp.shape[1]), -1.0
    m, v, t = np.zeros(len(w) + 1), np.zeros(len(w) + 1), 0
    steps = max(1, len(xu) // batch)
    for _ in range(epochs):
        pu, pp = rng.permutation(len(xu)), rng.permutation(len(xp))
        for s in range(steps):
            u, p = xu[pu[s::steps]].astype(np.float64), xp[pp[s::steps] if len(xp) >= steps else pp].astype(np.float64)
            grad = risk(w, b, p, u, prior)[2]
            t += 1
            m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
            step = rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
            w, b = w - step[:-1], b - step[-1]
            w = np.sign(w) * np.maximum(np.abs(w) - decay, 0)
    return w, float(b)


def train(positive: list[np.ndarray], unlabelled: list[np.ndarray], prior: float) -> Classifier:
    """The classifier of documents given by their features."""
    counts = [np.bincount(np.concatenate([*rows, np.zeros(0, np.int32)]).astype(np.int64), minlength=DIMENSIONS) for rows in (positive, unlabelled)]
    index = screen(counts[0], len(positive), counts[1], len(unlabelled))
    if not len(index) or not unlabelled:
        return unlearnt()
    w, b = minimise(*(np.array([held(r, index) for r in rows]) for rows in (positive, unlabelled)), prior)
    return Classifier(index, w, b)


def held(features_: np.ndarray, index: np.ndarray) -> np.ndarray:
    """Which of the features of the index a document has."""
    return np.isin(index, features_).astype(np.uint8)


def unlearnt() -> Classifier:
    """Scores everything near 0."""
    return Classifier(np.zeros(0, np.int32), np.zeros(0), -20.0)


def calibrate(model: Classifier, x: np.ndarray, toxic: np.ndarray) -> Classifier:
    """Scales the logit so that the cut of the best F1 on labelled training rows lies at THRESHOLD; a model that scores
    them all alike has no cut and stays as it is. x: which features of the model each row has."""
    if not len(x) or not toxic.any() or not len(model.index):
        return model
    z = x @ model.weight + model.bias
    if z.min() == z.max():
        return model
    order = np.argsort(-z, kind="stable")
    hits = np.cumsum(toxic[order])
    f1 = 2 * hits / (np.arange(1, len(z) + 1) + toxic.sum())
    ends = np.append(z[order][1:] < z[order][:-1], True)  # a cut cannot part equal scores
    k = int(np.where(ends, f1, -1).argmax())
    below = z[order][k + 1] if k + 1 < len(z) else z[order][k] - 1
    cut = (z[order][k] + below) / 2
    spread = max(1e-6, float(np.std(z)))
    return Classifier(model.index, model.weight / spread, (model.bias - cut) / spread + float(np.log(THRESHOLD / (1 - THRESHOLD))))


def held_out(id_col: str) -> Column:
    """crc32 of the id as text has the remainder 1 modulo 3; a null id is not held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 3 == 1, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Classifier:
    """The calibrated classifier of docs and labels (id, toxic)."""
    given = labels.select(F.col(id_col).alias("id"), F.col("toxic").cast("int").alias("toxic")).where(F.col("id").isNotNull() & F.col("toxic").isNotNull() & ~held_out("id"))
    own = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where(F.col("id").isNotNull() & ~held_out("id"))
    names = own.select("id").distinct()
    known = given.groupBy("id").agg(F.max("toxic").alias("toxic")).join(names, "id", "left_semi")
    share = known.agg(F.avg("toxic")).first()[0] or 0.0
    pick = F.xxhash64(F.lit(11), "id")
    chosen = [
        known.where("toxic = 1").orderBy(pick, "id").limit(MAX_POSITIVE).select("id", F.lit("p").alias("part"), F.lit(1).alias("toxic")),
        names.orderBy(pick, "id").limit(MAX_UNLABELLED).select("id", F.lit("u").alias("part"), F.lit(0).alias("toxic")),
        known.orderBy(pick, "id").limit(MAX_CALIBRATION).select("id", F.lit("c").alias("part"), "toxic"),
    ]
    sample = chosen[0].unionByName(chosen[1]).unionByName(chosen[2])  # bounded by the three parameters
    parts = sample.groupBy("id").agg(F.collect_list(F.struct("part", "toxic")).alias("parts"))
    texts = own.join(F.broadcast(parts.select("id")), "id").groupBy("id").agg(F.min(F.struct(F.xxhash64("text"), "text")).alias("x"))
    found = F.pandas_udf(lambda t: pd.Series([document_features(x) for x in t], dtype=object), "array<int>")
    rows = materialise(texts.join(parts, "id").select("id", "parts", found(F.col("x.text")).alias("f")), "toxicity-sample")

    def count(part: str) -> tuple[np.ndarray, int]:
        """How many documents of a part hold each feature, and their number."""
        of = rows.where(F.exists("parts", lambda x: x["part"] == part))
        counted = of.select(F.explode("f").alias("f")).groupBy("f").agg(F.count("*").alias("n")).toPandas()  # at most DIMENSIONS rows
        out = np.zeros(DIMENSIONS)
        out[counted["f"].to_numpy(np.int64)] = counted["n"]
        return out, of.count()

    (in_p, n_p), (in_u, n_u) = count("p"), count("u")
    index = screen(in_p, n_p, in_u, n_u)
    if not len(index) or not n_u:
        return unlearnt()
    bits = F.pandas_udf(lambda f: pd.Series([np.packbits(held(x, index)).tobytes() for x in f], dtype=object), "binary")
    held_by = rows.select(F.xxhash64("id").alias("at"), "id", "parts", bits("f").alias("bits")).collect()  # bounded: SCREENED bits a row
    held_by.sort(key=lambda r: (r["at"], str(r["id"])))
    of = {part: [(r["bits"], x["toxic"]) for r in held_by for x in r["parts"] if x["part"] == part] for part in "puc"}
    matrix = lambda part: np.array([np.unpackbits(np.frombuffer(x, np.uint8), count=len(index)) for x, _ in of[part]], np.uint8).reshape(-1, len(index))
    w, b = minimise(matrix("p"), matrix("u"), float(share))
    return calibrate(Classifier(index, w, b), matrix("c"), np.array([y for _, y in of["c"]], int))


@lru_cache(1)
def _scorer(index: bytes, weight: bytes):
    dense = np.zeros(DIMENSIONS)
    dense[np.frombuffer(index, np.int32)] = np.frombuffer(weight)
    return dense, {}


def score_column(model: Classifier, text: Column) -> Column:
    """Score from 0 to 1 of a whole text."""
    index, weight, bias = model.index.astype(np.int32).tobytes(), model.weight.astype(np.float64).tobytes(), model.bias

    @F.pandas_udf("double")
    def run(texts: pd.Series) -> pd.Series:
        settle()
        dense, live = _scorer(index, weight)  # live: the weighted features of a word
        out = []
        for text in texts:
            seen: set[int] = set()
            for w in set(WORD.findall((text or "").lower())):
                own = live.get(w)
                if own is None:
                    if len(live) >= CACHE_ENTRIES:
                        live.clear()
                    own = live[w] = tuple(f for f in features(w) if dense[f])
                if own:
                    seen.update(own)
            out.append(bias + sum(dense[f] for f in sorted(seen)))
        return pd.Series(1 / (1 + np.exp(-np.clip(np.array(out, float), -30, 30))))

    return run(text)


def score(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: Classifier | None = None) -> DataFrame:
    """One row per input row: id, held_out, score, predicted."""
    model = model or fit(docs, labels, id_col, text_col)
    scored = docs.select(F.col(id_col), held_out(id_col).alias("held_out"), score_column(model, F.col(text_col)).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def keep_clean(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: Classifier | None = None) -> DataFrame:
    """The rows of docs whose score is below the threshold, all columns."""
    model = model or fit(docs, labels, id_col, text_col)
    return docs.where(score_column(model, F.col(text_col)) < THRESHOLD)
