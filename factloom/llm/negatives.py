"""Hard negatives from vantage-point trees over norm-augmented vectors.

A vector x becomes (x, sqrt(M^2 - |x|^2)) with M^2 the largest |x|^2 of its shard, an anchor q becomes (q, 0), so
distance^2 = |q|^2 + M^2 - 2 <q, x>: the nearest row has the highest inner product, and a window of scores is an annulus
of distances. A tree's node holds a vantage row and parts its rows at the median distance from it; a leaf holds LEAF
rows. For each child the tree keeps the least and largest distance of its rows from the vantage row, so that by the
triangle inequality the anchor's distance from the vantage row bounds that of all rows below from both sides.

The traversal is incremental and nearest-first: a heap holds nodes by the highest score that their lower bound leaves
and rows by their score, and what lies wholly outside of the annulus is never entered. A row that comes off the heap is
the next of the result, so the traversal ends with the k-th. Bounds are in doubles with room for rounding, scores are
exact whole numbers, and each row is tested by its score. A first traversal without annulus over rows of the anchor's label gives its positives, one for
each positive gives the negatives; the traversals of an anchor share the distances and scores they have worked out.

Rows are dealt to shards of about SHARD_ROWS by a hash, a tree each, and anchors meet every shard in blocks. Positives
are merged over the shards before their windows are searched, negatives after.

Cases: rows with a null id, a null label or a vector that is null, empty or holds null or non-finite components take no
part; a row is never a positive or negative of its own id; repeated rows are candidates each, repeated anchors give the
same rows once; ties go to the smaller id; a positive with a negative score has an empty window; an anchor without
positives, or whose windows hold nothing, has no row; an empty table gives none; vectors of unlike lengths, and scores
beyond 64 bits, raise an error; other columns are not looked at.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from factloom.llm.common import materialise
from factloom.llm.topk import inner, valid

SHARD_ROWS = 8192
LEAF = 512
ANCHOR_BLOCK = 512
#: A negative's score in percent of the positive's.
LOW, HIGH = 50, 95
TREES = "shard int, dim int, nodes array<int>, spans array<double>, vectors array<double>, ids array<bigint>, labels array<string>, copies array<bigint>"


@dataclass
class Tree:
    """nodes: (vantage row, inner child, outer child) for each inner node, or (-1, first row, row after the last) for a
    leaf; spans: the least and largest distance of the rows of either child from the vantage row. Rows stand in the order
    of the leaves, in a leaf by id; vantage rows are among them."""

    nodes: np.ndarray
    spans: np.ndarray
    rows: np.ndarray
    ids: np.ndarray
    labels: np.ndarray
    copies: np.ndarray

    def __post_init__(self):
        self.square = (self.rows * self.rows).sum(axis=1)
        self.reach = self.square.max(initial=0)
        self.height = self.reach - self.square  # of the added component, squared
        self.largest = float(np.abs(self.rows).max(initial=0))
        self.steps = [(*n, *s) for n, s in zip(self.nodes.tolist(), self.spans.tolist(), strict=True)]
        names, self.codes = np.unique(self.labels.astype(str), return_inverse=True)
        self.code_of = {name: code for code, name in enumerate(names.tolist())}


def grown(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(nodes, spans, order of the rows) of a tree over rows."""
    square = (rows * rows).sum(axis=1)
    high = np.sqrt(np.maximum(square.max(initial=0) - square, 0))
    lifted = np.column_stack([rows, high])
    nodes: list[list[int]] = []
    spans: list[list[float]] = []
    order: list[np.ndarray] = []
    todo = [(np.arange(len(rows)), -1, 0)]  # rows, parent, side
    filled = 0
    vantages: dict[int, int] = {}
    while todo:
        own, parent, side = todo.pop()
        at = len(nodes)
        if parent >= 0:
            nodes[parent][1 + side] = at
        if len(own) <= LEAF:
            nodes.append([-1, filled, filled + len(own)])
            spans.append([0.0] * 4)
            order.append(np.sort(own))  # by id, where the rows are
            filled += len(own)
            continue
        # The row farthest from the middle sees the others at the most unlike distances.
        middle = lifted[own].mean(axis=0)
        vantage = own[int(((lifted[own] - middle) ** 2).sum(axis=1).argmax())]
        far = np.sqrt(((lifted[own] - lifted[vantage]) ** 2).sum(axis=1))
        by = np.argsort(far, kind="stable")
        half = len(own) // 2
        near, rest = by[:half], by[half:]
        nodes.append([0, 0, 0])
        vantages[at] = int(vantage)
        spans.append([float(far[near].min()), float(far[near].max()), float(far[rest].min()), float(far[rest].max())])
        todo += [(own[rest], at, 1), (own[near], at, 0)]
    placed = np.concatenate(order) if order else np.zeros(0, np.int64)
    where = np.empty(len(placed), np.int64)
    where[placed] = np.arange(len(placed))
    for at, row in vantages.items():
        nodes[at][0] = int(where[row])
    return np.array(nodes, np.int32).reshape(-1, 3), np.array(spans).reshape(-1, 4), placed


class Search:
    """The traversals of one anchor over one tree, which share what they have worked out."""

    def __init__(self, tree: Tree, anchor: np.ndarray, own: int, label: str):
        self.tree, self.anchor, self.own = tree, anchor, own
        self.code = tree.code_of.get(label, -1)
        # Whole numbers held as doubles are added up exactly where no sum can leave their range.
        self.exact = float(np.abs(anchor).max(initial=0)) * tree.largest * len(anchor) < 2**53
        self.base = float((anchor * anchor).sum()) + float(tree.reach)
        self.slack = 1e-6 * (1 + np.sqrt(self.base))
        self.far: dict[int, float] = {}
        self.ranked: dict[tuple[int, bool], tuple[np.ndarray, np.ndarray]] = {}
        self.scored = 0

    def distance(self, score: int) -> float:
        return float(np.sqrt(max(self.base - 2 * float(score), 0)))

    def most(self, nearest: float) -> float:
        """The highest score of rows that are no nearer, never too low."""
        bound = (self.base - max(nearest - self.slack, 0) ** 2) / 2
        return bound + 1e-9 * abs(bound) + 1

    def leaf(self, at: int, a: int, b: int, same: bool) -> tuple[np.ndarray, np.ndarray]:
        """(minus the scores, ascending; rows) of a leaf's rows of the anchor's label or of others; equal scores by id."""
        found = self.ranked.get((at, same))
        if found is None:
            tree = self.tree
            spots = np.flatnonzero(((tree.codes[a:b] == self.code) == same) & (tree.ids[a:b] != self.own))
            minus = -(tree.rows[a:b] @ self.anchor if self.exact else inner(tree.rows[a:b], self.anchor))[spots]
            order = np.argsort(minus, kind="stable")  # the rows of a leaf stand by id
            found = self.ranked[at, same] = minus[order], a + spots[order]
            self.scored += len(spots)
        return found

    def from_vantage(self, at: int, row: int) -> float:
        if at not in self.far:
            self.far[at] = float(np.sqrt(((self.tree.rows[row] - self.anchor) ** 2).sum() + self.tree.height[row]))
        return self.far[at]

    def first(self, k: int, same: bool, low: int | None = None, high: int | None = None) -> list[tuple[int, int, int]]:
        """(score, id, copies) of the first rows, k with their copies, of the anchor's label or of others, whose score is
        in [low, high]: highest first, ties by id."""
        tree = self.tree
        inside = self.distance(high) - self.slack if high is not None else 0.0
        outside = self.distance(low) + self.slack if low is not None else np.inf
        # (minus the highest score, 0 for a node and 1 for a row, node or id, lower bound or copies): where the scores are
        # equal a node comes first, as it may hold a row of a smaller id.
        heap: list[tuple] = [(-np.inf, 0, 0, 0.0)]
        out: list[tuple[int, int, int]] = []
        taken = 0
        while heap and taken < k:
            score, is_row, at, more = heapq.heappop(heap)
            if is_row:
                out.append((-score, at, more))
                taken += more
                continue
            vantage, a, b, least_in, most_in, least_out, most_out = tree.steps[at]
            if vantage < 0:
                minus, rows = self.leaf(at, a, b, same)
                begin = int(np.searchsorted(minus, -high, "left")) if high is not None else 0
                end = int(np.searchsorted(minus, -low, "right")) if low is not None else len(minus)
                for spot in range(begin, min(end, begin + k)):  # no other row of the leaf is among the first k
                    row = rows[spot]
                    heapq.heappush(heap, (int(minus[spot]), 1, int(tree.ids[row]), int(tree.copies[row])))
                continue
            d = self.from_vantage(at, vantage)
            for child, least, most in ((a, least_in, most_in), (b, least_out, most_out)):
                lower = max(more, d - most, least - d)
                if lower - self.slack <= outside and d + most + self.slack >= inside:
                    heapq.heappush(heap, (-self.most(lower), 0, child, lower))
        return out


def _grown(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
    if pdf["v"].map(len).nunique() > 1:
        raise ValueError("vectors of unlike lengths")
    pdf = pdf.sort_values(["id", "label"], kind="stable")
    x = np.stack(pdf["v"].to_list()).astype(np.float64)
    nodes, spans, order = grown(x)
    of = lambda c: pdf[c].to_numpy()[order]
    row = (key[0], x.shape[1], nodes.ravel(), spans.ravel(), x[order].ravel(), of("id"), of("label"), of("copies"))
    return pd.DataFrame([row], columns=["shard", "dim", "nodes", "spans", "vectors", "ids", "labels", "copies"])


def _tree(r) -> Tree:
    return Tree(r.nodes.reshape(-1, 3), r.spans.reshape(-1, 4), r.vectors.reshape(-1, r.dim), r.ids, r.labels, r.copies)


def trees(rows: DataFrame, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """A tree for each shard of rows (id, label, v, copies), written to the shared folder."""
    shards = max(1, -(-rows.count() // shard_rows))
    dealt = rows.withColumn("shard", F.pmod(F.xxhash64("id", "label", "v"), F.lit(shards)).cast("int"))
    return materialise(dealt.groupBy("shard").applyInPandas(_grown, TREES), "trees")


def _blocks(anchors: DataFrame) -> DataFrame:
    """Anchors (id, which, label, v, scores) in blocks. scores: those of an anchor's positives, empty at first."""

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for at in range(0, len(pdf), ANCHOR_BLOCK):
                part = pdf.iloc[at: at + ANCHOR_BLOCK]
                if part["v"].map(len).nunique() > 1:
                    raise ValueError("vectors of unlike lengths")
                yield pd.DataFrame({"a_dim": [len(part["v"].iloc[0])], "a_ids": [part["id"].to_numpy()], "a_which": [part["which"].to_numpy()], "a_labels": [part["label"].to_numpy()], "a": [np.concatenate(part["v"].to_list())], "a_scores": [part["scores"].to_list()]})

    return anchors.mapInPandas(pack, "a_dim int, a_ids array<bigint>, a_which array<bigint>, a_labels array<string>, a array<double>, a_scores array<array<bigint>>")


def _met(anchors: DataFrame, grown_trees: DataFrame, k: int, low: int, high: int) -> DataFrame:
    """(anchor_id, which, positive, id, score, copies): what each shard has for each anchor: its first rows of the same
    label where the anchor has no scores yet (positive is null), else those of other labels in the window of each score."""
    last = grown_trees.agg(F.coalesce(F.max("shard"), F.lit(0))).first()[0]
    pairs = _blocks(anchors).withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(last)))).join(grown_trees, "shard")

    def meet(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for r in pdf.itertuples():
                if r.dim != r.a_dim:
                    raise ValueError("vectors of unlike lengths")
                tree, found = _tree(r), []
                for own, which, label, anchor, scores in zip(r.a_ids.tolist(), r.a_which.tolist(), r.a_labels, r.a.reshape(-1, r.dim), r.a_scores, strict=True):
                    search = Search(tree, anchor, own, label)
                    if not len(scores):
                        found += [(own, which, None, i, s, n) for s, i, n in search.first(k, True)]
                    for positive in sorted(set(map(int, scores))):
                        # low * positive <= 100 * score <= high * positive, in whole numbers
                        window = -(-low * positive // 100), high * positive // 100
                        if window[0] <= window[1]:
                            found += [(own, which, positive, i, s, n) for s, i, n in search.first(k, False, *window)]
                if any(not -(1 << 63) <= x[4] < 1 << 63 for x in found):
                    raise ValueError("a score does not fit into 64 bits")
                yield pd.DataFrame(found, columns=["anchor_id", "which", "positive", "id", "score", "copies"]).astype({"positive": "Int64"})

    return pairs.mapInPandas(meet, "anchor_id long, which long, positive long, id long, score long, copies long")


def _ranked(found: DataFrame, keys: list[str], k: int) -> DataFrame:
    """The first k of each group, a row for each copy, with rank."""
    each = found.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.least("copies", F.lit(k).cast("long")))))
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), F.asc("id"))
    return each.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).drop("copy", "copies")


def hard_negatives(
    vectors: DataFrame, is_anchor: Column, label: Column, n_positives: int = 5, n_negatives: int = 3, low: int = LOW, high: int = HIGH, id_col: str = "vec_id", vector_col: str = "embedding", scale: float = 256.0, shard_rows: int = SHARD_ROWS
) -> DataFrame:
    """anchor_id, positive_id, rank (from 1), negative_id, positive_score, negative_score: for each anchor and each of its
    first positives the first rows of other labels whose score is low to high percent of the positive's. Scores are inner
    products of floor(scale * x)."""
    usable = F.col(id_col).isNotNull() & label.isNotNull() & valid(F.col(vector_col))
    own = vectors.where(usable).select(F.col(id_col).cast("long").alias("id"), label.cast("string").alias("label"), F.transform(vector_col, lambda x: F.floor(x.cast("double") * scale).cast("double")).alias("v"), is_anchor.alias("is_anchor"))
    rows = materialise(own.groupBy("id", "label", "v").agg(F.count("*").alias("copies"), F.max("is_anchor").alias("is_anchor")), "vectors")
    shards = trees(rows.drop("is_anchor"), shard_rows)
    anchors = rows.where("is_anchor").select("id", F.xxhash64("label", "v").alias("which"), "label", "v")
    found = _met(anchors.withColumn("scores", F.array().cast("array<bigint>")), shards, n_positives, low, high)
    positives = materialise(_ranked(found.drop("positive"), ["anchor_id", "which"], n_positives).withColumnRenamed("rank", "place"), "positives")
    scores = positives.groupBy(F.col("anchor_id").alias("id"), "which").agg(F.collect_set("score").alias("scores"))  # n_positives at most
    negatives = _ranked(_met(anchors.join(scores, ["id", "which"]), shards, n_negatives, low, high), ["anchor_id", "which", "positive"], n_negatives)
    named = positives.select("anchor_id", "which", F.col("id").alias("positive_id"), F.col("score").alias("positive"))
    return named.join(negatives, ["anchor_id", "which", "positive"]).select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), F.col("positive").alias("positive_score"), F.col("score").alias("negative_score"))

