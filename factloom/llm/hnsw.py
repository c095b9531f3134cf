"""Approximate nearest neighbours by cosine: a hierarchical navigable small-world graph for each shard of the rows.

Rows are dealt to shards of about SHARD_ROWS by a hash of id and vector. A shard's distinct vectors are drawn levels
(one in LINKS of each level is also on the next), numbered from the highest level down, and linked one after another:
a greedy walk over the levels above its own, then on each of its levels a beam of EF_BUILD, from which neighbours are
chosen that are nearer to the new vector than to each other; a full list of a neighbour is chosen anew in the same way.
As numbers fall with levels, level l is the numbers below counts[l], and its neighbours are one flat array of fixed
width, -1 where there are fewer; a shard is one row of such arrays, written to the shared folder, and every row is in it.

Queries go in blocks to every shard: a greedy walk down to level 0, a beam of EF_SEARCH there. What the beam holds is
scored on the original vectors in double precision, and the k best of each shard are merged for each query.

Cases: rows whose id is null, or whose vector is null, empty, zero or holds null or non-finite components, take no part;
equal vectors are one node with all their ids, repeated rows are results each; a query's own id is never a result; equal
rows are one query, rows of one id with unlike vectors are queries each; ties go to the smaller id; a shard's search goes
on from what it has not seen until it has k rows, so fewer candidates than k give all; an empty table gives no row;
vectors of unlike lengths raise an error; other columns are not looked at. The draw of levels depends on the vectors
alone, so a task that runs again makes the same graph.
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
from factloom.llm.topk import valid

SHARD_ROWS = 4096
#: Neighbours on a level; twice as many on level 0.
LINKS = 16
EF_BUILD, EF_SEARCH = 80, 96
QUERY_BLOCK = 1024
INDEX = "shard int, dim int, counts array<int>, neighbours array<int>, vectors array<double>, ends array<int>, ids array<bigint>, copies array<bigint>"


def units(x: np.ndarray) -> np.ndarray:
    """Rows of length one; scaled by their largest component first, so that squares neither vanish nor overflow."""
    x = x / np.abs(x).max(axis=1, initial=0, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def cosines(rows: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Cosines of rows with a query on the vectors as they are, or scaled where their squares leave the range of doubles."""
    with np.errstate(over="ignore", under="ignore", invalid="ignore"):
        square, own = (rows * rows).sum(axis=1), (query * query).sum()
        if (square > 1e-280).all() and (square < 1e280).all() and 1e-280 < own < 1e280:
            return (rows * query).sum(axis=1) / (np.sqrt(square) * np.sqrt(own))
    return (units(rows) * units(query[None])).sum(axis=1)


class Walk:
    """Searches of one level of one graph: marks what was seen."""

    def __init__(self, vectors: np.ndarray):
        self.vectors, self.seen, self.mark = vectors, np.zeros(len(vectors), np.int64), 0

    def fresh(self) -> None:
        self.mark += 1

    def beam(self, query: np.ndarray, starts: list[int], ef: int, links: np.ndarray) -> list[tuple[float, int]]:
        """The ef nearest found from the starts, as (distance, number), nearest first."""
        self.seen[starts] = self.mark
        todo = list(zip((1 - self.vectors[starts] @ query).tolist(), starts, strict=True))
        heapq.heapify(todo)
        best = [(-d, -i) for d, i in todo]
        heapq.heapify(best)
        while len(best) > ef:
            heapq.heappop(best)
        while todo:
            d, i = heapq.heappop(todo)
            if len(best) == ef and d > -best[0][0]:
                break
            near = links[i]
            near = near[near >= 0]
            near = near[self.seen[near] != self.mark]
            if not len(near):
                continue
            self.seen[near] = self.mark
            for e, j in zip((1 - self.vectors[near] @ query).tolist(), near.tolist(), strict=True):
                if len(best) < ef:
                    heapq.heappush(best, (-e, -j))
                elif e < -best[0][0]:
                    heapq.heapreplace(best, (-e, -j))
                else:
                    continue
                heapq.heappush(todo, (e, j))
        return sorted((-d, -i) for d, i in best)

    def down(self, query: np.ndarray, at: int, level: int, to: int, links: list[np.ndarray]) -> int:
        """Greedy walk from a node of a level to the nearest found on level `to`, at the end of the levels above it."""
        for k in range(level, to, -1):
            self.fresh()
            at = self.beam(query, [at], 1, links[k])[0][1]
        return at


def chosen(vectors: np.ndarray, found: list[tuple[float, int]], most: int) -> list[int]:
    """At most so many of the found (distance, number), nearest first: those nearer to the origin of the distances than
    to any chosen before, then the nearest of the rest."""
    numbers = [i for _, i in found]
    if len(numbers) <= most:
        return numbers
    own = vectors[numbers]
    among = 1 - own @ own.T
    keep, rest, least = [], [], np.full(len(numbers), np.inf)
    for at, (d, _) in enumerate(found):
        if len(keep) == most:
            break
        if d < least[at]:
            keep.append(at)
            np.minimum(least, among[at], out=least)
        else:
            rest.append(at)
    return [numbers[at] for at in (keep + rest)[:most]]


def levels_of(vectors: np.ndarray) -> np.ndarray:
    """A level for each row, drawn by a generator whose seed is their number."""
    draw = np.random.default_rng(len(vectors)).random(len(vectors))
    return np.floor(-np.log(1 - draw) / np.log(LINKS)).astype(np.int64)


def build(unit: np.ndarray, levels: np.ndarray) -> list[np.ndarray]:
    """Neighbours of each level: arrays of (rows on the level, width). Rows stand by descending level."""
    counts = [int((levels >= k).sum()) for k in range(int(levels.max(initial=0)) + 1)]
    links = [np.full((n, LINKS * (2 if k == 0 else 1)), -1, np.int32) for k, n in enumerate(counts)]
    walk = Walk(unit)
    for i in range(1, len(unit)):
        at, top = 0, int(levels[0])
        at = walk.down(unit[i], at, top, min(int(levels[i]), top), links)
        starts = [at]
        for k in range(min(int(levels[i]), top), -1, -1):
            walk.fresh()
            found = walk.beam(unit[i], starts, EF_BUILD, links[k])
            starts = [j for _, j in found]
            width = links[k].shape[1]
            own = chosen(unit, found, LINKS)
            links[k][i, : len(own)] = own
            for j in own:
                row = links[k][j]
                free = int((row >= 0).sum())
                if free < width:
                    row[free] = i
                    continue
                others = np.append(row, i)
                d = 1 - unit[others] @ unit[j]
                order = np.argsort(d, kind="stable")
                row[:] = chosen(unit, list(zip(d[order].tolist(), others[order].tolist(), strict=True)), width)
    return links


@dataclass
class Shard:
    """The graph of a shard and its rows."""

    vectors: np.ndarray
    links: list[np.ndarray]
    ends: np.ndarray
    ids: np.ndarray
    copies: np.ndarray

    def __post_init__(self):
        self.unit = units(self.vectors)
        self.walk = Walk(self.unit)

    def nearest(self, query: np.ndarray, own: int, k: int, ef: int) -> list[tuple[float, int, int]]:
        """(score, id, copies) of the k nearest rows found, nearest first, ties by id."""
        unit = units(query[None])[0]
        at = self.walk.down(unit, 0, len(self.links) - 1, 0, self.links)
        self.walk.fresh()
        rows: list[tuple[float, int, int]] = []
        starts = [at]
        while starts:
            nodes = np.array([i for _, i in self.walk.beam(unit, starts, max(ef, k + 1), self.links[0])])
            for node, score in zip(nodes.tolist(), cosines(self.vectors[nodes], query).tolist(), strict=True):
                span = slice(self.ends[node - 1] if node else 0, self.ends[node])
                members = [(score, i, n) for i, n in zip(self.ids[span][: k + 1].tolist(), self.copies[span][: k + 1].tolist(), strict=True) if i != own]
                rows += members[:k]
            if sum(n for _, _, n in rows) >= k:
                break
            starts = np.flatnonzero(self.walk.seen != self.walk.mark)[:1].tolist()
        return sorted(rows, key=lambda x: (-x[0], x[1]))[:k]


def _indexed(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
    if pdf["v"].map(len).nunique() > 1:
        raise ValueError("vectors of unlike lengths")
    pdf = pdf.sort_values("id", kind="stable")
    x = np.stack(pdf["v"].to_list()).astype(np.float64) + 0.0  # minus zero is zero
    distinct, node = np.unique(x, axis=0, return_inverse=True)
    levels = levels_of(distinct)
    order = np.argsort(-levels, kind="stable")
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    node = place[node.ravel()]
    by_node = np.argsort(node, kind="stable")  # ids ascend in a node
    ends = np.cumsum(np.bincount(node, minlength=len(distinct)))
    links = build(units(distinct[order]), levels[order])
    row = (key[0], x.shape[1], np.array([len(a) for a in links], np.int32), np.concatenate([a.ravel() for a in links]), distinct[order].ravel(), ends.astype(np.int32), pdf["id"].to_numpy()[by_node], pdf["copies"].to_numpy()[by_node])
    return pd.DataFrame([row], columns=["shard", "dim", "counts", "neighbours", "vectors", "ends", "ids", "copies"])


def _loaded(r) -> Shard:
    links, at = [], 0
    for k, n in enumerate(r.counts.tolist()):
        width = LINKS * (2 if k == 0 else 1)
        links.append(r.neighbours[at: at + n * width].reshape(n, width))
        at += n * width
    return Shard(r.vectors.reshape(-1, r.dim), links, r.ends, r.ids, r.copies)


def _rows(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, v, copies): the rows that take part, equal ones once."""
    usable = F.col(id_col).isNotNull() & valid(F.col(vector_col)) & F.exists(vector_col, lambda c: c != 0)
    rows = vectors.where(usable).select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    return rows.groupBy("id", "v").agg(F.count("*").alias("copies"))


def index(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", shard_rows: int = SHARD_ROWS) -> DataFrame:
    """One row a shard: its graph as flat neighbour arrays, its vectors, ids and copies. Written to the shared folder."""
    rows = materialise(_rows(vectors, id_col, vector_col), "vectors")
    shards = max(1, -(-rows.count() // shard_rows))
    dealt = rows.withColumn("shard", F.pmod(F.xxhash64("id", "v"), F.lit(shards)).cast("int"))
    return materialise(dealt.groupBy("shard").applyInPandas(_indexed, INDEX), "graphs")


def search(indexed: DataFrame, queries: DataFrame, k: int = 5, ef: int = EF_SEARCH, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank (from 1), id, score for the k nearest rows found for each query."""
    asked = _rows(queries, id_col, vector_col).select("id", "v", F.xxhash64("v").alias("which"))

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for at in range(0, len(pdf), QUERY_BLOCK):
                part = pdf.iloc[at: at + QUERY_BLOCK]
                if part["v"].map(len).nunique() > 1:
                    raise ValueError("vectors of unlike lengths")
                yield pd.DataFrame({"q_dim": [len(part["v"].iloc[0])], "q_ids": [part["id"].to_numpy()], "q_which": [part["which"].to_numpy()], "q": [np.concatenate(part["v"].to_list())]})

    blocks = materialise(asked.mapInPandas(pack, "q_dim int, q_ids array<bigint>, q_which array<bigint>, q array<double>"), "queries")
    # Each task takes some shards and goes through some blocks: neither side is broadcast, nor sent once for each of the other.
    met = indexed.hint("shuffle_replicate_nl").crossJoin(blocks)

    def meet(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for r in pdf.itertuples():
                if r.dim != r.q_dim:
                    raise ValueError("vectors of unlike lengths")
                shard = _loaded(r)
                found = [(i, w, *x) for i, w, q in zip(r.q_ids.tolist(), r.q_which.tolist(), r.q.reshape(-1, r.dim), strict=True) for x in shard.nearest(q, i, k, ef)]
                yield pd.DataFrame(found, columns=["query_id", "which", "score", "id", "copies"])

    found = met.mapInPandas(meet, "query_id long, which long, score double, id long, copies long")
    each = found.select("query_id", "which", "score", "id", F.explode(F.sequence(F.lit(1).cast("long"), F.least("copies", F.lit(k).cast("long")))))
    order = Window.partitionBy("query_id", "which").orderBy(F.desc("score"), F.asc("id"))
    return each.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", F.col("id").alias(id_col), "score")


def nearest(vectors: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding", ef: int = EF_SEARCH) -> DataFrame:
    """Indexes all rows and searches those of is_query among them."""
    return search(index(vectors, id_col, vector_col), vectors.where(is_query), k, ef, id_col, vector_col)
