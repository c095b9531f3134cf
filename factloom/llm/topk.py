"""Exact top-k search by inner product, with pivot-table elimination.

Distances from every vector to fixed pivots are computed once. For a query q and a candidate c,
max over pivots p of |d(q, p) - d(c, p)| is a lower bound of d(q, c), and so (|q|^2 + |c|^2 - bound^2) / 2 an upper
bound of their inner product. Candidates of a block are evaluated in bound order until the k-th score found exceeds
every bound left, which is exact.

Rows are packed into blocks by their nearest pivot, their cell. A query first meets one block of its own cell, by the same
elimination; its k-th score there is the floor that it takes to all other blocks. What reaches the driver is the range of
distances to the pivots and the largest norm of each cell, some thousand numbers at any size. A query goes on to the
cells whose bound by these ranges reaches its floor, and a block is sent to the groups of queries that ask for it, so
pairs that the ranges rule out are neither shuffled nor evaluated. The k best of each meeting are merged per query.

On clustered vectors that leaves little. Vectors like noise in many dimensions are all about equally far from every
pivot: then nearly everything is evaluated, and the work grows as queries times candidates. `work` counts it.

Cases: vectors that are null, or hold null or non-finite components, take no part; a null id takes no part; ties go to
the smaller id; rows that repeat an id are candidates each (the query's own id is never one), and queries each, with
the same answer; fewer candidates than k give all; an empty table gives an empty table; vectors of unlike lengths, and
scores beyond 64 bits, raise an error that says so.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from factloom.llm.common import materialise

PIVOTS = 64
#: Rows of the bounded sample from which the pivots are chosen.
PIVOT_SAMPLE = 2000
QUERY_BLOCK, CANDIDATE_BLOCK = 512, 8192
#: Blocks of queries that are held against a block of candidates at once.
GROUP = 8
#: Candidates evaluated at a time.
STEP = 256


def valid(vector: Column) -> Column:
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    return vector.isNotNull() & (F.size(vector) > 0) & F.forall(vector, finite)


def choose_pivots(sample: np.ndarray, n: int = PIVOTS) -> np.ndarray:
    """Farthest-first from the sample's first row."""
    if not len(sample):
        return sample
    chosen, near = [0], np.linalg.norm(sample - sample[0], axis=1)
    while len(chosen) < min(n, len(sample)):
        far = int(near.argmax())
        chosen.append(far)
        near = np.minimum(near, np.linalg.norm(sample - sample[far], axis=1))
    return sample[chosen]


def distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum((x * x).sum(axis=1)[:, None] + (pivots * pivots).sum(axis=1)[None] - 2 * x @ pivots.T, 0))


def inner(rows: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Inner products of whole numbers held as doubles, exact; Python's numbers where doubles are too small."""
    if float(np.abs(query).max(initial=0)) * float(np.abs(rows).max(initial=0)) * rows.shape[1] < 2**53:
        return rows @ query
    return np.array([sum(int(a) * int(b) for a, b in zip(r.tolist(), query.tolist(), strict=True)) for r in rows], object)


def best(queries: np.ndarray, query_ids: np.ndarray, rows: np.ndarray, ids: np.ndarray, pivots: np.ndarray, k: int, known: list[int | None] | None = None) -> list[tuple[int, list[tuple[int, int]], int, int]]:
    """(query id, its k best as (id, score), rows evaluated, rows that could be) of each query, exact. known: a score
    that k rows of any block reach together, for each query; rows below it may be left out."""
    table_q, table_r = distances(queries, pivots), distances(rows, pivots).T.copy()
    square_q, square_r = (queries * queries).sum(axis=1), (rows * rows).sum(axis=1)
    # What rounding can add to a distance, generously.
    slack = 1e-6 * (1 + np.sqrt(max(square_q.max(initial=0), square_r.max(initial=0), (pivots * pivots).sum(axis=1).max(initial=0))))
    raised = lambda low, square: (bound := (square - np.maximum(low - slack, 0) ** 2) / 2) + 1e-9 * np.abs(bound) + 1
    # The block as a whole: no row of it is nearer to a query than its range of distances to a pivot is.
    least, most = table_r.min(axis=1, initial=np.inf), table_r.max(axis=1, initial=0)
    apart = np.maximum(least - table_q, table_q - most).max(axis=1, initial=0)
    block = raised(apart, square_q + square_r.max(initial=0))
    out = []
    for at, own in enumerate(query_ids.tolist()):
        floor = known[at] if known and known[at] is not None else None
        live = int((ids != own).sum())
        if floor is not None and block[at] < floor:
            out.append((own, [], 0, live))
            continue
        low = np.zeros(len(rows))
        for p in range(len(pivots)):
            np.maximum(low, np.abs(table_r[p] - table_q[at, p]), out=low)
        bound = raised(low, square_q[at] + square_r)
        todo = np.flatnonzero(ids != own) if floor is None else np.flatnonzero((ids != own) & (bound >= floor))
        top: list[tuple[int, int]] = []
        done = 0
        while len(todo):
            step = min(max(STEP, done), len(todo))
            cut = np.argpartition(-bound[todo], step - 1) if step < len(todo) else np.arange(len(todo))
            take, todo = todo[cut[:step]], todo[cut[step:]]
            done += len(take)
            scores = inner(rows[take], queries[at])
            if len(take) > k:  # only what can be among the k best
                keep = scores >= np.partition(scores, len(take) - k)[len(take) - k]
                take, scores = take[keep], scores[keep]
            top = sorted([*top, *((-int(s), int(i)) for s, i in zip(scores, ids[take], strict=True))])[:k]
            if len(top) == k and len(todo) and bound[todo].max() < -top[-1][0]:
                break
        out.append((own, [(i, -s) for s, i in top], done, live))
    return out


def ceilings(queries: np.ndarray, table_q: np.ndarray, low: np.ndarray, high: np.ndarray, reach: np.ndarray) -> np.ndarray:
    """Upper bounds of the scores of queries (rows) with cells (columns): low, high: the ranges of a cell's distances to
    the pivots, reach: its largest squared norm."""
    square = (queries * queries).sum(axis=1)
    slack = 1e-6 * (1 + np.sqrt(max(square.max(initial=0), reach.max(initial=0), (high * high).max(initial=0))))
    out = np.empty((len(queries), len(reach)))
    for c in range(len(reach)):
        apart = np.maximum(low[c] - table_q, table_q - high[c]).max(axis=1, initial=0)
        bound = (square + reach[c] - np.maximum(apart - slack, 0) ** 2) / 2
        out[:, c] = bound + 1e-9 * np.abs(bound) + 1
    return out


def _stacked(ids: list, vectors: list) -> tuple[np.ndarray, np.ndarray]:
    if len(set(map(len, vectors))) > 1:
        raise ValueError("vectors of unlike lengths")
    return np.array(ids, np.int64), np.array(vectors, np.float64)


class Search:
    """The rows that take part, in blocks by cell, and the queries among them."""

    def __init__(self, vectors: DataFrame, is_query: Column, k: int, id_col: str, vector_col: str, scale: float, n_pivots: int):
        rows = vectors.where(F.col(id_col).isNotNull() & valid(F.col(vector_col))).select(
            F.col(id_col).cast("long").alias("id"), F.transform(vector_col, lambda x: F.floor(x.cast("double") * scale).cast("double")).alias("v"), F.coalesce(is_query, F.lit(False)).alias("is_query")
        )
        sample = rows.orderBy(F.xxhash64("id"), "id").limit(PIVOT_SAMPLE).select("id", "v").collect()
        self.k = k
        self.pivots = pivots = choose_pivots(_stacked([r["id"] for r in sample], [r["v"] for r in sample])[1], n_pivots) if sample else np.zeros((0, 1))

        @F.pandas_udf("int")
        def cell(v: pd.Series) -> pd.Series:
            if not len(v):
                return pd.Series([], dtype="int32")
            x = _stacked([], v.to_list())[1]
            if x.shape[1] != pivots.shape[1]:
                raise ValueError("vectors of unlike lengths")
            return pd.Series(distances(x, pivots).argmin(axis=1).astype(np.int32))

        placed = rows.withColumn("cell", cell("v")).withColumn("row", F.monotonically_increasing_id())
        self.rows = materialise(placed, "cells")
        # One row a pivot: how many rows and queries each cell has.
        sizes = {r["cell"]: (r["n"], r["q"]) for r in self.rows.groupBy("cell").agg(F.count("*").alias("n"), F.count_if("is_query").alias("q")).collect()}
        self.blocks_of = {c: -(-n // CANDIDATE_BLOCK) for c, (n, _) in sizes.items()}
        self.blocks = materialise(self._packed(self.rows, self.blocks_of), "vector-blocks")
        self.asked = materialise(self._packed(self.rows.where("is_query"), {c: -(-q // QUERY_BLOCK) for c, (_, q) in sizes.items() if q}), "query-blocks")
        ranges = self.blocks.select("cell", F.posexplode(F.arrays_zip("low", "high"))).groupBy("cell", "pos").agg(F.min("col.low").alias("low"), F.max("col.high").alias("high")).collect()  # pivots squared
        reach = {r["cell"]: r["reach"] for r in self.blocks.groupBy("cell").agg(F.max("reach").alias("reach")).collect()}
        self.cells = sorted(reach)
        place = {c: i for i, c in enumerate(self.cells)}
        self.low, self.high, self.reach = np.zeros((len(place), len(pivots))), np.zeros((len(place), len(pivots))), np.array([reach[c] for c in self.cells])
        for r in ranges:
            self.low[place[r["cell"]], r["pos"]], self.high[place[r["cell"]], r["pos"]] = r["low"], r["high"]

    def _packed(self, rows: DataFrame, blocks: dict[int, int]) -> DataFrame:
        """(cell, part, ids, x, low, high, reach): so many blocks a cell, dealt by the rows' numbers."""
        pivots = self.pivots
        number = F.create_map(*[F.lit(x) for kv in blocks.items() for x in kv])[F.col("cell")] if blocks else F.lit(1)

        def pack(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
            ids, x = _stacked(pdf["id"].to_list(), pdf["v"].to_list())
            far = distances(x, pivots)
            return pd.DataFrame({"cell": [key[0]], "part": [key[1]], "ids": [ids.tobytes()], "x": [x.tobytes()], "low": [far.min(axis=0)], "high": [far.max(axis=0)], "reach": [(x * x).sum(axis=1).max()]})

        dealt = rows.select("cell", "id", "v", F.pmod(F.xxhash64("row"), number).cast("int").alias("part"))
        return dealt.groupBy("cell", "part").applyInPandas(pack, "cell int, part int, ids binary, x binary, low array<double>, high array<double>, reach double")

    def _meet(self, met: DataFrame) -> DataFrame:
        """(query_id, row, id, score, evaluated) of rows (q_ids, q_x, floors, ids, x): the best of each block for each
        query, and one row with a null id for its count of evaluations."""
        pivots, k = self.pivots, self.k

        def meet(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                found = []
                for q_ids, q_x, floors, ids, x in zip(pdf["q_ids"], pdf["q_x"], pdf["floors"], pdf["ids"], pdf["x"], strict=True):
                    qi, ri = np.frombuffer(q_ids, np.int64), np.frombuffer(ids, np.int64)
                    queries, own = np.frombuffer(q_x).reshape(len(qi), -1), np.frombuffer(x).reshape(len(ri), -1)
                    known = [None if f is None or np.isnan(f) else int(f) for f in floors] if floors is not None else None
                    for at, (query, top, evaluated, _) in enumerate(best(queries, qi, own, ri, pivots, k, known)):
                        if any(not -(1 << 63) <= s < 1 << 63 for _, s in top):
                            raise ValueError("a score does not fit into 64 bits")
                        found.append((query, at, None, None, evaluated))
                        found += [(query, at, i, s, 0) for i, s in top]
                yield pd.DataFrame(found, columns=["query_id", "at", "id", "score", "evaluated"]).astype({"id": "Int64", "score": "Int64"})

        return met.mapInPandas(meet, "query_id long, at int, id long, score long, evaluated long")

    def found(self) -> DataFrame:
        """(query_id, id, score, evaluated): what each meeting has for each query."""
        k, low, high, reach, pivots, cells, blocks_of = self.k, self.low, self.high, self.reach, self.pivots, np.array(self.cells), self.blocks_of
        own = self.blocks.where("part = 0").select("cell", "ids", "x")
        schema = "cell int, part int, g int, q_ids binary, q_x binary, floors array<double>, own_ids binary, own_scores binary, evaluated long"

        def begin(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            """Searches a query's own cell, then parts the queries by the cells that they go on to. A row with a null part
            holds what was found; the others hold queries for one block."""
            for pdf in batches:
                for r in pdf.itertuples():
                    qi, ri = np.frombuffer(r.q_ids, np.int64), np.frombuffer(r.ids, np.int64)
                    queries, rows = np.frombuffer(r.q_x).reshape(len(qi), -1), np.frombuffer(r.x).reshape(len(ri), -1)
                    tops = best(queries, qi, rows, ri, pivots, k)
                    hits = [(query, i, s) for query, top, _, _ in tops for i, s in top]
                    if any(not -(1 << 63) <= s < 1 << 63 for _, _, s in hits):
                        raise ValueError("a score does not fit into 64 bits")
                    floors = np.array([float(np.nextafter(float(top[-1][1]), -np.inf)) if len(top) == k else np.nan for _, top, _, _ in tops])
                    pack = lambda column, kind: np.array(column, kind).tobytes()
                    out = [(r.cell, None, None, pack([h[0] for h in hits], np.int64), None, None, pack([h[1] for h in hits], np.int64), pack([h[2] for h in hits], np.int64), sum(n for *_, n, _ in tops))]
                    live = ~(ceilings(queries, distances(queries, pivots), low, high, reach) < floors[:, None])
                    for c in range(len(cells)):
                        some = np.flatnonzero(live[:, c])
                        for part in range(blocks_of[int(cells[c])] if len(some) else 0):
                            if cells[c] != r.cell or part:
                                out.append((int(cells[c]), part, r.part // GROUP, qi[some].tobytes(), queries[some].tobytes(), floors[some], None, None, 0))
                    yield pd.DataFrame(out, columns=["cell", "part", "g", "q_ids", "q_x", "floors", "own_ids", "own_scores", "evaluated"]).astype({"part": "Int32", "g": "Int32"})

        first = self.asked.select("cell", "part", F.col("ids").alias("q_ids"), F.col("x").alias("q_x")).join(own, "cell")
        self.begun = begun = materialise(first.mapInPandas(begin, schema), "begun")

        @F.pandas_udf("array<struct<query_id:long,id:long,score:long>>")
        def unpacked(queries: pd.Series, ids: pd.Series, scores: pd.Series) -> pd.Series:
            read = lambda b: np.frombuffer(b, np.int64).tolist()
            return pd.Series([[{"query_id": q, "id": i, "score": s} for q, i, s in zip(read(a), read(b), read(c), strict=True)] for a, b, c in zip(queries, ids, scores, strict=True)], dtype=object)

        searched = begun.where("part is null")
        near = searched.select(F.explode(unpacked("q_ids", "own_ids", "own_scores")).alias("h")).select("h.*", F.lit(0).cast("long").alias("evaluated"))
        counted = searched.select(F.lit(None).cast("long").alias("query_id"), F.lit(None).cast("long").alias("id"), F.lit(None).cast("long").alias("score"), "evaluated")
        going = begun.where("part is not null").select("cell", "part", "g", "q_ids", "q_x", "floors")
        # A block goes once to each group of queries that asks for it.
        wanted = self.blocks.select("cell", "part", "ids", "x").join(going.select("cell", "part", "g").distinct(), ["cell", "part"])
        far = self._meet(going.join(wanted, ["cell", "part", "g"]))
        return near.unionByName(counted).unionByName(far.select("query_id", "id", "score", "evaluated"))


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding", scale: float = 256.0, n_pivots: int = PIVOTS) -> DataFrame:
    """query_id, rank (from 1), id, score for the k highest integer inner products of floor(scale * x) of each query
    row, over all rows but those of its own id."""
    found = Search(vectors, is_query, k, id_col, vector_col, scale, n_pivots).found().where("id is not null")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc("id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", F.col("id").alias(id_col), "score")


def work(vectors: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding", scale: float = 256.0, n_pivots: int = PIVOTS) -> DataFrame:
    """One row: how many pairs of query and candidate there are, and how many were evaluated, those of a query's own cell
    among them."""
    search = Search(vectors, is_query, k, id_col, vector_col, scale, n_pivots)
    by_id = search.rows.groupBy("id").agg(F.count("*").alias("n"), F.count_if("is_query").alias("q"))
    pairs = by_id.agg(F.sum("q") * F.sum("n") - F.sum(F.col("q") * F.col("n"))).first()[0] or 0
    return search.found().agg(F.lit(pairs).cast("long").alias("candidates"), F.coalesce(F.sum("evaluated"), F.lit(0)).alias("evaluated"))
