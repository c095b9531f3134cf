"""SimHash fingerprints and their near-duplicate classes, by a binary trie self-join.

Two 64-bit fingerprints that differ in at most two bits agree in one of three bit ranges. Rows of equal range value
form a cell; in each cell a binary trie over the other bits is joined with itself: pairs of trie nodes are traversed
together, differing bits add up, and a pair is dropped when they exceed the budget. A cell with more than CELL
fingerprints is itself dealt into pairs of sub-tries by its next bits, up to MAX_SPLIT of them; it is made smaller as
far as those bits vary. Within a task only a spanning forest of the found links leaves the join, never all pairs.

The nodes of the links are the fingerprints, so rows that share an id but hold different texts do not merge classes.
Classes reach the rows by their fingerprints: those of more than a HOT_SHARE-th of all rows, which are at most
HOT_SHARE, by a broadcast, all others by a join.

Cases: a null or empty text has the fingerprint zero and links like any other; equal rows share a fingerprint; a row
with a null id keeps its fingerprint, links nothing and has a null component; rows that share an id and differ in text
each have the class of their own text; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factloom.llm.common import materialise, settle
from factloom.llm.components import components

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}
#: (lowest bit, width) of the bit ranges; with a budget of two differing bits one range of three is equal.
RANGES = ((0, 21), (21, 21), (42, 22))
BUDGET = 2
#: Fingerprints above which a cell is dealt into pairs of sub-tries, and the most bits used for that.
CELL, MAX_SPLIT = 20_000, 12
#: Rows a task joins at once.
CHUNK = 400_000
#: A fingerprint of more rows than all rows over this is hot.
HOT_SHARE = 10_000


def fingerprint(text: str | None, width: int = 3, seed: int = 42) -> int:
    """The unsigned fingerprint of a whole text."""
    words = WORDS.findall((text or "").translate(LOWER))
    if not words:
        return 0
    data = " ".join(words).encode("utf-8", "replace")
    if len(words) <= width:
        return xxhash.xxh64_intdigest(data, seed)
    code = np.frombuffer(data, np.uint8)
    gaps = np.flatnonzero(code == 0x20)
    starts = np.concatenate([[0], gaps + 1])[: len(words) - width + 1].tolist()
    ends = np.append(gaps, len(data))[width - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    h = np.array([digest(data[a:b], seed) for a, b in zip(starts, ends, strict=True)], np.uint64)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(h), 1 << 16):
        part = h[at : at + (1 << 16)].astype(">u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(h)).tobytes(), "big")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fp): the fingerprint as a signed long."""
    return docs.select(F.col(id_col), _fingerprint_column(F.col(text_col)).alias("fp"))


def _fingerprint_column(text: Column) -> Column:
    @F.pandas_udf("long")
    def fp(texts: pd.Series) -> pd.Series:
        settle()
        return pd.Series(np.array([fingerprint(t) for t in texts], np.uint64).view(np.int64))

    return fp(text)


class Forest:
    """Smallest index reachable over the links added so far; vectorised hooking with pointer jumping."""

    def __init__(self, n: int):
        self.low = np.arange(n)

    def add(self, i: np.ndarray, j: np.ndarray) -> None:
        low = self.low
        while len(i):
            a, b = low[i], low[j]
            differ = a != b
            i, j, a, b = i[differ], j[differ], a[differ], b[differ]
            if not len(i):
                return
            np.minimum.at(low, np.maximum(a, b), np.minimum(a, b))
            while True:
                further = low[low]
                if np.array_equal(further, low):
                    break
                low = further
            self.low = low


def trie_pairs(x: np.ndarray, roots: np.ndarray, top: int = 63, budget: int = BUDGET, small: int = 64, slice_size: int = 1 << 20) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of x that lie under a pair of roots and differ in at most `budget` bits.

    x: uint64, ascending within each root; roots: rows (first a, end a, first b, end b), equal or disjoint ranges.
    """
    todo = [(top, roots.astype(np.int64), np.zeros(len(roots), np.int8))]
    while todo:
        level, nodes, spent = todo.pop()
        while len(nodes):
            a0, a1, b0, b1 = nodes.T
            same = a0 == b0
            leaf = ((a1 - a0) * (b1 - b0) <= small) | (level < 0)
            if leaf.any():
                yield from _leaves(x, nodes[leaf], budget, slice_size)
                nodes, spent = nodes[~leaf], spent[~leaf]
                continue
            if len(nodes) > slice_size:
                todo.append((level, nodes[slice_size:], spent[slice_size:]))
                nodes, spent = nodes[:slice_size], spent[:slice_size]
                continue
            ones = np.concatenate([[0], np.cumsum((x >> np.uint64(level)) & np.uint64(1), dtype=np.int64)])
            am, bm = a1 - (ones[a1] - ones[a0]), b1 - (ones[b1] - ones[b0])
            children = [(a0, am, b0, bm, spent), (am, a1, bm, b1, spent), (a0, am, bm, b1, spent + 1)]
            made = [np.stack(c[:4], axis=1) for c in children] + [np.stack((am, a1, b0, bm), axis=1)[~same]]
            costs = [c[4] for c in children] + [(spent + 1)[~same]]
            nodes, spent = np.concatenate(made), np.concatenate(costs).astype(np.int8)
            live = (nodes[:, 0] < nodes[:, 1]) & (nodes[:, 2] < nodes[:, 3]) & (spent <= budget)
            live &= ~((nodes[:, 0] == nodes[:, 2]) & (nodes[:, 1] - nodes[:, 0] == 1))
            nodes, spent = nodes[live], spent[live]
            level -= 1


def _leaves(x: np.ndarray, nodes: np.ndarray, budget: int, slice_size: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for at in range(0, len(nodes), slice_size // 64):
        a0, a1, b0, b1 = nodes[at : at + slice_size // 64].T
        wide, size = b1 - b0, (a1 - a0) * (b1 - b0)
        which = np.repeat(np.arange(len(size)), size)
        k = np.arange(len(which)) - np.repeat(np.cumsum(size) - size, size)
        i, j = a0[which] + k // wide[which], b0[which] + k % wide[which]
        keep = (i < j) | (a0 != b0)[which]
        i, j = i[keep], j[keep]
        near = np.bitwise_count(x[i] ^ x[j]) <= budget
        yield i[near], j[near]


def _links(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Per task: the rows come sorted by cell and side; whole cells are joined together, about CHUNK rows at once."""
    held: list[pd.DataFrame] = []
    count = 0
    for pdf in batches:
        held.append(pdf)
        count += len(pdf)
        if count >= CHUNK:
            rows = pd.concat(held, ignore_index=True)
            key = rows[["part", "value", "a", "b"]].to_numpy()
            cut = np.flatnonzero((key[1:] != key[:-1]).any(axis=1))
            if len(cut):
                at = int(cut[-1]) + 1
                yield _forest(rows[:at])
                rows = rows[at:]
            held, count = [rows], len(rows)
    if count:
        yield _forest(pd.concat(held, ignore_index=True))


def _forest(rows: pd.DataFrame) -> pd.DataFrame:
    key = rows[["part", "value", "a", "b"]].to_numpy(np.int64)
    x = rows["fp"].to_numpy(np.int64).view(np.uint64)
    order = np.lexsort((x, rows["side"].to_numpy(), *key.T[::-1]))
    key, x, rep = key[order], x[order], rows["rep"].to_numpy(np.int64)[order]
    side = rows["side"].to_numpy()[order]
    starts = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]).any(axis=1)]))
    ends = np.append(starts[1:], len(x))
    second = starts + np.add.reduceat((side == 0).astype(np.int64), starts)
    own = key[starts, 2] == key[starts, 3]
    roots = np.stack([starts, np.where(own, ends, second), np.where(own, starts, second), ends], axis=1)
    forest = Forest(len(x))
    for i, j in trie_pairs(x, roots):
        forest.add(i, j)
    linked = np.flatnonzero(forest.low != np.arange(len(x)))
    return pd.DataFrame({"u": rep[linked], "v": rep[forest.low[linked]]})


def links(reps: DataFrame) -> DataFrame:
    """Edges (u, v) between nodes whose fingerprints differ in one or two bits, as spanning forests of all such links.
    reps: (fp, rep), each fingerprint once with the node that stands for it."""
    fp = F.col("fp")
    ranges = [F.struct(F.lit(k).alias("part"), F.shiftrightunsigned(fp, low).bitwiseAND(F.lit((1 << width) - 1)).alias("value"), _rest(fp, low, width).alias("rest")) for k, (low, width) in enumerate(RANGES)]
    cells = reps.select("fp", "rep", F.explode(F.array(*ranges)).alias("c")).select("fp", "rep", "c.*")
    hot = cells.groupBy("part", "value").agg(F.count("*").alias("n")).where(F.col("n") > CELL)
    hot = hot.select("part", "value", F.least(F.lit(MAX_SPLIT), F.ceil(F.log2(F.col("n") / CELL)) + 1).cast("int").alias("bits"))
    masks = F.array(*[F.lit(m) for m in range(1 << MAX_SPLIT) if m.bit_count() <= BUDGET])
    bits = F.coalesce("bits", F.lit(0))
    dealt = (
        cells.join(hot, ["part", "value"], "left").withColumn("bits", bits)
        .withColumn("own", F.expr("cast(shiftrightunsigned(rest, 64 - bits) * int(bits > 0) as int)"))
        .withColumn("mask", F.explode(F.filter(masks, lambda m: m < F.expr("shiftleft(1, bits)"))))
        .withColumn("other", F.col("own").bitwiseXOR(F.col("mask")))
        .select("part", "value", F.least("own", "other").alias("a"), F.greatest("own", "other").alias("b"), (F.col("own") > F.col("other")).cast("int").alias("side"), "fp", "rep")
    )
    return dealt.repartition("part", "value", "a", "b").sortWithinPartitions("part", "value", "a", "b").mapInPandas(_links, "u long, v long")


def _rest(fp, low: int, width: int):
    """The bits outside the range, highest first at the top of the long."""
    above = 64 - low - width
    upper = F.shiftleft(F.shiftrightunsigned(fp, low + width), low + width) if above else F.lit(0).cast("long")
    lower = F.shiftleft(fp.bitwiseAND(F.lit((1 << low) - 1)), width) if low else F.lit(0).cast("long")
    # `upper` keeps its place; `lower` moves up to close the gap that the range leaves.
    return upper.bitwiseOR(lower)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, fp (signed long), component_id (the smallest id reachable over links, its own included)."""
    marked = materialise(fingerprints(docs, id_col, text_col).select(F.col(id_col).cast("long").alias("id"), "fp"), "fingerprints")
    return _with_classes(marked).select(F.col("id").alias(id_col), "fp", "component_id")


def _with_classes(marked: DataFrame) -> DataFrame:
    """marked with class (one of its fingerprints) and component_id. marked: materialised rows with id and fp."""
    known = marked.where(F.col("id").isNotNull())
    counted = materialise(known.groupBy("fp").agg(F.min("id").alias("rep"), F.count("*").alias("n")), "reps")
    nodes = components(links(counted.select("fp", F.col("fp").alias("rep"))))
    placed = counted.join(nodes, counted["fp"] == nodes["node"], "left").select("fp", "n", "rep", F.coalesce("component", "fp").alias("class"))
    least = placed.groupBy("class").agg(F.min("rep").alias("component_id"))
    classes = materialise(placed.join(least, "class").select("fp", "n", "class", "component_id"), "classes")
    total = counted.agg(F.sum("n")).first()[0] or 0
    hot = F.broadcast(classes.where(F.col("n") * HOT_SHARE > total).drop("n"))  # at most HOT_SHARE rows
    cold = known.join(hot, "fp", "left_anti").join(classes.where(F.col("n") * HOT_SHARE <= total).drop("n"), "fp")
    columns = ["id", "fp", "class", "component_id"]
    unknown = marked.where(F.col("id").isNull()).withColumns({c: F.lit(None).cast("long") for c in columns[2:]})
    return known.join(hot, "fp").select(*columns).unionByName(cold.select(*columns)).unionByName(unknown)


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of docs for each near-duplicate class, all columns: that of its smallest id. Of rows of the class that
    share that id the smallest by fingerprint and text stays (any one of equal texts); rows with a null id stay."""
    marked = materialise(fingerprints(docs, id_col, text_col).select(F.col(id_col).cast("long").alias("id"), "fp"), "fingerprints")
    chosen = _with_classes(marked).where(F.col("id") == F.col("component_id")).groupBy("class").agg(F.min(F.struct("id", "fp")).alias("x"))
    end = "_" * max(map(len, docs.columns))
    own = materialise(chosen.select(F.col("x.id").alias(f"id{end}"), F.col("x.fp").alias(f"fp{end}")), "kept")
    of_id = docs[id_col].cast("long") == own[f"id{end}"]
    unknown = docs.where(F.col(id_col).isNull())
    if not marked.where(F.col("id").isNotNull()).groupBy("id").count().where("count > 1").limit(1).count():  # ids alone are read
        return docs.join(own, of_id, "left_semi").unionByName(unknown)
    # The fingerprint parts the texts of an id; of one text's rows each task sends one.
    found = docs.join(own.select(f"id{end}").distinct(), of_id, "left_semi")
    rows = found.select(F.struct(*docs.columns).alias("row"), F.col(id_col).cast("long").alias(f"id{end}"), F.col(text_col).alias("text"), _fingerprint_column(F.col(text_col)).alias(f"fp{end}"))
    first = rows.join(own, [f"id{end}", f"fp{end}"], "left_semi").groupBy(f"id{end}", f"fp{end}").agg(F.min_by("row", F.struct(F.xxhash64("text"), "text")).alias("row"))
    return first.select("row.*").unionByName(unknown)
