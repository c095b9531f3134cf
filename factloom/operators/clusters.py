"""Windows over ordered rows: gaps and islands, nearest preceding row, first rows of a group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def gap_clusters(rows: DataFrame, keys: list[str], position: str, gap: float | Column) -> DataFrame:
    """Adds cluster (from 0 in each group): a new one where the position jumps by more than the gap."""
    order = Window.partitionBy(*keys).orderBy(position)
    starts = (F.col(position) - F.lag(position).over(order) > gap).cast("int")
    return rows.withColumn("starts", F.coalesce(starts, F.lit(0))).withColumn("cluster", F.sum("starts").over(order.rowsBetween(Window.unboundedPreceding, 0))).drop("starts")


def nearest_before(rows: DataFrame, marks: DataFrame, keys: list[str], position: str, value: str) -> DataFrame:
    """For each row the value of the last mark of its group at or before its position, by one sort of both."""
    both = rows.withColumn("mark", F.lit(None).cast(marks.schema[value].dataType)).withColumn("is_mark", F.lit(0)).unionByName(
        marks.select(*keys, position, F.col(value).alias("mark"), F.lit(1).alias("is_mark")), allowMissingColumns=True
    )
    order = Window.partitionBy(*keys).orderBy(F.asc(position), F.desc("is_mark")).rowsBetween(Window.unboundedPreceding, 0)
    return both.withColumn("nearest", F.last("mark", ignorenulls=True).over(order)).where("is_mark = 0").drop("mark", "is_mark")


def first_rows(rows: DataFrame, keys: list[str], order: list[Column], n: int) -> DataFrame:
    """The first n rows of each group; the limit is applied before the shuffle as well."""
    return rows.withColumn("rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("rn") <= n)


def _cover(low: Column, high: Column, levels: int) -> Column:
    """The aligned blocks (level, number) that make up a range of whole numbers: block number n of a level is the range
    from n * 2^level on, as long. There are at most two a level."""
    out = []
    for k in range(levels):
        first, last = F.shiftright(low + ((1 << k) - 1), k), F.shiftright(high + 1, k) - 1
        up_first, up_last = F.shiftright(low + ((2 << k) - 1), k + 1), F.shiftright(high + 1, k + 1) - 1
        # A block whose double is in the range as well is left to the next level.
        alone = lambda n, f=first, l=last, uf=up_first, ul=up_last: (f <= l) & ((uf > ul) | (n < 2 * uf) | (n > 2 * ul + 1))
        out += [F.when(alone(first), F.struct(F.lit(k).alias("level"), first.alias("number"))), F.when(alone(last) & (last != first), F.struct(F.lit(k).alias("level"), last.alias("number")))]
    return F.filter(F.array(*out), lambda x: x.isNotNull())


def interval_of(points: DataFrame, intervals: DataFrame, keys: list[str], position: str, start: str, end: str, value: str) -> DataFrame:
    """For each point the value of the interval that holds it (the one that starts last, of those the longest), else of
    the nearest by edge (the earlier one at equal distance); of equal ones the least value. Positions are whole numbers.

    Both sides are sorted once by place and swept: the interval that starts last before a point, the furthest end of all
    that start before it, and the next start. Mostly the first of these holds the point, or none does. Where an interval
    lies inside of others and ends before the point, the intervals that hold others are cut into aligned blocks, at most
    two of each length, of which each keeps its best interval; a point looks at the one block of each length that it is
    in. So no key's intervals come together in one row, and a point looks through as many blocks as lengths have bits.

    Null keys meet nothing, as in a join. An interval that ends before it starts counts as its start; one without a start
    is found where its key has no other. A point without a place finds the interval that starts first."""
    mark = "_" * max(map(len, (*points.columns, value)))
    at, kind, iv = f"at{mark}", f"kind{mark}", f"iv{mark}"
    s, e = F.col(start).cast("long"), F.greatest(F.col(start), F.col(end)).cast("long")
    named = intervals.dropna(subset=keys).select(*keys, F.struct(s.alias("s"), e.alias("e"), F.col(value).alias("v")).alias(iv))
    # Intervals come before the points of their place, those without a start before all.
    both = points.withColumn(at, F.col(position).cast("long")).withColumn(kind, F.lit(1)).unionByName(
        named.withColumn(at, F.col(f"{iv}.s")).withColumn(kind, F.when(F.col(f"{iv}.s").isNull(), -1).otherwise(0)), allowMissingColumns=True
    )
    before = Window.partitionBy(*keys).orderBy(F.col(at), F.col(kind), F.col(f"{iv}.e"), F.col(f"{iv}.v").desc()).rowsBetween(Window.unboundedPreceding, 0)
    behind = Window.partitionBy(*keys).orderBy(F.col(at).desc(), F.col(kind).desc(), F.col(f"{iv}.e").desc(), F.col(f"{iv}.v").desc()).rowsBetween(Window.unboundedPreceding, 0)
    is_mark = F.col(kind) == 0
    swept = both.withColumns({
        f"last{mark}": F.last(F.when(is_mark, F.col(iv)), ignorenulls=True).over(before),
        f"far{mark}": F.min(F.when(is_mark, F.struct((-F.col(f"{iv}.e")).alias("e"), F.col(f"{iv}.s").alias("s"), F.col(f"{iv}.v").alias("v")))).over(before),
        f"next{mark}": F.last(F.when(is_mark, F.col(iv)), ignorenulls=True).over(behind),
        f"free{mark}": F.min(F.when(F.col(kind) == -1, F.col(f"{iv}.v"))).over(before),
    }).where(F.col(kind) == 1)
    here, last, far, next_ = (F.col(c) for c in (at, f"last{mark}", f"far{mark}", f"next{mark}"))
    reach = -far["e"]
    covered = (here > last["e"]) & (here <= reach)

    placed = named.where(F.col(f"{iv}.s").isNotNull())
    following = F.lead(f"{iv}.s").over(Window.partitionBy(*keys).orderBy(f"{iv}.s", f"{iv}.e"))
    outer = placed.withColumn("n", following).where(F.col("n") <= F.col(f"{iv}.e")).drop("n")
    levels = int(outer.agg(F.max(F.col(f"{iv}.e") - F.col(f"{iv}.s") + 1)).first()[0] or 1).bit_length()
    best = lambda x: F.min(F.struct((-x["s"]).alias("s"), (-x["e"]).alias("e"), x["v"].alias("v")))
    blocks = outer.select(*keys, iv, F.explode(_cover(F.col(f"{iv}.s"), F.col(f"{iv}.e"), levels)).alias("b")).groupBy(*keys, "b").agg(best(F.col(iv)).alias(f"best{mark}"))
    own = F.array(*[F.struct(F.lit(k).alias("level"), F.shiftright(at, k).alias("number")) for k in range(levels)])
    asked = swept.where(covered).select(*keys, at).distinct().select(*keys, at, F.explode(own).alias("b"))
    holding = asked.join(blocks, [*keys, "b"]).groupBy(*keys, at).agg(F.min(f"best{mark}").alias(f"holding{mark}"))
    rows = swept.join(holding, [*keys, at], "left")
    near = F.when(far.isNull() | (next_["s"] - here < here - reach), next_["v"]).otherwise(far["v"])
    found = F.when(here <= last["e"], last["v"]).when(here <= reach, F.col(f"holding{mark}")["v"]).otherwise(near)
    return rows.select(*points.columns, F.when(last.isNull() & next_.isNull(), F.col(f"free{mark}")).otherwise(found).alias(value))
