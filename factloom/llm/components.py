"""Connected components of a distributed edge list, by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factloom.llm.common import materialise, release


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of the edges (u, v), both long; component is the smallest node reachable.

    Each round keeps the components and shortens the paths; it ends when no edge changes. The state is written to the
    shared folder after each round, and that of the round before is deleted. A hub's edges meet one row that holds its smallest neighbour, and the join of the
    two may be split where it is skewed. Edges with a null end and loops are left out; an empty list gives no row.
    """
    now = materialise(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where(F.col("u") != F.col("v")).distinct(), "edges")
    state = None
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where(F.col("v") > F.col("u")).join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        before, now = now, materialise(small.unionByName(least.select("u", F.col("m").alias("v"))).where(F.col("u") != F.col("v")).distinct(), "edges")
        release(before)
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if seen == state:
            break
        state = seen
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
