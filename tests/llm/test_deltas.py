from __future__ import annotations

import random
import zlib
from collections import defaultdict
from datetime import datetime, timedelta

from factloom.llm import deltas
from pyspark.sql import functions as F

CLIENTS, SALES = "client_id long, nation_id int, extra string, born int, gone int", "sale_id long, client_id long, sold_at timestamp_ntz, extra string, born int, gone int"
LINES = "sale_id long, item_id long, vendor_id long, amount double, discount double, extra string, born int, gone int"


def at(life, batch):
    born, gone = life
    return born <= batch and (gone is None or batch < gone)


def plain(clients, sales, lines, vendors, nation, batches):
    """The view after each batch, by loops."""
    region = {n: r for n, r in nation if n is not None and r is not None}
    out = {}
    for b in range(batches):
        groups = defaultdict(list)
        for sale, item, vendor, amount, discount, _, *life in lines:
            if amount is None or discount is None or amount != amount or abs(amount) == float("inf") or not at(life, b):
                continue
            value = int((100 * amount + 0.5) // 1) * (100 - int((100 * discount + 0.5) // 1))
            for s, c, sold, _, *s_life in sales:
                if s != sale or s is None or sold is None or not at(s_life, b):
                    continue
                for who, n, _, *c_life in clients:
                    if who != c or who is None or not at(c_life, b) or n not in region:
                        continue
                    for v, vn in vendors:
                        if v == vendor and v is not None and region.get(vn) == region[n]:
                            groups[region[n], (sold - datetime(1970, 1, 1)).days].append((value, c, item))
        for key, rows in groups.items():
            out[b, *key] = (len(rows), sum(r[0] for r in rows), min(r[0] for r in rows), len({r[1] for r in rows}), len({r[2] for r in rows} - {None}))
    return out


def frames(spark, clients, sales, lines, vendors, nation):
    return (
        spark.createDataFrame(clients, CLIENTS), spark.createDataFrame(sales, SALES), spark.createDataFrame(lines, LINES),
        spark.createDataFrame(vendors, "vendor_id long, nation_id int"), spark.createDataFrame(nation, "n_nationkey int, n_regionkey int"),
    )


def as_dict(df):
    rows = df.collect()
    out = {(r["batch"], r["region"], r["part"]): (r["n_lines"], r["revenue"], r["min_revenue"], r["n_clients"], r["n_items"]) for r in rows}
    assert len(out) == len(rows)
    return out


def made(seed, hot=False):
    draw = random.Random(seed)
    life = lambda: draw.choice([(-1, None), (-1, None), (0, 2), (1, 2), (0, 1), (-1, 1)])
    pick = lambda most: None if draw.random() < 0.1 else 0 if hot and draw.random() < 0.4 else draw.randrange(most)
    day = lambda: None if draw.random() < 0.1 else datetime(2024, 1, 1) + timedelta(days=draw.randrange(3), hours=draw.randrange(24))
    clients = [(pick(8), pick(5), "x", *life()) for _ in range(12)]
    sales = [(pick(12), pick(8), day(), "y", *life()) for _ in range(30)]
    lines = [(pick(12), pick(6), pick(4), draw.choice([None, 0.5, 1.005, 2.5, float("nan"), float("inf")]), draw.choice([None, 0.0, 0.07]), "z", *life()) for _ in range(80)]
    lines += lines[:9]
    return clients, sales, lines, [(0, 0), (1, 1), (2, None), (3, 3), (3, 2), (None, 1)], [(0, 0), (1, 1), (2, 0), (3, 1), (4, None), (None, 1)]


def test_view_equals_loops(spark):
    for seed in range(2):
        tables = made(seed)
        want = plain(*tables, 3)
        assert want
        assert as_dict(deltas.through_batches(*frames(spark, *tables), batches=3)) == want


def test_heavy_keys_are_salted_and_counted_whole(spark, monkeypatch):
    """With every key heavy the result is the same, and a hot sale's lines lie in more than one bucket."""

    def all_heavy(rows, key, buckets):
        return deltas.materialise(rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.lit(3).alias("salts")), "heavy")

    monkeypatch.setattr(deltas, "heavy", all_heavy)
    tables = made(7, hot=True)
    assert as_dict(deltas.through_batches(*frames(spark, *tables), batches=3)) == plain(*tables, 3)


def test_heavy_finds_the_frequent_keys_and_no_more_than_their_bound(spark):
    rows = spark.range(20_000).select(F.when(F.col("id") % 3 == 0, F.lit(7).cast("long")).otherwise(F.col("id") + 100).alias("k"))
    found = {r["k"]: r["salts"] for r in deltas.heavy(rows, "k", 4).collect()}
    assert set(found) == {7} and 5 <= found[7] <= 6
    salts = deltas.salted(rows.withColumn("x", F.col("k")).withColumn("y", F.monotonically_increasing_id()), "k", deltas.heavy(rows, "k", 4))
    assert salts.agg(F.sum("weight")).first()[0] == 20_000
    assert salts.where("k = 7").select("salt").distinct().count() == found[7]
    equal = deltas.salted(rows, "k", deltas.heavy(rows, "k", 4)).where("k = 7").collect()  # equal rows are one
    assert [r["weight"] for r in equal] == [6667]


def test_joins_of_a_batch_shuffle_no_log(spark):
    view = deltas.SalesView(*frames(spark, *made(1)))
    seen = []
    whole = deltas.materialise

    def watched(df, label):
        if label == "counts":
            seen.append(df._jdf.queryExecution().executedPlan().toString())
        return whole(df, label)

    deltas.materialise = watched
    try:
        view.step(deltas.START)
        view.step(0)
    finally:
        deltas.materialise = whole
        view.drop()
    assert seen[1].count("Exchange") == 1 and seen[1].count("ShuffledHashJoin") == 2 and "Bucketed: true" in seen[1]


def test_empty_tables_give_nothing(spark):
    assert deltas.through_batches(*frames(spark, [], [], [], [], []), batches=2).collect() == []


def test_schedule_follows_the_crc(spark):
    rows = spark.createDataFrame([(f"c{i}",) for i in range(200)] + [(None,)], "k string")
    for r in deltas.scheduled(rows, F.col("k")).collect():
        h = zlib.crc32((r["k"] or "").encode())
        a, d = h % 7, h // 7 % 7
        assert (r["born"], r["gone"]) == ((a, d) if r["k"] and a < d else (-1, None))
