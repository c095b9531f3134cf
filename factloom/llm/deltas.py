"""Incremental maintenance of a grouped join view by telescoping delta rules.

The view joins clients, sales and lines (vendors and nations are fixed) and groups what comes out. Each of the three is a
log of signed rows: a row arrives in a batch with weight +n and leaves in a later one with weight -n, so that a relation
before or after a batch is the sum of its log up to there. For batch b

    new pairs  = (new clients x sales before) + (clients after x new sales)
    new result = (new pairs x lines before)   + (pairs after x new lines)

where "new" are the signed rows of b. The four products hold every combination once, at the batch of its last part, and
their weights multiply; pairs of client and sale are a log of their own. The result of a batch is added to one table of
counts by (region, part, kind, id), where an id is a line's revenue, a client or an item; entries that come to zero go.
All figures of a group are read from these counts: also a least revenue after the least one left, and distinct ids.

Each log is laid out once, by batch and in buckets of its join key, so a product reads only the batches it names and no
join of any batch shuffles a log. A key with more than 1 / (4 * buckets) of all rows is dealt over several salts, equal
rows of it summed first, and the few rows it meets are copied to each of these. There are at most 4 * buckets such keys,
whatever the input's size; their list is all that is broadcast, besides a nation table that Spark itself finds small.

Cases: ids that are null join nothing, a null item counts for no item; a line takes no part without a finite amount and
discount; equal rows count each, on every side; rows without a batch (`lasting`) are there from the start; empty tables
give an empty result; other columns are not looked at.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from factloom.llm.common import materialise, release, shared_path

BATCHES = 7
#: The batch of what is there from the start.
START = -1
VALUE, CLIENT, ITEM = 0, 1, 2


def scheduled(rows: DataFrame, text: Column, batches: int = BATCHES) -> DataFrame:
    """rows with born and gone, by the crc32 of a text: a = crc % batches, d = crc / batches % batches. Where a < d the
    row arrives in batch a and leaves in d; others, and those of a null text, are lasting: born is START, gone null."""
    a, d = F.crc32(text) % batches, F.floor(F.crc32(text) / batches) % batches
    passing = F.coalesce(a < d, F.lit(False))
    return rows.withColumns({"born": F.when(passing, a).otherwise(START).cast("int"), "gone": F.when(passing, d).cast("int")})


def signed(rows: DataFrame) -> DataFrame:
    """One row an event instead of born and gone: batch and weight. rows may hold a weight already."""
    n = F.col("weight") if "weight" in rows.columns else F.lit(1).cast("long")
    left = [c for c in rows.columns if c not in ("born", "gone", "weight")]
    arrives, leaves = F.struct(F.col("born").alias("batch"), n.alias("weight")), F.struct(F.col("gone").alias("batch"), (-n).alias("weight"))
    return rows.select(*left, F.explode(F.when(F.col("gone").isNull(), F.array(arrives)).otherwise(F.array(arrives, leaves))).alias("event")).select(*left, "event.*")


@dataclass
class Log:
    """Signed rows in a bucketed table, partitioned by batch."""

    spark: SparkSession
    name: str
    keys: tuple[str, ...]
    buckets: int
    path: str

    @classmethod
    def new(cls, spark: SparkSession, label: str, keys: tuple[str, ...], buckets: int) -> Log:
        return cls(spark, f"factloom_{label}_{uuid.uuid4().hex}", keys, buckets, shared_path(spark, label))

    def append(self, rows: DataFrame) -> None:
        dealt = rows.repartition(self.buckets, *self.keys)
        dealt.write.format("parquet").mode("append").partitionBy("batch").bucketBy(self.buckets, *self.keys).option("path", self.path).saveAsTable(self.name)

    def read(self, batches: Column) -> DataFrame:
        return self.spark.table(self.name).where(batches)

    def drop(self) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")
        target = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        target.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def heavy(rows: DataFrame, key: str, buckets: int) -> DataFrame:
    """(key, salts) of the keys that hold over 1 / (4 * buckets) of the rows: at most 4 * buckets of them."""
    share = max(1, rows.count() // (4 * buckets))
    found = rows.groupBy(key).agg(F.count("*").alias("n")).where(F.col("n") > max(share, 1000))
    return materialise(found.select(key, F.ceil(F.col("n") / share).cast("int").alias("salts")), "heavy")


def salted(rows: DataFrame, key: str, hot: DataFrame) -> DataFrame:
    """rows with weight and salt: equal rows of a heavy key are summed and dealt over its salts by what they hold; others
    have weight 1 and salt 0."""
    if hot.isEmpty():
        return rows.select("*", F.lit(1).cast("long").alias("weight"), F.lit(0).alias("salt"))
    marked = rows.join(F.broadcast(hot), key, "left")
    left = marked.where("salts is null").select(*rows.columns, F.lit(1).cast("long").alias("weight"), F.lit(0).alias("salt"))
    summed = marked.where("salts is not null").groupBy(*rows.columns, "salts").agg(F.count("*").alias("weight"))
    dealt = summed.select(*rows.columns, "weight", F.pmod(F.xxhash64(*rows.columns), F.col("salts")).cast("int").alias("salt"))
    return left.unionByName(dealt)


def copied(rows: DataFrame, key: str, hot: DataFrame) -> DataFrame:
    """rows once for each salt of their key."""
    last = F.coalesce("salts", F.lit(1)) - 1
    return rows.join(F.broadcast(hot), key, "left").withColumn("salt", F.explode(F.sequence(F.lit(0), last))).drop("salts")


def revenue(amount: Column, discount: Column) -> Column:
    """floor(100 * amount + 0.5) * (100 - floor(100 * discount + 0.5)), null unless both are finite."""
    finite = ~F.isnan(amount) & ~F.isnan(discount) & (F.abs(amount) != float("inf")) & (F.abs(discount) != float("inf"))
    return F.when(finite, F.floor(100 * amount + F.lit(0.5)) * (100 - F.floor(100 * discount + F.lit(0.5))))


class SalesView:
    """The view and its logs. `step` brings it from one batch to the next; `groups` gives its rows."""

    def __init__(self, clients: DataFrame, sales: DataFrame, lines: DataFrame, vendors: DataFrame, nation: DataFrame):
        """clients (client_id, nation_id), sales (sale_id, client_id, sold_at) and lines (sale_id, item_id, vendor_id,
        amount, discount), all with born and gone; vendors (vendor_id, nation_id); nation (n_nationkey, n_regionkey)."""
        spark = clients.sparkSession
        n = max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))
        region = nation.where("n_nationkey is not null and n_regionkey is not null").select(F.col("n_nationkey").alias("nation_id"), F.col("n_regionkey").cast("int").alias("region"))
        who = clients.where("client_id is not null").select("client_id", "nation_id", "born", "gone").join(region, "nation_id").drop("nation_id")
        sold = sales.where("sale_id is not null and client_id is not null and sold_at is not null").select("sale_id", "client_id", F.unix_date(F.col("sold_at").cast("date")).cast("long").alias("part"), "born", "gone")
        value = lines.where("sale_id is not null and vendor_id is not null").select("sale_id", F.col("item_id").cast("long"), "vendor_id", revenue(F.col("amount"), F.col("discount")).alias("revenue"), "born", "gone").where("revenue is not null")
        seller = vendors.select("vendor_id", "nation_id").join(region, "nation_id").drop("nation_id")

        buyers, self.sales_of = heavy(sold, "client_id", n), heavy(lines.where("sale_id is not null").select("sale_id"), "sale_id", n)
        self.clients, self.sales = (Log.new(spark, label, ("client_id", "salt"), n) for label in ("clients", "sales"))
        self.pairs, self.lines = (Log.new(spark, label, ("sale_id", "region", "salt"), n) for label in ("pairs", "lines"))
        self.clients.append(signed(copied(who.groupBy(*who.columns).agg(F.count("*").alias("weight")), "client_id", buyers)))
        self.sales.append(signed(salted(sold, "client_id", buyers)))
        # Vendors grow with the input: a join by shuffle, in which Spark splits what a frequent vendor holds.
        self.lines.append(signed(salted(value, "sale_id", self.sales_of).join(seller.hint("shuffle_hash"), "vendor_id").drop("vendor_id")))
        self.spark, self.counts, self.batch, self.hot = spark, None, None, (buyers, self.sales_of)

    def step(self, batch: int) -> None:
        """Applies a batch; batches come in ascending order, START first."""
        now, before, after = F.col("batch") == batch, F.col("batch") < batch, F.col("batch") <= batch
        weight = (F.col("x.weight") * F.col("y.weight")).alias("weight")

        def product(few: DataFrame, many: DataFrame, keys: tuple[str, ...], *columns: str) -> DataFrame:
            same = reduce(lambda p, q: p & q, [F.col(f"x.{k}") == F.col(f"y.{k}") for k in keys])
            return few.alias("x").hint("shuffle_hash").join(many.alias("y"), same).select(*columns, weight)

        pair = ("y.sale_id", "x.client_id", "x.region", "y.part")
        new = product(self.clients.read(after), self.sales.read(now), self.clients.keys, *pair)
        if batch > START:
            new = product(self.clients.read(now), self.sales.read(before), self.clients.keys, *pair).unionByName(new)
        self.pairs.append(copied(new.withColumn("batch", F.lit(batch)), "sale_id", self.sales_of))

        result = ("x.region", "x.part", "x.client_id", "y.item_id", "y.revenue")
        added = product(self.pairs.read(after), self.lines.read(now), self.pairs.keys, *result)
        if batch > START:
            added = product(self.pairs.read(now), self.lines.read(before), self.pairs.keys, *result).unionByName(added)
        entries = F.array(*[F.struct(F.lit(kind).alias("kind"), F.col(c).alias("id")) for kind, c in ((VALUE, "revenue"), (CLIENT, "client_id"), (ITEM, "item_id"))])
        delta = added.select("region", "part", "weight", F.explode(entries).alias("e")).select("region", "part", "e.*", "weight").where("id is not null")
        both = delta if self.counts is None else delta.unionByName(self.counts)
        old, self.counts = self.counts, materialise(both.groupBy("region", "part", "kind", "id").agg(F.sum("weight").alias("weight")).where("weight != 0"), "counts")
        self.batch = batch
        if old is not None:
            release(old)

    def groups(self) -> DataFrame:
        """(region, part, n_lines, revenue, min_revenue, n_clients, n_items) after the last batch applied."""
        of = lambda kind, x: F.when(F.col("kind") == kind, x)
        return self.counts.groupBy("region", "part").agg(
            F.sum(of(VALUE, F.col("weight"))).alias("n_lines"), F.sum(of(VALUE, F.col("id") * F.col("weight"))).alias("revenue"), F.min(of(VALUE, F.col("id"))).alias("min_revenue"),
            F.count(of(CLIENT, F.col("id"))).alias("n_clients"), F.count(of(ITEM, F.col("id"))).alias("n_items"),
        )

    def drop(self) -> None:
        """Deletes the logs and the counts."""
        for log in (self.clients, self.sales, self.pairs, self.lines):
            log.drop()
        for frame in (*self.hot, *([self.counts] if self.counts is not None else [])):
            release(frame)


def through_batches(clients: DataFrame, sales: DataFrame, lines: DataFrame, vendors: DataFrame, nation: DataFrame, batches: int = BATCHES) -> DataFrame:
    """batch and the groups of the view after each of the batches 0 to batches - 1."""
    view, out = SalesView(clients, sales, lines, vendors, nation), []
    view.step(START)
    for batch in range(batches):
        view.step(batch)
        out.append(materialise(view.groups().select(F.lit(batch).alias("batch"), "*"), "groups"))
    view.drop()
    return reduce(DataFrame.unionByName, out)
