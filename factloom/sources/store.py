"""A store: the relations that all plans read."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

CELL = ("cik", "concept_key", "product_key", "period_end", "period_start_key")


def place(*cell: str) -> Column:
    """A fact's place in its cell, from 1: the newest filing, then the preferred unit, then the highest id."""
    return F.row_number().over(Window.partitionBy(*cell).orderBy(F.desc("filed_date"), F.asc("unit_rank"), F.desc("id")))


@dataclass(frozen=True)
class Store:
    company: DataFrame
    filing: DataFrame
    fact: DataFrame
    verification: DataFrame
    scale: DataFrame
    #: A way of its own to `dealt` and, where it is told so, to `ranked`; None: from the relations.
    deal: Callable[[int, bool], DataFrame] | None = None

    def replaced(self, **given: DataFrame) -> Store:
        """The store with the given relations in place of its own."""
        return replace(self, **given)

    def with_facts(self, fact: DataFrame) -> Store:
        return self.replaced(fact=fact.drop("behind"), deal=None)  # other facts, other places

    def dealt(self, tasks: int) -> DataFrame:
        """`dated` over so many tasks by ranges of concept, company and period."""
        return self.deal(tasks, False) if self.deal is not None else self.dated().repartitionByRange(tasks, "concept_key", "cik", "period_end")

    def ranked(self, tasks: int) -> DataFrame:
        """`dealt`, with how many facts of its cell come before each (`behind`). All facts of a cell are dealt to one task,
        so their places cost no further shuffle."""
        return self.deal(tasks, True) if self.deal is not None else self.dealt(tasks).withColumn("behind", place(*CELL) - 1)

    def dated(self, fact: DataFrame | None = None) -> DataFrame:
        """Facts with the form and date of their filing. A published fact carries both, so no plan joins the filings."""
        fact = self.fact if fact is None else fact
        lacking, fact = [c for c in ("filed_date", "form") if c not in fact.columns], fact.drop("behind")
        return fact.join(self.filing.select("accession", *lacking), "accession") if lacking else fact


TABLES = ("company", "filing", "fact", "verification", "scale")


class LazyStore(Store):
    """A store whose relations are opened when a plan first asks for them, so that what no plan asks for costs nothing."""

    def __init__(self, opened: Callable[[str], DataFrame], **given: DataFrame | None):
        for name, value in {"opened": opened, **given}.items():
            object.__setattr__(self, name, value)

    def __getattr__(self, name: str) -> DataFrame:  # asked only for what is not there yet
        if name not in TABLES:
            raise AttributeError(name)
        object.__setattr__(self, name, self.opened(name))
        return getattr(self, name)

    def __repr__(self) -> str:  # that of the fields would open them
        return f"LazyStore({', '.join(n for n in TABLES if n in vars(self))})"

    def replaced(self, **given: DataFrame) -> Store:
        return LazyStore(**(vars(self) | given))


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path is there, by the file system that Spark uses for it; a failing file system is an error."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


#: Columns that plans may ask for and an older store may lack; they are read as nulls. A fact's form and date are not
#: among them: where a store lacks these, they come from the filing.
SINCE_ADDED = {
    "company": {"cohort": "string", "country": "string", "listing_status": "string", "notes": "string"},
    "filing": {"period_end": "string", "primary_doc": "string"},
    "fact": {"unit_rank": "int", "extracted_by": "string", "source_span": "string"},
    "verification": {"document": "string"},
    "scale": {"divisor": "double"},
}


def migrated(frame: DataFrame, name: str) -> DataFrame:
    """A relation with the columns that came later, null where it lacks them."""
    return frame.withColumns({c: F.lit(None).cast(kind) for c, kind in SINCE_ADDED[name].items() if c not in frame.columns})


def open_older(spark: SparkSession, folder: str) -> Store:
    """A store that was written before some columns were."""
    own = open_store(spark, folder)
    return Store(**{name: migrated(getattr(own, name), name) for name in TABLES})


def open_store(spark: SparkSession, folder: str) -> Store:
    """A written store, read-only; a missing folder or table is an error that names it."""
    frames = {}
    for name in TABLES:
        if not exists(spark, f"{folder}/{name}"):
            raise FileNotFoundError(f"no table {name} in the store {folder}")
        frames[name] = spark.read.parquet(f"{folder}/{name}")
    return Store(**frames)


def tpch_store(spark: SparkSession, sf_dir: str) -> Store:
    """The store that the driver's tables describe: suppliers as companies, orders as filings, lines as facts.

    A fact's id is a digest of its row, so it needs no global numbering: every task makes the ids of its own rows. `deal`
    joins and deals lines as narrow as they are read, and makes facts of them last: an id alone is as long as half a line.
    """
    read = lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet")
    pad = lambda c: F.lpad(F.col(c).cast("string"), 10, "0")
    region = F.col("n_regionkey")
    company = read("supplier").join(F.broadcast(read("nation")), F.col("s_nationkey") == F.col("n_nationkey")).select(  # nation: 25 rows
        pad("s_suppkey").alias("cik"), F.col("s_name").alias("name"),
        F.when(F.col("s_suppkey") % 9 != 0, F.concat(F.lit("T"), F.col("s_suppkey").cast("string"))).alias("ticker"),
        F.when(region <= 2, "Oil & Gas E&P").when(region == 3, "Oil & Gas Integrated").alias("cohort"),
        (F.col("s_acctbal") >= 0).alias("is_operator"), F.col("n_name").alias("country"),
        F.when(F.col("s_suppkey") % 4 == 0, "private-filer").otherwise("listed").alias("listing_status"),
    )
    status = F.col("o_orderstatus")
    form, filed = F.when(status == "F", "10-K").when(status == "O", "20-F").otherwise("40-F"), F.date_format("o_orderdate", "yyyy-MM-dd")
    filing = read("orders").select(
        F.col("o_orderkey").cast("string").alias("accession"), pad("o_custkey").alias("cik"),
        form.alias("form"), filed.alias("filed_date"),
    )
    cents = lambda c: F.round(F.col(c) * 100).cast("bigint").cast("string")
    flag, part = F.col("l_returnflag"), F.col("l_linenumber") % 4
    identity = F.concat_ws("|", *[F.col(c).cast("string") for c in ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")], *[cents(c) for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")], "l_returnflag", "l_linestatus", F.date_format("l_shipdate", "yyyy-MM-dd"))
    product = F.when(part == 1, "oil").when(part == 2, "gas").when(part == 3, "ngl")
    concept = F.when(flag == "A", "proved_developed_reserves_boe").when(flag == "N", "proved_undeveloped_reserves_boe").otherwise("proved_reserves_boe")
    own = lambda rows, *more: rows.select(
        F.md5(identity).alias("id"), pad("l_suppkey").alias("cik"),
        concept.alias("concept_key"),
        F.col("l_extendedprice").alias("value"), F.when(F.col("l_linestatus") == "F", "MBoe").otherwise("MMcfe").alias("unit"),
        F.when(F.col("l_linestatus") == "F", 0).otherwise(1).alias("unit_rank"), product.alias("product"), F.coalesce(product, F.lit("")).alias("product_key"),
        F.concat(F.year("l_shipdate").cast("string"), F.lit("-12-31")).alias("period_end"), F.lit("").alias("period_start_key"),
        F.col("l_orderkey").cast("string").alias("accession"), F.lit("us-gaap").alias("taxonomy"),
        F.when(flag == "A", "ProvedDevelopedReservesVolume").when(flag == "N", "ProvedUndevelopedReserveVolume").otherwise("ProvedDevelopedAndUndevelopedReservesNet").alias("tag"),
        F.lit("xbrl").alias("extracted_by"), *more,
    )
    items = read("lineitem")
    lines = own(items, F.col("l_discount").alias("mark"), F.col("l_tax").alias("tax"))

    filer, year = F.substring(F.col("l_suppkey").cast("string"), 1, 10).cast("bigint"), F.year("l_shipdate")  # one for each cik and period_end

    def deal(tasks: int, ranked: bool) -> DataFrame:
        orders = read("orders").select("o_orderkey", form.alias("form"), "o_orderdate")
        met = items.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).drop("o_orderkey")
        dealt = own(met.repartitionByRange(tasks, concept, filer, year), "form", filed.alias("filed_date"), filer.alias("filer"), year.alias("year"))
        return (dealt.withColumn("behind", place("concept_key", "filer", "year", "product_key") - 1) if ranked else dealt).drop("filer", "year")

    status = F.when(F.col("mark") > 0.05, "found").when(F.col("mark") > 0.02, "not_found")
    verification = lines.select(F.col("id").alias("fact_id"), status.alias("status"), F.concat(F.lit("doc-"), F.col("accession"), F.lit(".htm")).alias("document")).where(F.col("status").isNotNull())
    factor = F.when(F.col("unit") == "MBoe", F.lit(1000.0)).otherwise(F.lit(1e6 / 6000.0))
    scale = lines.where(F.col("tax") < 0.05).select(F.col("id").alias("fact_id"), F.lit(1.0).alias("divisor"), (F.col("value") * factor).alias("canonical_value"), F.lit("BOE").alias("canonical_unit"))
    return Store(company, filing, lines.drop("mark", "tax"), verification, scale, deal)
