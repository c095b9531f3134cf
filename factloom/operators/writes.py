"""Writes as pure functions of the old relation and the new rows.

Parquet has no update in place: each function returns the whole next relation (or the rows to append), and
`publish` swaps it in by writing a new folder.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from factloom.session import kept
from factloom.sources.store import TABLES, LazyStore, Store

IDENTITY = ("cik", "concept_key", "product_key", "period_end", "period_start_key", "unit", "accession", "extracted_by")


def on(keys: tuple[str, ...] | list[str], a: DataFrame, b: DataFrame) -> Column:
    """Equality on all keys, null equal to null."""
    return reduce(lambda x, y: x & y, [a[k].eqNullSafe(b[k]) for k in keys])


def new_facts(old: DataFrame, rows: DataFrame, ordinal: str = "ordinal", identity: tuple[str, ...] = IDENTITY) -> DataFrame:
    """The rows to append: the first of each identity by ordinal that the old facts do not hold yet. Old identities, as
    narrow as they are, stand before the rows in one window, so each side is shuffled once and null is equal to null."""
    known = old.select(*[F.col(c).cast(rows.schema[c].dataType).alias(c) for c in identity], F.lit(True).alias("known"))
    both = rows.withColumn("known", F.lit(False)).unionByName(known, allowMissingColumns=True)
    first = Window.partitionBy(*identity).orderBy(F.desc("known"), ordinal)
    return both.withColumn("rn", F.row_number().over(first)).where("rn = 1").where("not known").select(*rows.columns)


def insert_facts(old: DataFrame, rows: DataFrame, ordinal: str = "ordinal", identity: tuple[str, ...] = IDENTITY) -> DataFrame:
    """The facts after an append that skips what is there; the ordinal is dropped unless the facts have it."""
    fresh = new_facts(old, rows, ordinal, identity)
    return old.unionByName(fresh if ordinal in old.columns else fresh.drop(ordinal))


def upsert(old: DataFrame, rows: DataFrame, key: str, refresh: tuple[str, ...] = (), fill: tuple[str, ...] = (), defaults: dict | None = None) -> DataFrame:
    """Merge on a key. refresh: the new value wins where it is not null; fill: the old value wins where it is not null;
    any other column keeps the old value of a known key. defaults: for null columns of a key seen first."""
    a, b = old.alias("a"), rows.alias("b")
    joined = a.join(b, F.col(f"a.{key}") == F.col(f"b.{key}"), "full_outer")
    known = F.col(f"a.{key}").isNotNull()
    out = []
    for c in old.columns:
        before = F.col(f"a.{c}")
        after = F.col(f"b.{c}") if c in rows.columns else F.lit(None).cast(old.schema[c].dataType)
        if c == key or c in fill:
            value = F.coalesce(before, after)
        elif c in refresh:
            value = F.coalesce(after, before)
        else:
            value = F.when(known, before).otherwise(after)
        if defaults and c in defaults:
            value = F.when(known, value).otherwise(F.coalesce(value, F.lit(defaults[c])))
        out.append(value.alias(c))
    return joined.select(*out)


def upsert_company(old: DataFrame, rows: DataFrame) -> DataFrame:
    """New values win where they are not null; a company seen first is an operator unless said otherwise."""
    return upsert(old, rows, "cik", refresh=tuple(c for c in old.columns if c != "cik"), defaults={"is_operator": True} if "is_operator" in old.columns else None)


def record_filing(old: DataFrame, rows: DataFrame) -> DataFrame:
    """Only blanks of period_end and primary_doc are filled; form, company and date never change."""
    return upsert(old, rows, "accession", fill=tuple(c for c in ("period_end", "primary_doc") if c in old.columns))


def replace_by_key(old: DataFrame, rows: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Rows of the given keys replace the old ones."""
    given = rows.select(*keys).distinct()
    return old.join(given, on(keys, old, given), "left_anti").unionByName(rows, allowMissingColumns=True)


def append_snapshot(old: DataFrame, rows: DataFrame, at: Column) -> DataFrame:
    """Adds a snapshot; earlier ones stay."""
    return old.unionByName(rows.withColumn("taken_at", at), allowMissingColumns=True)


def delete_matching(old: DataFrame, gone: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    return old.join(gone, on(keys, old, gone), "left_anti")


def clear_scale(scale: DataFrame, facts: DataFrame) -> DataFrame:
    """scale without the records of the given facts, which are then to be resolved anew. facts: id."""
    return delete_matching(scale, facts.select(F.col("id").alias("fact_id")), ("fact_id",))


def prune_incoherent(facts: DataFrame, rejected: DataFrame) -> DataFrame:
    """Drops tagged facts of rejected (cik, concept_key, taxonomy, tag, period_end); others stay whatever their period."""
    keys = ("cik", "concept_key", "taxonomy", "tag", "period_end")
    tagged = facts.where(F.col("extracted_by") == "xbrl")
    return delete_matching(tagged, rejected.select(*keys), keys).unionByName(facts.where(~F.col("extracted_by").eqNullSafe("xbrl")))


def reconcile_cohort(company: DataFrame, admitted: DataFrame, note: str) -> DataFrame:
    """Members that are not admitted lose their cohort and get a note."""
    inside = admitted.select("cik", F.lit(True).alias("in_now")).distinct()
    stale = F.col("cohort").isNotNull() & F.col("in_now").isNull()
    out = company.join(inside, "cik", "left").withColumn("stale", stale)
    if "notes" in company.columns:
        out = out.withColumn("notes", F.when(F.col("stale"), F.lit(note)).otherwise(F.col("notes")))
    return out.withColumn("cohort", F.when(~F.col("stale"), F.col("cohort"))).select(*company.columns)


def changed_sections(verification: DataFrame, sections: DataFrame) -> DataFrame:
    """Sets the section where it differs; sections: (fact_id, section)."""
    new = sections.select("fact_id", F.col("section").alias("new_section"), F.lit(True).alias("given"))
    value = F.when(F.col("given") & ~F.col("section").eqNullSafe(F.col("new_section")), F.col("new_section")).otherwise(F.col("section"))
    return verification.join(new, "fact_id", "left").withColumn("section", value).select(*verification.columns)


def backfill_filings(filing: DataFrame, submissions: DataFrame) -> DataFrame:
    """Fills a null period_end and primary_doc from the submissions; an empty string there counts as null."""
    given = submissions.select("accession", F.nullif("period_end", F.lit("")).alias("p"), F.nullif("primary_doc", F.lit("")).alias("d")).dropDuplicates(["accession"])
    out = filing.join(given, "accession", "left")
    return out.withColumn("period_end", F.coalesce("period_end", "p")).withColumn("primary_doc", F.coalesce("primary_doc", "d")).select(*filing.columns)


class ConstraintError(ValueError):
    """Rows that break a rule of the store."""


def repeated(frame: DataFrame, key: str) -> DataFrame:
    """(key, count): the keys of several rows. Rows are counted by a short hash of their key; only those whose hash comes
    again are counted by the key itself, so where few repeat no long keys are shuffled."""
    again = kept(frame.groupBy(F.xxhash64(key).alias("hash")).count().where("count > 1").select("hash"), "hashes")
    return frame.select(key, F.xxhash64(key).alias("hash")).join(again, "hash", "left_semi").groupBy(key).count().where("count > 1")


#: The relations that have rules, and their keys.
RULED = {"company": "cik", "filing": "accession", "fact": "id"}


def faults(store: Store, names: Iterable[str] = tuple(RULED)) -> DataFrame:
    """(rule, n): how many rows break each rule of the named relations: keys are unique, facts refer to a filing and a
    company, and model-made facts carry their source. Each rule is an aggregate or an anti-join."""
    count = lambda rule, rows: rows.agg(F.count("*").alias("n")).select(F.lit(rule).alias("rule"), "n")
    rules = [count(f"{name}: repeated keys", repeated(getattr(store, name), RULED[name])) for name in names]
    if "company" in names:
        rules.append(count("company: repeated tickers", repeated(store.company.where(F.nullif("ticker", F.lit("")).isNotNull()), "ticker")))
    if "fact" in names:
        rules += [count(f"fact: rows without their {key}", store.fact.join(other.select(key), key, "left_anti")) for key, other in (("accession", store.filing), ("cik", store.company))]
        if "source_span" in store.fact.columns:
            rules.append(count("fact: model-made rows without a source", store.fact.where(F.col("extracted_by").startswith("llm:") & F.col("source_span").isNull())))
    return reduce(DataFrame.unionByName, rules)


def check(store: Store, names: Iterable[str] = tuple(RULED)) -> None:
    """Raises where a rule of the named relations is broken; one row a rule reaches the driver."""
    broken = [f"{r['rule']}: {r['n']}" for r in faults(store, names).where("n > 0").collect()]
    if broken:
        raise ConstraintError("; ".join(sorted(broken)))


#: Facts that one file of a published store holds, about; and its compression: ids are digits of a digest, of which codecs
#: that only look for repeats save nothing.
FILE_FACTS, CODEC = 2_000_000, "zstd"


def publish(store: Store, folder: str, overwrite: bool = False, checked: bool = True, file_facts: int = FILE_FACTS) -> None:
    """Writes the serving copy: all relations but the document index. Facts carry the form and date of their filing and how
    many facts of their cell come before them, which makes the current ones a filter; they are partitioned by concept, dealt by ranges of concept and company into as many tasks as their count asks for, and sorted
    by company and period, so that any number of machines shares one concept and filters on company skip row groups."""
    if checked:
        check(store)
    for name in TABLES:
        _publish(store, name, folder, "overwrite" if overwrite else "errorifexists", file_facts)


def _publish(store: Store, name: str, folder: str, mode: str, file_facts: int) -> None:
    frame = getattr(store, name)
    if name == "fact":
        dealt = store.ranked(max(1, -(-frame.count() // file_facts))).sortWithinPartitions("concept_key", "cik", "period_end")
        dealt.write.mode(mode).option("compression", CODEC).partitionBy("concept_key").parquet(f"{folder}/{name}")
    else:
        frame.write.mode(mode).option("compression", CODEC).parquet(f"{folder}/{name}")


def published(store: Store, folder: str, done: set[str], file_facts: int = FILE_FACTS) -> Store:
    """The serving copy below a folder of its own, each relation published and checked when a plan first asks for it; facts
    are checked against companies and filings, so these come with them. done: the names of those that are there."""

    def opened(name: str) -> DataFrame:
        spark = store.company.sparkSession
        if name not in done:
            _publish(store, name, folder, "overwrite", file_facts)
            if name in RULED:  # over the written relations, which nothing has to be made for
                check(copy.replaced(**{name: spark.read.parquet(f"{folder}/{name}")}), (name,))
            done.add(name)
        return spark.read.parquet(f"{folder}/{name}")

    copy = LazyStore(opened)
    return copy


#: Rows that one CSV file may hold.
CSV_ROWS = 1_000_000


def copy_columns(source: DataFrame, target_schema) -> DataFrame:
    """Copies by name: columns that the source lacks become null, others are left out."""
    return source.select(*[(F.col(f.name) if f.name in source.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in target_schema.fields])


def write_csv(rows: DataFrame, path: str, order: str, separator: str = "|", most: int = CSV_ROWS) -> None:
    """One CSV file with a header, sorted; arrays are joined. It is a file for people, written by one task, so more than
    `most` rows are refused, before anything is sorted."""
    if (n := rows.limit(most + 1).count()) > most:
        raise ValueError(f"over {most} rows ({n} at least) are too many for one file")
    flat = rows.select(*[F.array_join(F.col(c), separator).alias(c) if t.startswith("array") else F.col(c) for c, t in rows.dtypes])
    flat.coalesce(1).sortWithinPartitions(order).write.mode("overwrite").csv(path, header=True)
