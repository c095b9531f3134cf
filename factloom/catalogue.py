"""The registered queries over the driver's tables; `oracles` has the SQL that each is held against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factloom.functions import text, units
from factloom.operators import clusters, crosscheck, identity, merges, scale, sites, validation, writes
from factloom.plans import counts, panel, quality, series, views
from factloom.registry import DEVELOPED, FAMILY, TOTAL
from factloom.session import kept, work_folder, work_path
from factloom.sources import payloads
from factloom.sources.store import Store, tpch_store

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
COHORT = "Oil & Gas E&P"
PERIOD = "1998-12-31"
CIK = "0000000001"
TEST_SPEC = sites.TableSpec("test", ("of the", "and the", "in the"), (sites.Category("of", ("of the",)), sites.Category("and", ("and the",)), sites.Category("in", ("in the",))), frozenset({"of", "and"}))


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


#: Where the stores of a session's folders of tables are, and which of their relations are there.
_PUBLISHED: dict[tuple[str, str], tuple[str, set[str]]] = {}


def served(spark: SparkSession, sf_dir: str) -> Store:
    """The store over the driver's tables, each relation published once a session into the shared folder, when the first
    query asks for it, and read from there."""
    key = spark.sparkContext.applicationId, sf_dir
    if key not in _PUBLISHED:
        _PUBLISHED[key] = work_path(spark, "store"), set()
    return writes.published(tpch_store(spark, sf_dir), *_PUBLISHED[key], file_facts=100_000)


def over_store(name: str, plan: Callable[[Store], DataFrame]) -> None:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return plan(served(spark, sf_dir))

    run.__name__ = name
    QUERIES[name] = run


VIEW = ("id", "cik", "concept_key", "value", "unit", "product", "period_end", "accession", "form", "filed_date")
over_store("fact_current", lambda s: views.fact_current(s).select(*VIEW))
over_store("fact_collision", views.fact_collision)
over_store("unit_discontinuity", views.unit_discontinuity)
over_store("reserve_consistency", views.reserve_consistency)
over_store("fact_verified", lambda s: views.fact_verified(s).select(*VIEW, "verify_status", "verify_document"))
over_store("fact_canonical", lambda s: views.fact_canonical(s).select(*VIEW, "verify_status", "canonical_value", "canonical_unit"))
over_store("panel", lambda s: panel.panel(s, TOTAL, PERIOD))
over_store("panel_product", lambda s: panel.panel(s, DEVELOPED, PERIOD, product="oil", cohort=COHORT))
over_store("panel_latest", lambda s: panel.panel_latest(s, TOTAL))
over_store("panel_latest_cohort", lambda s: panel.panel_latest(s, DEVELOPED, product="gas", cohort=COHORT))
WIDE = ("cik", "name", "ticker", "cohort", "product_key", "n_cells", *[f"{k}__{c}" for k in FAMILY for c in ("value", "unit", "period", "verified", "canonical")])
over_store("panel_wide", lambda s: panel.panel_wide(s).select(*WIDE))
over_store("panel_wide_all", lambda s: panel.panel_wide(s, period=PERIOD, include_uncohorted=True).select(*WIDE))
over_store("unit_groups", lambda s: panel.unit_groups(panel.panel(s, TOTAL, PERIOD)))
over_store("column_units", lambda s: panel.column_units(panel.latest_cells(s)))
over_store("company_series", lambda s: series.company_series(s, CIK))
over_store("company_history", lambda s: series.company_history(s, CIK, TOTAL))
over_store("trends", lambda s: series.trends(s, TOTAL))
over_store("summary", counts.summary)
over_store("summary_cohort", lambda s: counts.summary(s, COHORT))
over_store("concepts", counts.concepts)
over_store("periods", counts.periods)
over_store("cohorts", counts.cohorts)
over_store("companies", counts.companies)
over_store("coverage_matrix", counts.coverage_matrix)
over_store("company_concepts", counts.company_concepts)
over_store("dq_discontinuities", quality.discontinuities)
over_store("dq_collisions", quality.collisions)
over_store("dq_fallback_tags", lambda s: quality.fallback_tags(s, "ProvedDevelopedReservesVolume"))
over_store("dq_reserve_issues", quality.reserve_issues)
over_store("dq_unreached", quality.unreached)
over_store("reserve_ratios", quality.reserve_ratios)
over_store("citation", lambda s: quality.citation(s, s.verification.where("status = 'not_found'").select(F.col("fact_id").alias("id"))))
over_store("fact_locator", lambda s: quality.fact_locator(s, s.verification.where("status = 'found'").select(F.col("fact_id").alias("id"))))
over_store("superseded", quality.superseded)
# Joins
over_store("semi_exists", lambda s: quality.companies_with(s, s.fact.where("concept_key = 'proved_reserves_boe' and unit = 'MBoe'")).select("cik", "name"))
over_store("anti_not_exists", lambda s: quality.silent_filings(s).select("accession", "form", "filed_date"))
over_store("not_in_unverified", lambda s: quality.unverified(s).groupBy("concept_key").agg(F.count("*").alias("n")))
over_store("in_not_found", lambda s: quality.of_status(s, "not_found").groupBy("concept_key", "unit").agg(F.count("*").alias("n")))


@query
def nullsafe_crosscheck(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Developed against total cells of one company, product and period, null equal to null."""
    cells = views.fact_current(served(spark, sf_dir))
    read = cells.where(F.col("concept_key") == DEVELOPED).withColumn("concept_key", F.lit(TOTAL)).select("cik", "concept_key", "product", "period_end", "value", "unit")
    checked = crosscheck.cross_check(read, cells.where(F.col("concept_key") == TOTAL), tolerance=0.01)
    return checked.groupBy("outcome").agg(F.count("*").alias("n"))


# Writes
def _halves(s: Store) -> tuple[DataFrame, DataFrame]:
    """Old facts and new ones that repeat a part of them."""
    old = s.fact.where(F.col("concept_key") != TOTAL)
    new = s.fact.where(F.col("concept_key") != DEVELOPED).withColumn("ordinal", F.col("id"))
    return old, new


over_store("insert_idempotent", lambda s: writes.insert_facts(*_halves(s)).groupBy("concept_key").agg(F.count("*").alias("n"), F.min("id").alias("first_id"), F.max("id").alias("last_id")))


@query
def appended_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facts appended to a written relation: rows by concept after it, whether every file that was there is there still,
    and whether the concept got files."""
    folder = work_path(spark, "facts")
    old, new = _halves(served(spark, sf_dir))
    merges.lay_out(old, folder, "cik", by=("concept_key",))
    before = spark.read.parquet(folder).select("concept_key", F.input_file_name().alias("file")).distinct()
    before = kept(before, "files")
    merges.append_new(spark, folder, new)
    rows = merges.read(spark, folder).select("concept_key", "id", F.input_file_name().alias("file"))
    files = rows.select("concept_key", "file").distinct().join(before.withColumn("old", F.lit(True)), ["concept_key", "file"], "full_outer")
    # A file that went would have no rows now, and be counted here as old without any.
    still = rows.select("file").distinct().withColumn("there", F.lit(True))
    seen = files.join(still, "file", "left").groupBy("concept_key").agg(F.bool_and(F.col("there").isNotNull()).alias("kept_files"), F.bool_or(F.col("old").isNull()).alias("new_files"))
    return rows.groupBy("concept_key").agg(F.count("*").alias("n"), F.min("id").alias("first_id"), F.max("id").alias("last_id")).join(seen, "concept_key")


@query
def merged_companies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Companies refreshed in place by some filers' new data and one unknown company, and some of them removed."""
    folder = work_path(spark, "companies")
    company = served(spark, sf_dir).company
    merges.lay_out(company, folder, "cik", part_rows=20)
    n = F.col("cik").cast("long")
    new = company.where(n % 50 == 7).select("cik", F.concat("name", F.lit(" II")).alias("name"), F.lit(None).cast("string").alias("ticker"), F.lit("Canada").alias("country"))
    extra = spark.createDataFrame([("9999999999", "Fresh", "NEW", None)], "cik string, name string, ticker string, country string")
    merges.merge(spark, folder, new.unionByName(extra), "cik", writes.upsert_company)
    merges.merge(spark, folder, company.where(n % 50 == 9).select("cik"), "cik", lambda old, gone: writes.delete_matching(old, gone, ("cik",)))
    return merges.read(spark, folder).select("cik", "name", "ticker", "cohort", "country", "is_operator")


@query
def upsert_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Companies refreshed by the private filers' new data and one unknown company."""
    old = served(spark, sf_dir).company
    new = old.where("listing_status = 'private-filer'").select("cik", F.concat("name", F.lit(" II")).alias("name"), F.lit(None).cast("string").alias("ticker"), F.lit("Canada").alias("country"))
    extra = spark.createDataFrame([("9999999999", "Fresh", "NEW", None)], "cik string, name string, ticker string, country string")
    return writes.upsert_company(old, new.unionByName(extra)).select("cik", "name", "ticker", "cohort", "country", "is_operator")


@query
def upsert_fill_blanks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Filings whose period is blank are filled; what is there stays."""
    filing = served(spark, sf_dir).filing
    old = filing.withColumn("period_end", F.when(F.col("form") == "10-K", F.concat(F.substring("filed_date", 1, 4), F.lit("-12-31"))))
    new = filing.select("accession", F.lit("1999-06-30").alias("period_end"), F.lit("ignored").alias("form"))
    return writes.record_filing(old, new).select("accession", "form", "filed_date", "period_end")


@query
def prune_reinsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facts of rejected periods are dropped."""
    s = served(spark, sf_dir)
    values = _values(s)
    triples = validation.tag_triples(values)
    verdicts = validation.validate_family(values, s.fact.select("cik"))
    rejected = validation.rejected_periods(triples, verdicts).withColumn("taxonomy", F.lit("us-gaap"))
    return writes.prune_incoherent(s.fact, rejected.distinct()).groupBy("concept_key").agg(F.count("*").alias("n"))


over_store("reconcile_cohort", lambda s: writes.reconcile_cohort(s.company, s.company.where("is_operator"), "not admitted").groupBy("cohort").agg(F.count("*").alias("n")))


@query
def serving_copy_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of each relation of the serving copy."""
    s = served(spark, sf_dir)
    one = lambda name, df: df.agg(F.count("*").alias("n")).select(F.lit(name).alias("relation"), "n")
    out = one("company", s.company)
    for name in ("filing", "fact", "verification", "scale"):
        out = out.unionByName(one(name, getattr(s, name)))
    return out


# Ingest
@query
def companyfacts_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facts nested into payloads, one a company as filers publish them, and flattened again by the registry."""
    s = served(spark, sf_dir)
    dated = s.dated()
    o = F.struct(F.lit(None).cast("string").alias("start"), F.col("period_end").alias("end"), F.col("value").alias("val"), F.col("accession").alias("accn"), F.lit(None).cast("int").alias("fy"), F.lit(None).cast("string").alias("fp"), "form", F.col("filed_date").alias("filed"), F.lit(None).cast("string").alias("frame"))
    by_unit = dated.groupBy("cik", "taxonomy", "tag", "unit").agg(F.collect_list(o).alias("o"))
    by_tag = by_unit.groupBy("cik", "taxonomy", "tag").agg(F.struct(F.map_from_entries(F.collect_list(F.struct("unit", "o"))).alias("units")).alias("body"))
    by_taxonomy = by_tag.groupBy("cik", "taxonomy").agg(F.map_from_entries(F.collect_list(F.struct("tag", "body"))).alias("tags"))
    payload = by_taxonomy.groupBy("cik").agg(F.map_from_entries(F.collect_list(F.struct("taxonomy", "tags"))).alias("facts")).select(F.struct("cik", F.lit(None).cast("string").alias("entityName"), "facts").alias("payload")).select(F.to_variant_object("payload").alias("payload"))
    rows = payloads.fact_rows(payloads.observations(payload), forms=("10-K", "20-F"))
    return rows.select("cik", "concept_key", "taxonomy", "tag", "value", "unit", "period_end", "accession", "form", "filed", "unit_rank")


def _observations(s: Store) -> DataFrame:
    dated = s.dated()
    return dated.select("cik", "taxonomy", "tag", "unit", F.lit(0).alias("ordinal"), F.lit(None).cast("string").alias("start"), F.col("period_end").alias("end"), F.col("value").alias("val"), F.col("accession").alias("accn"), F.lit(None).cast("int").alias("fy"), F.lit(None).cast("string").alias("fp"), "form", F.col("filed_date").alias("filed"), F.lit(None).cast("string").alias("frame"))


over_store("coverage_snapshot", lambda s: payloads.coverage(_observations(s), s.company.select("cik")))


def _values(s: Store) -> DataFrame:
    dated = s.dated().withColumnRenamed("filed_date", "filed")
    return validation.candidate_values(dated.select("cik", "concept_key", "tag", "unit", "period_end", "filed", F.col("id").alias("ordinal"), "value", F.lit(1).alias("alias_ord")))


@query
def alias_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = served(spark, sf_dir)
    out = validation.validate_family(_values(s), s.company.select("cik"))
    return out.select("cik", "status", "unit", "tested_periods", "coherent_periods", F.round("median_error", 6).alias("median_error"), "incoherent")


# Scale
@query
def unit_conversion(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact = served(spark, sf_dir).fact
    value = units.normalise(F.col("value"), F.col("unit"), F.lit(0.0))
    return fact.groupBy("unit").agg(F.count("*").alias("n"), F.round(F.max(value), 3).alias("most"), F.max(units.canonical_unit(F.col("unit"))).alias("canonical_unit"), F.max(units.conversion_note(F.col("unit"))).alias("note"))


def scale_rows(s: Store) -> DataFrame:
    """Total cells with a found scale for oil and a measure of a plausible value per barrel for liquids."""
    cells = views.fact_current(s, s.fact.where(F.col("concept_key") == TOTAL))
    return cells.select(
        "id", "cik", "period_end", "concept_key", "product_key", "value", "unit", F.when(F.col("product_key") == "oil", 1000.0).alias("scale"),
        F.array().cast("array<string>").alias("header_units"), F.lit(None).cast("int").alias("declared_scale"), F.when(F.col("product_key") != "ngl", F.col("value") * 12500.0).alias("measure"), "extracted_by",
    )


over_store("scale_candidates", lambda s: scale.readings(scale_rows(s)).select("id", "divisor", F.round("canonical", 3).alias("canonical"), "canonical_unit"))
over_store("scale_resolve", lambda s: scale.resolve(scale_rows(s)).select("id", "status", "divisor", F.round("usd_per_boe", 6).alias("usd_per_boe"), "n_viable"))
over_store("resolve_direct", lambda s: scale.resolve_direct(s.fact.select("id", "value", F.when(F.col("product_key") == "gas", "USD").otherwise(F.col("unit")).alias("unit")), s.scale.select(F.col("fact_id").alias("id"))).select("id", "canonical_value", "canonical_unit"))
over_store("resolve_periods", lambda s: scale.resolve_periods(scale_rows(s).withColumn("measure", F.col("value") * 12500.0)).groupBy("product_key", "canonical_unit").agg(F.count("*").alias("n"), F.round(F.max("canonical_value"), 3).alias("most")))


over_store("resolved_period_rows", lambda s: scale.resolve_periods(scale_rows(s).withColumn("measure", F.col("value") * 12500.0)).select("id", "divisor", F.round("canonical_value", 3).alias("canonical_value"), F.round("usd_per_boe", 6).alias("usd_per_boe")))


@query
def production_reserve_life(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Undeveloped cells in the part of production, held against the total cells as reserves."""
    s = served(spark, sf_dir)
    cells = views.fact_current(s)
    rows = cells.where(F.col("concept_key") == FAMILY[1]).withColumn("scale", F.lit(10.0))
    reserves = cells.where(F.col("concept_key") == TOTAL).select("cik", "period_end", "product_key", (F.col("value") * units.factor(F.col("unit"))).alias("canonical_value"))
    return scale.resolve_production(rows, reserves).select("id", "divisor", F.round("reserve_life", 6).alias("reserve_life"))


# Windows
over_store("top_n_filings_per_form", lambda s: clusters.first_rows(s.filing, ["cik", "form"], [F.desc("filed_date"), F.desc(F.col("accession").cast("long"))], 2).select("cik", "form", "accession", "filed_date"))
over_store("stratified_sample", lambda s: clusters.first_rows(s.fact, ["concept_key", "unit"], [F.asc("id")], 5).select("concept_key", "unit", "id"))


@query
def asof_section(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each event of a user the last signup at or before it."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    marks = events.where("event_type = 'signup'").select("user_id", "ts", "event_id")
    return clusters.nearest_before(events.select("user_id", "ts", F.col("event_id").alias("id"), "event_type"), marks, ["user_id"], "ts", "event_id").select("id", "user_id", F.col("nearest").alias("signup_id"))


@query
def gap_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions of users that end after twelve hours of silence."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet").select("user_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("at"))
    found = clusters.gap_clusters(events, ["user_id"], "at", 12 * 3600 * 1_000_000)
    return found.groupBy("user_id", "cluster").agg(F.count("*").alias("n"), F.min("at").alias("first_at"), F.max("at").alias("last_at")).select("user_id", F.col("cluster").cast("long").alias("cluster"), "n", "first_at", "last_at")


# Text
def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@query
def phrase_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = sites.document_lines(_documents(spark, sf_dir))
    return sites.phrase_lines(lines, TEST_SPEC).groupBy("document_id").agg(F.count("*").alias("n"), F.min("line_no").cast("long").alias("first_line"))


@query
def doc_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sites.document_lines(_documents(spark, sf_dir)).groupBy("document_id").agg(F.count("*").alias("lines"), F.max(F.length("text")).cast("long").alias("longest"))


@query
def sites_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = sites.sites(sites.document_lines(_documents(spark, sf_dir)), TEST_SPEC, gap=2)
    return found.select("document_id", F.col("rank").cast("long").alias("rank"), F.col("first_line").cast("long").alias("first_line"), F.col("last_line").cast("long").alias("last_line"), "label_hits", F.array_join("categories", ",").alias("categories"), "closable")


@query
def flatten_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return pages.select("page_id", text.flatten(F.col("html")).alias("flat"))


@query
def phrase_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _documents(spark, sf_dir).select("doc_id", text.phrases_count(F.col("text"), ("the", "tion", "er")).alias("n"))


@query
def snippets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first occurrence of a word with its surroundings and its line."""
    docs = _documents(spark, sf_dir).withColumn("at", F.instr("text", "the") - 1).where("at >= 0")
    return docs.select("doc_id", text.snippet(F.col("text"), F.col("at"), F.col("at") + 3, 20).alias("snippet"), text.line_of(F.col("text"), F.col("at")).cast("long").alias("line"))


# Identity
def _suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/supplier.parquet").withColumn("sic", F.element_at(F.array(*map(F.lit, ("1311", "6792", "2911", "1381", "9999"))), (F.col("s_suppkey") % 5 + 1).cast("int")))


@query
def primary_ticker(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("s_suppkey").cast("string")
    tickers = F.when(F.col("s_suppkey") % 3 == 0, F.array(F.concat(key, F.lit("-WT")))).otherwise(F.array(F.concat(F.lit("Z"), key, F.lit("-U")), F.concat(F.lit("B"), key), F.concat(F.lit("A"), key), F.concat(F.lit("AA"), key)))
    return _suppliers(spark, sf_dir).select("s_suppkey", identity.primary_ticker(tickers).alias("ticker"))


@query
def cohort_for(spark: SparkSession, sf_dir: str) -> DataFrame:
    cohort, reason = identity.cohort_of(F.col("sic"), F.lit(None).cast("string"))
    name = F.when(F.col("s_suppkey") % 7 == 0, F.concat("s_name", F.lit(" Royalty Partners"))).otherwise(F.col("s_name"))
    return _suppliers(spark, sf_dir).select("s_suppkey", "sic", cohort.alias("cohort"), reason.alias("reason"), identity.is_operator(F.col("sic"), name).alias("is_operator"))


@query
def producer_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = _suppliers(spark, sf_dir)
    return s.select("s_suppkey", identity.producer_verdict(F.when(F.col("s_suppkey") % 4 == 0, 2).otherwise(0), (F.col("s_suppkey") % 9).cast("int"), F.when(F.col("s_suppkey") % 6 == 0, 0).otherwise(1)).alias("verdict"))


@query
def listing_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = served(spark, sf_dir)
    number = F.col("accession").cast("long")
    filings = s.filing.withColumn("form", F.when(number % 4 == 0, "15-12G").when(number % 4 == 1, "8-K").otherwise(F.col("form")))
    who = filings.select("cik").distinct()
    return identity.listing_status(filings, who.where(F.col("cik").cast("long") % 3 == 0), who.where(F.col("cik").cast("long") % 11 == 0))


@query
def admission(spark: SparkSession, sf_dir: str) -> DataFrame:
    company = served(spark, sf_dir).company
    n = F.col("cik").cast("long")
    rows = company.select("cik", F.when(n % 13 == 0, "excluded by hand").alias("excluded"), "ticker", "cohort", F.lit("no cohort").alias("cohort_reason"), F.when(n % 5 == 0, "non-producer").when(n % 7 != 0, "producer").alias("verdict"))
    return identity.admission(rows).select("cik", "decision", "reason")


@query
def ticker_sync(spark: SparkSession, sf_dir: str) -> DataFrame:
    company = served(spark, sf_dir).company
    n = F.col("cik").cast("long")
    tickers = company.where(n % 5 != 0).select("cik", F.when(n % 6 == 0, F.concat(F.lit("N"), n.cast("string"))).otherwise(F.concat(F.lit("T"), n.cast("string"))).alias("ticker"))
    return identity.ticker_sync(company, tickers).groupBy("outcome").agg(F.count("*").alias("n"))


@query
def dedupe_issuers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers that share a ticker with one another, and those linked through them."""
    k = F.col("s_suppkey")
    tickers = F.array(F.concat(F.lit("A"), F.floor(k / 3).cast("string")), F.when(k % 5 <= 1, F.concat(F.lit("B"), F.floor(k / 10).cast("string"))))
    p = _suppliers(spark, sf_dir).select(F.lpad(k.cast("string"), 10, "0").alias("cik"), "s_name", tickers.alias("tickers"))
    p = p.select("cik", F.col("s_name").alias("name"), "tickers", F.array().cast("array<string>").alias("former_names"), F.lit("2000-01-01").alias("latest_annual"), F.lit(1).alias("annual_count"))
    work_folder(spark)  # sets the checkpoint folder where the session has none
    return identity.issuer_groups(p, lambda df: df.checkpoint()).select("cik", "issuer", "is_primary")


@query
def exhibit_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of an order in the part of a filing's attachments."""
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    items = lines.select(F.col("l_orderkey").alias("accession"), F.concat(F.lit("ex"), F.col("l_partkey").cast("string"), F.lit("-"), F.col("l_suppkey").cast("string"), F.when(F.col("l_returnflag") == "A", ".htm").when(F.col("l_returnflag") == "N", ".HTML").otherwise(".txt")).alias("document"), F.when(F.col("l_linenumber") % 2 == 1, "EX-99.1").otherwise("EX-10").alias("type"), F.floor("l_extendedprice").cast("long").alias("size"))
    return identity.exhibits(items, 25_000, 6).groupBy("accession").agg(F.count("*").alias("n"), F.max("size").alias("largest"))
