"""What the store knows to be questionable, and where a number comes from."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factloom.functions.names import document_url, filing_url
from factloom.plans.panel import scoped
from factloom.plans.views import fact_collision, fact_current, reserve_consistency, unit_discontinuity
from factloom.registry import FAMILY, concepts_frame
from factloom.sources.store import CELL, Store, place

FALLBACK_TAG = "RevenueFromContractWithCustomerExcludingAssessedTax"
RESERVE_BASE = (*FAMILY, "standardized_measure", "production_volume")


def _named(store: Store, rows: DataFrame) -> DataFrame:
    return rows.join(store.company.select("cik", "name", "ticker"), "cik")


def discontinuities(store: Store) -> DataFrame:
    return _named(store, unit_discontinuity(store)).orderBy("name")


def collisions(store: Store, limit: int = 200) -> DataFrame:
    """The first `limit` in the order of names and newest periods, ties by the remaining columns."""
    return _named(store, fact_collision(store)).orderBy("name", F.desc("period_end"), "concept_key", "product", "min_value", "max_value").limit(limit)


def fallback_tags(store: Store, tag: str = FALLBACK_TAG) -> DataFrame:
    """Cells that rest on a tag of last resort."""
    current = fact_current(store).where(F.col("tag") == tag)
    return _named(store, current.groupBy("cik", "concept_key", "tag").agg(F.count("*").alias("cells"))).orderBy("name")


def reserve_issues(store: Store) -> DataFrame:
    rows = _named(store, reserve_consistency(store).where(F.col("issue").isNotNull()))
    return rows.withColumn("developed_url", filing_url(F.col("cik"), F.col("developed_accession"))).withColumn("total_url", filing_url(F.col("cik"), F.col("total_accession")))


def alias_verdicts(store: Store, validation: DataFrame) -> DataFrame:
    """Drifted and incoherent filers with their chosen tags. validation: (cik, concept_key, tag, status, ...)."""
    bad = validation.where(F.col("status").isin("drifted", "incoherent"))
    chosen = F.array_join(F.sort_array(F.collect_list(F.concat_ws("=", "concept_key", "tag"))), " | ")
    return _named(store, bad.groupBy("cik", "status", "coherent_periods", "tested_periods", "median_error").agg(chosen.alias("chosen"))).orderBy("status", "name")


def unreached(store: Store) -> DataFrame:
    """Private filers with a reserve or production concept."""
    private = store.company.where(F.col("listing_status") == "private-filer").select("cik", "name")
    rows = store.fact.groupBy("cik").agg(F.countDistinct("concept_key").alias("concepts"), F.max("period_end").alias("latest_period"), F.count_if(F.col("concept_key").isin(*RESERVE_BASE)).alias("n")).where("n > 0").drop("n")
    return rows.join(private, "cik")


def reserve_ratios(store: Store) -> DataFrame:
    """Developed over total where nothing is at fault, of members."""
    rows = reserve_consistency(store).where(F.col("issue").isNull() & F.col("ratio").isNotNull())
    return rows.join(scoped(store.company).select("cik", "name", "ticker"), "cik").orderBy("ratio")


def companies_with(store: Store, facts: DataFrame) -> DataFrame:
    """Companies with any of the given facts."""
    return store.company.join(facts.select("cik"), "cik", "left_semi")


def silent_filings(store: Store) -> DataFrame:
    """Filings that no fact cites."""
    return store.filing.join(store.fact.select("accession"), "accession", "left_anti")


def unverified(store: Store) -> DataFrame:
    """Facts that nobody looked for yet."""
    return store.fact.join(store.verification.select(F.col("fact_id").alias("id")), "id", "left_anti")


def of_status(store: Store, status: str) -> DataFrame:
    """Facts whose verification ended with a status."""
    return store.fact.join(store.verification.where(F.col("status") == status).select(F.col("fact_id").alias("id")), "id", "left_semi")


def _cited(store: Store, facts: DataFrame) -> DataFrame:
    labels = F.broadcast(concepts_frame(store.fact.sparkSession).select("concept_key", "label"))  # the registry
    v = store.verification.select(F.col("fact_id").alias("id"), F.col("status").alias("verify_status"), "document")
    s = store.scale.select(F.col("fact_id").alias("id"), "canonical_value", "canonical_unit", F.col("divisor").alias("scale_divisor"))
    rows = facts.join(store.company.select("cik", "name", "ticker"), "cik").join(labels, "concept_key", "left").join(v, "id", "left").join(s, "id", "left")
    return rows.select(
        "id", "cik", "name", "ticker", "concept_key", F.coalesce("label", "concept_key").alias("label"), "value", "unit", "product", "period_end", "accession", "form", "tag", "filed_date", "verify_status", "document", "canonical_value", "canonical_unit", "scale_divisor",
        filing_url(F.col("cik"), F.col("accession")).alias("filing_url"), document_url(F.col("cik"), F.col("accession"), F.col("document")).alias("document_url"),
    )


def fact_locator(store: Store, ids: list[str] | DataFrame) -> DataFrame:
    """Where current facts stand; a superseded or unknown id gives no row."""
    wanted = _ids(store, ids)
    cells = store.fact.join(wanted, "id", "left_semi").select("cik", "concept_key", "product_key", "period_end").distinct()
    rivals = store.fact.join(cells, ["cik", "concept_key", "product_key", "period_end"], "left_semi")
    return _cited(store, fact_current(store, rivals).join(wanted, "id", "left_semi"))


def citation(store: Store, ids: list[str] | DataFrame) -> DataFrame:
    """The source of any fact, superseded ones too."""
    facts = store.fact.join(_ids(store, ids), "id", "left_semi")
    return _cited(store, store.dated(facts))


def _ids(store: Store, ids: list[str] | DataFrame) -> DataFrame:
    return ids.select("id") if isinstance(ids, DataFrame) else store.fact.sparkSession.createDataFrame([(i,) for i in ids], "id string")


def superseded(store: Store) -> DataFrame:
    """Facts that a later one of their cell replaced, with how many cells' facts came before them."""
    facts = store.fact if "behind" in store.fact.columns else store.dated().withColumn("behind", place(*CELL) - 1)
    return facts.where("behind > 0").select("id", "cik", "concept_key", F.col("behind").cast("long").alias("behind"))
