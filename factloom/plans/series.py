"""History of one company and trends over companies."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from factloom.functions.names import filing_url
from factloom.plans.panel import scoped
from factloom.plans.views import fact_current
from factloom.registry import BY_KEY, concepts_frame
from factloom.sources.store import Store


def company_series(store: Store, cik: str) -> DataFrame:
    """Every current cell of one company, in or out of a cohort."""
    labels = concepts_frame(store.fact.sparkSession).select("concept_key", "label")
    rows = fact_current(store, store.fact.where(F.col("cik") == cik)).join(F.broadcast(labels), "concept_key", "left")  # labels: the registry
    return rows.select("concept_key", F.coalesce("label", "concept_key").alias("label"), "value", "unit", "product", "period_end", "accession", "form", "tag", "filed_date", filing_url(F.col("cik"), F.col("accession")).alias("filing_url")).orderBy("concept_key", "product", F.desc("period_end"))


def company_history(store: Store, cik: str, concept: str, product: str | None = None) -> DataFrame:
    """Points of each (product, unit) series in order; a change of unit is a break, not a line. Verdicts and scales are
    looked up by the ids of the company's own cells of one concept, a fact for each product and period, which are sent
    to where they lie."""
    facts = store.fact.where((F.col("cik") == cik) & (F.col("concept_key") == concept))
    if product:
        facts = facts.where(F.col("product_key") == product)
    rows = fact_current(store, facts)
    asked = F.broadcast(rows.select("id"))
    v = store.verification.select(F.col("fact_id").alias("id"), (F.col("status") == "found").alias("found")).join(asked, "id", "left_semi")
    s = store.scale.select(F.col("fact_id").alias("id"), "canonical_value", "canonical_unit").join(asked, "id", "left_semi")
    rows = rows.join(v, "id", "left").join(s, "id", "left")
    place = F.row_number().over(Window.partitionBy("product_key", "unit").orderBy("period_end", "id")).cast("long")
    return rows.select("product_key", "unit", place.alias("point"), F.col("period_end").alias("period"), "value", "canonical_value", "canonical_unit", F.coalesce("found", F.lit(False)).alias("verified"), "accession", "form", "filed_date").orderBy("product_key", "unit", "point")


def history_nested(store: Store, cik: str, concept: str, product: str | None = None) -> DataFrame:
    """One row a series with its points as an array."""
    rows = company_history(store, cik, concept, product)
    points = F.array_sort(F.collect_list(F.struct("point", "period", "value", "canonical_value", "verified", "accession")))
    return rows.groupBy("product_key", "unit").agg(points.alias("points")).withColumn("label", F.lit(BY_KEY[concept].label if concept in BY_KEY else concept))


def trend_points(store: Store, concept: str, normalized: bool = True) -> DataFrame:
    """Annual points with a value, of cohort members."""
    facts = store.fact.where((F.col("concept_key") == concept) & F.col("period_end").endswith("-12-31"))
    s = store.scale.select(F.col("fact_id").alias("id"), "canonical_value", "canonical_unit")
    rows = fact_current(store, facts).join(scoped(store.company).select("cik", "name", "ticker"), "cik").join(s, "id", "left")
    value, unit = ("canonical_value", "canonical_unit") if normalized else ("value", "unit")
    return rows.select("cik", "name", "ticker", F.col("period_end").alias("period"), F.col(value).alias("point_value"), F.col(unit).alias("point_unit"), "id", "product_key").where(F.col("point_value").isNotNull())


def trends(store: Store, concept: str, normalized: bool = True, limit: int = 12) -> DataFrame:
    """The `limit` companies with the highest last value among those with two points or more; each row also says how
    many companies had a single point and how many were left out by the limit."""
    last = F.struct("period", "product_key", "id")
    per = trend_points(store, concept, normalized).groupBy("cik", "name", "ticker").agg(F.count("*").alias("points"), F.max_by("point_value", last).alias("last_value"), F.max("period").alias("last_period"))
    usable = per.where("points >= 2")
    totals = per.agg(F.count_if(F.col("points") < 2).alias("dropped"), F.greatest(F.lit(0), F.count_if(F.col("points") >= 2) - limit).cast("long").alias("omitted"))
    return usable.orderBy(F.desc("last_value"), "cik").limit(limit).join(F.broadcast(totals), F.lit(True))  # totals: one row
