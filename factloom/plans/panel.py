"""The peer comparison: one concept over companies, and all concepts side by side."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from factloom.functions.names import filing_url
from factloom.plans.views import fact_current, unit_discontinuity
from factloom.registry import CONCEPTS
from factloom.sources.store import Store


def scoped(company: DataFrame, cohort: str | None = None) -> DataFrame:
    """Companies of one cohort, or of any."""
    return company.where(F.col("cohort").isNotNull() if cohort is None else F.col("cohort") == cohort)


def _filtered(facts: DataFrame, concept: str | None, product: str | None) -> DataFrame:
    if concept is not None:
        facts = facts.where(F.col("concept_key") == concept)
    return facts.where(F.col("product_key") == product) if product else facts


def _dressed(store: Store, cells: DataFrame, cohort: str | None) -> DataFrame:
    """Cells with company, discontinuity, verdict and canonical value. Filters on cik and concept reach all sides."""
    company = scoped(store.company, cohort).select("cik", "name", "ticker", "cohort")
    changed = unit_discontinuity(store).select("cik", "concept_key", F.col("product").alias("product_key"), F.col("units").alias("series_units"))
    v = store.verification.select(F.col("fact_id").alias("id"), F.col("status").alias("verify_status"))
    s = store.scale.select(F.col("fact_id").alias("id"), "canonical_value", "canonical_unit")
    out = cells.join(company, "cik").join(changed, ["cik", "concept_key", "product_key"], "left").join(v, "id", "left").join(s, "id", "left")
    return out.withColumn("unit_changed", F.col("series_units").isNotNull()).withColumn("filing_url", filing_url(F.col("cik"), F.col("accession")))


def _ordered(rows: DataFrame) -> DataFrame:
    """By unit, then companies by their largest value, each company's rows together; position counts within a unit.

    The companies are ranked, not their rows: one row a company of a unit goes through the window over the unit, with the
    number of its rows, whose running total is where the company begins. A company's own rows are numbered apart.
    """
    members = rows.groupBy("unit", "cik").agg(F.max("value").alias("company_max"), F.count("*").alias("n"))
    ahead = Window.partitionBy("unit").orderBy(F.desc("company_max"), F.asc("cik")).rowsBetween(Window.unboundedPreceding, -1)
    begins = members.withColumn("before", F.coalesce(F.sum("n").over(ahead), F.lit(0))).select(F.col("unit").alias("u"), F.col("cik").alias("c"), "before")
    own = Window.partitionBy("unit", "cik").orderBy(F.desc("value"), F.asc("product_key"))
    numbered = rows.withColumn("place", F.row_number().over(own)).join(begins, F.col("unit").eqNullSafe(F.col("u")) & (F.col("cik") == F.col("c")))
    return numbered.withColumn("position", (F.col("before") + F.col("place")).cast("long")).drop("u", "c", "before", "place")


PANEL = ("id", "cik", "name", "ticker", "cohort", "value", "unit", "product", "period_end", "accession", "form", "filed_date", "unit_changed", "series_units", "verify_status", "canonical_value", "canonical_unit", "filing_url", "position")


def panel(store: Store, concept: str, period: str, product: str | None = None, cohort: str | None = None) -> DataFrame:
    """One concept in one period; never ranked across units."""
    facts = _filtered(store.fact.where(F.col("period_end") == period), concept, product)
    return _ordered(_dressed(store, fact_current(store, facts), cohort)).select(*PANEL).orderBy("unit", "position")


def latest_cells(store: Store, facts: DataFrame | None = None) -> DataFrame:
    """Each series' newest cell; of cells with one period the highest id."""
    order = Window.partitionBy("cik", "concept_key", "product_key").orderBy(F.desc("period_end"), F.desc("id"))
    return fact_current(store, facts).withColumn("recency", F.row_number().over(order)).where("recency = 1").drop("recency")


def panel_latest(store: Store, concept: str, product: str | None = None, cohort: str | None = None) -> DataFrame:
    """Each company's newest period, with the years it lies behind the newest of all rows."""
    rows = _dressed(store, latest_cells(store, _filtered(store.fact, concept, product)), cohort)
    newest = rows.agg(F.max("period_end").alias("newest"))
    year = lambda c: F.substring(c, 1, 4).cast("int")
    behind = _ordered(rows).join(F.broadcast(newest), F.lit(True)).withColumn("periods_behind", year("newest") - year("period_end"))  # newest: one row
    return behind.select(*PANEL, "periods_behind").orderBy("unit", "position")


def panel_wide(store: Store, period: str | None = None, product: str | None = None, cohort: str | None = None, include_uncohorted: bool = False) -> DataFrame:
    """One row per company and product, one group of columns per concept; most cells first."""
    facts = store.fact.where(F.col("period_end") == period) if period else store.fact
    company = store.company if include_uncohorted and cohort is None else scoped(store.company, cohort)
    v = store.verification.select(F.col("fact_id").alias("id"), (F.col("status") == "found").alias("found"))
    s = store.scale.select(F.col("fact_id").alias("id"), "canonical_value")
    cells = latest_cells(store, _filtered(facts, None, product)).join(company.select("cik", "name", "ticker", "cohort"), "cik").join(v, "id", "left").join(s, "id", "left")
    pick = lambda key, c: F.max(F.when(F.col("concept_key") == key, F.col(c)))  # noqa: E731  one cell each
    columns = {"value": "value", "unit": "unit", "period": "period_end", "verified": "found", "canonical": "canonical_value"}
    keys = [c.key for c in CONCEPTS]
    picked = [pick(k, c).alias(f"{k}__{n}") for k in keys for n, c in columns.items()]
    wide = cells.groupBy("cik", "name", "ticker", "cohort", "product_key").agg(F.count("*").alias("n_cells"), *picked)
    wide = wide.withColumns({f"{k}__verified": F.when(F.col(f"{k}__value").isNotNull(), F.coalesce(f"{k}__verified", F.lit(False))) for k in keys})
    return wide.orderBy(F.desc("n_cells"), F.coalesce("ticker", F.lit("zzz")), "product_key", "cik")


def column_units(wide_cells: DataFrame) -> DataFrame:
    """(concept_key, units): the distinct units of each column, sorted."""
    return wide_cells.groupBy("concept_key").agg(F.array_join(F.sort_array(F.collect_set("unit")), ",").alias("units"))


def unit_groups(rows: DataFrame) -> DataFrame:
    """(unit, count, position): groups inside which comparison holds, largest first; ties in the order of units."""
    groups = rows.groupBy("unit").agg(F.count("*").alias("count"))
    return groups.withColumn("position", F.row_number().over(Window.orderBy(F.desc("count"), F.asc("unit"))).cast("long"))  # one row a unit
