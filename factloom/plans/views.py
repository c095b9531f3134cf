"""Derived relations: which fact is current, what collides, what is inconsistent."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factloom.registry import DEVELOPED, FAMILY, TOTAL, UNDEVELOPED
from factloom.sources.store import CELL, TABLES, Store, place


def joined_units(unit: str = "unit") -> Column:
    """Distinct units, sorted and comma-joined."""
    return F.array_join(F.sort_array(F.collect_set(unit)), ",")


def fact_current(store: Store, facts: DataFrame | None = None) -> DataFrame:
    """One fact a cell: the newest filing, then the preferred unit, then the highest id.

    Published facts know their place. Of others the rank is limited to 1 before the shuffle as well (a window group limit), so a cell with many restatements sends
    one row a task. Filters on columns of the cell pass through the window; filters on others must come after.
    """
    if facts is None and "behind" in store.fact.columns:
        return store.dated(store.fact.where("behind = 0"))
    return store.dated(facts).withColumn("rn", place(*CELL)).where("rn = 1").drop("rn")


def cells(store: Store) -> DataFrame:
    """The cells that have a fact, and so a current one: of these alone no facts need be ranked."""
    return store.dated().select(*CELL).distinct() if "behind" not in store.fact.columns else fact_current(store).select(*CELL)


def fact_collision(store: Store) -> DataFrame:
    """Cells with more than one value among filings of one date."""
    found = store.dated().groupBy(*CELL, "filed_date").agg(
        F.size(F.collect_set("value")).cast("long").alias("distinct_values"), F.size(F.collect_set("unit")).cast("long").alias("distinct_units"),
        F.min("value").alias("min_value"), F.max("value").alias("max_value"), joined_units().alias("units"),
    )
    return found.where("distinct_values > 1").select("cik", "concept_key", F.col("product_key").alias("product"), "period_end", "distinct_values", "distinct_units", "min_value", "max_value", "units")


def unit_discontinuity(store: Store) -> DataFrame:
    """Series whose declared unit changed; units are few, so their sets stay small however long the series."""
    found = store.fact.groupBy("cik", "concept_key", "product_key").agg(F.collect_set("unit").alias("u"), F.min("period_end").alias("first_period"), F.max("period_end").alias("last_period"))
    return found.where(F.size("u") > 1).select("cik", "concept_key", F.col("product_key").alias("product"), F.size("u").cast("long").alias("distinct_units"), F.array_join(F.sort_array("u"), ",").alias("units"), "first_period", "last_period")


def reserve_consistency(store: Store) -> DataFrame:
    """Developed, undeveloped and total beside each other in one grouped pass, with the first fault that applies."""
    current = fact_current(store, store.fact.where(F.col("concept_key").isin(*FAMILY)))
    pick = lambda key, column: F.max(F.when(F.col("concept_key") == key, F.col(column)))
    names = {"developed": DEVELOPED, "undeveloped": UNDEVELOPED, "total": TOTAL}
    wide = current.groupBy("cik", "period_end", "product").agg(*[pick(key, c).alias(f"{n}_{c}") for n, key in names.items() for c in ("value", "unit", "accession", "tag")])
    d, u, t = F.col("developed_value"), F.col("undeveloped_value"), F.col("total_value")
    du, uu, tu = F.col("developed_unit"), F.col("undeveloped_unit"), F.col("total_unit")
    issue = (
        F.when(du != tu, "units differ").when(t == 0, "total proved is zero")
        .when(u.isNotNull() & (uu == du) & (F.abs(d + u - t) > t * 0.03), "components do not sum to total")
        .when(d > t * 1.02, "developed exceeds total").when(d == t, "developed equals total")
    )
    ratio = F.when((du == tu) & (t != 0), F.try_divide(d, t))
    both = wide.where(d.isNotNull() & t.isNotNull())
    return both.select("cik", "period_end", "product", "developed_value", "developed_unit", "undeveloped_value", "undeveloped_unit", "total_value", "total_unit", "developed_accession", "total_accession", "developed_tag", "total_tag", ratio.alias("ratio"), issue.alias("issue"))


def fact_verified(store: Store) -> DataFrame:
    v = store.verification.select(F.col("fact_id").alias("id"), F.col("status").alias("verify_status"), F.col("document").alias("verify_document"))
    return fact_current(store).join(v, "id", "left")


def fact_canonical(store: Store) -> DataFrame:
    s = store.scale.select(F.col("fact_id").alias("id"), "canonical_value", "canonical_unit", F.col("divisor").alias("scale_divisor"))
    return fact_verified(store).join(s, "id", "left")


#: The views of a store by their names.
VIEWS = {"fact_current": fact_current, "fact_collision": fact_collision, "unit_discontinuity": unit_discontinuity, "reserve_consistency": reserve_consistency, "fact_verified": fact_verified, "fact_canonical": fact_canonical}


def register(store: Store, prefix: str = "") -> None:
    """Names the relations of a store and its views in the session, for SQL; names in use are given anew."""
    for name in TABLES:
        getattr(store, name).createOrReplaceTempView(prefix + name)
    for name, view in VIEWS.items():
        view(store).createOrReplaceTempView(prefix + name)
