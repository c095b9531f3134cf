"""Counts, coverage and listings."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factloom.plans.panel import scoped
from factloom.plans.views import cells, fact_collision, fact_current, reserve_consistency, unit_discontinuity
from factloom.registry import concepts_frame
from factloom.sources.store import Store


def summary(store: Store, cohort: str | None = None) -> DataFrame:
    """One row of headline counts, all scoped to one cohort or none of them."""
    ciks = None if cohort is None else scoped(store.company, cohort).select("cik")
    inside = lambda df: df if ciks is None else df.join(ciks, "cik", "left_semi")
    facts = inside(store.fact)
    of_facts = lambda df: df if ciks is None else df.join(facts.select(F.col("id").alias("fact_id")), "fact_id", "left_semi")
    n = F.count("*")
    parts = [
        inside(store.company).agg(n.alias("companies")),
        facts.agg(n.alias("facts"), F.countDistinct("concept_key").alias("concepts"), F.min("period_end").alias("earliest_period"), F.max("period_end").alias("latest_period")),
        inside(fact_current(store)).agg(n.alias("cells")),
        inside(store.filing).agg(n.alias("filings")),
        inside(unit_discontinuity(store)).agg(n.alias("unit_discontinuities")),
        of_facts(store.verification).agg(n.alias("verify_checked"), F.count_if(F.col("status") == "found").alias("verified")),
        of_facts(store.scale).agg(n.alias("comparable")),
        inside(fact_collision(store)).agg(n.alias("collisions")),
        inside(reserve_consistency(store)).agg(F.count_if(F.col("issue").isNotNull()).alias("reserve_issues")),
    ]
    return reduce(lambda a, b: a.join(b, F.lit(True)), parts).select(F.lit(cohort).cast("string").alias("cohort"), "*")  # one row each


def concepts(store: Store) -> DataFrame:
    """Concepts present, in the registry's order."""
    counts = cells(store).groupBy("concept_key").agg(F.count("*").alias("cells"))
    return concepts_frame(store.fact.sparkSession).join(counts, "concept_key").select("concept_key", "label", "cells", "concept_ord").orderBy("concept_ord")


def periods(store: Store, concept: str | None = None) -> DataFrame:
    """Periods with data, newest first. A cell has a current fact whenever it has any, so no ranking is needed."""
    facts = store.fact if concept is None else store.fact.where(F.col("concept_key") == concept)
    return store.dated(facts).select("period_end").distinct().orderBy(F.desc("period_end"))


def cohorts(store: Store) -> DataFrame:
    with_facts = store.fact.select("cik", F.lit(True).alias("has")).distinct()
    rows = scoped(store.company).join(with_facts, "cik", "left")
    return rows.groupBy("cohort").agg(F.count("*").alias("companies"), F.count_if("is_operator").alias("operators"), F.count_if(F.col("has").isNotNull()).alias("with_facts")).orderBy(F.desc("companies"))


def companies(store: Store) -> DataFrame:
    """Members with what each has; those without a fact stay."""
    per = cells(store).groupBy("cik").agg(F.count("*").alias("cells"), F.countDistinct("concept_key").alias("concepts"), F.max("period_end").alias("latest_period"))
    rows = scoped(store.company).select("cik", "name", "ticker").join(per, "cik", "left").na.fill(0, ["cells", "concepts"])
    return rows.orderBy(F.desc("concepts"), F.desc("cells"), "name")


def coverage_matrix(store: Store, cohort: str | None = None) -> DataFrame:
    """(company, concept) with newest period and cells; a company without a fact keeps one row without a concept."""
    per = cells(store).groupBy("cik", "concept_key").agg(F.max("period_end").alias("latest_period"), F.count("*").alias("cells"))
    return scoped(store.company, cohort).select("cik", "name", "ticker").join(per, "cik", "left")


def coverage_nested(store: Store, cohort: str | None = None) -> DataFrame:
    """The matrix with one row a company and a map of its concepts, most concepts first."""
    entry = F.struct(F.col("concept_key").alias("key"), F.struct("latest_period", "cells").alias("value"))
    rows = coverage_matrix(store, cohort).groupBy("cik", "name", "ticker").agg(F.collect_list(F.when(F.col("concept_key").isNotNull(), entry)).alias("e"))
    return rows.select("cik", "name", "ticker", F.map_from_entries("e").alias("concepts")).orderBy(F.desc(F.size("concepts")), "name")


def company_concepts(store: Store, cohort: str | None = None) -> DataFrame:
    """(cik, concepts): the sorted distinct concepts of each member."""
    members = scoped(store.company, cohort).select("cik")
    return store.dated().join(members, "cik", "left_semi").groupBy("cik").agg(F.array_join(F.sort_array(F.collect_set("concept_key")), ",").alias("concepts"))
