"""Readings of tables held against what filers tag: agreement, revenue, and which table is the company's own."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from factloom.functions.units import factor, is_power_of_ten
from factloom.operators.writes import on

CELL = ("cik", "concept_key", "product", "period_end")
#: Fixed value: two figures this near to each other, relatively, are one figure printed to some places.
TOLERANCE = 0.006


def is_tagged(extracted_by: Column) -> Column:
    """Made from a filer's own markup, whichever way that was read."""
    return extracted_by.startswith("xbrl")


def is_model_made(extracted_by: Column) -> Column:
    return extracted_by.startswith("llm:")


def tagged_cells(facts: DataFrame) -> DataFrame:
    """(cell, value, unit): what is tagged for a cell; of several facts the newest id."""
    newest = F.max_by(F.struct("value", "unit"), F.col("id")).alias("t")
    return facts.where(is_tagged(F.col("extracted_by"))).groupBy(*CELL).agg(newest).select(*CELL, F.col("t.value").alias("tagged_value"), F.col("t.unit").alias("tagged_unit"))


def cross_check(readings: DataFrame, facts: DataFrame, tolerance: float = TOLERANCE) -> DataFrame:
    """Each reading with the tagged value of its cell, null equal to null: outcome agree, rescaled (the same digits at
    another magnitude, whose factor is the ratio), disagree, or unchecked where either side has no such value.

    readings: the columns of a cell, value, unit and more.
    """
    tagged = tagged_cells(facts)
    joined = readings.join(tagged, on(CELL, readings, tagged), "left").select(*[readings[c] for c in readings.columns], "tagged_value", "tagged_unit")
    mine, theirs = F.col("value") * factor(F.col("unit")), F.col("tagged_value") * factor(F.col("tagged_unit"))
    ratio = F.try_divide(mine, theirs)
    known = F.coalesce((mine != 0) & (theirs != 0), F.lit(False))
    outcome = F.when(~known, "unchecked").when(F.abs(mine - theirs) / theirs <= tolerance, "agree").when(is_power_of_ten(ratio), "rescaled").otherwise("disagree")
    return joined.withColumn("outcome", outcome).withColumn("ratio", F.when(known, ratio))


def first_revenue(facts: DataFrame, concept: str = "oil_and_gas_revenue") -> DataFrame:
    """(cik, period_end, revenue): the first tagged value of each company and period, by id."""
    own = facts.where((F.col("concept_key") == concept) & is_tagged(F.col("extracted_by")))
    return own.groupBy("cik", "period_end").agg(F.min_by("value", "id").alias("revenue"))


def chosen_tables(worth: DataFrame, revenue: DataFrame, tolerance: float) -> DataFrame:
    """(accession, table_index, reason): the table of a filing whose volumes times prices come nearest to revenue in any
    period; the only table; one of tables that say the same; none where the evidence settles nothing.

    worth: accession, cik, table_index, period_end, implied (may be null), cells (a digest of what the table says).
    """
    errors = worth.join(revenue, ["cik", "period_end"], "left").withColumn("error", F.when((F.col("implied") != 0) & (F.col("revenue") != 0), F.abs(F.col("implied") - F.col("revenue")) / F.col("revenue")))
    tables = errors.groupBy("accession", "table_index").agg(F.min("error").alias("error"), F.min("cells").alias("cells"))
    own = Window.partitionBy("accession")
    ranked = tables.withColumns({
        "n": F.count("*").over(own), "checked": F.count("error").over(own), "kinds": F.size(F.collect_set("cells").over(own)),
        "rn": F.row_number().over(own.orderBy(F.asc_nulls_last("error"), "table_index")),
    }).where("rn = 1")
    reason = (
        F.when(F.col("n") == 1, "only one table").when((F.col("checked") > 0) & (F.col("error") <= tolerance), "reconciles to revenue")
        .when(F.col("checked") > 0, "no table reconciles to revenue").when(F.col("kinds") == 1, "identical tables").otherwise("several tables disagree")
    )
    kept = reason.isin("only one table", "reconciles to revenue", "identical tables")
    return ranked.select("accession", F.when(kept, F.col("table_index")).alias("table_index"), reason.alias("reason"))
