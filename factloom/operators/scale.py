"""Which magnitude a reported reserve has: readings that imply a plausible value per barrel."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from factloom.functions.units import canonical_unit, conversion_note, factor, normalise
from factloom.registry import FAMILY

# Dollars per barrel that can be, and that are typical; the largest believable reserve; years of life.
LEAST, MOST = 0.30, 120.0
TYPICAL_LEAST, TYPICAL_MOST = 1.5, 50.0
LARGEST = 1e11
LIFE_LEAST, LIFE_MOST = 0.5, 200.0
PART_OF_TOTAL = 1.05
MIDPOINT = (TYPICAL_LEAST * TYPICAL_MOST) ** 0.5


def readings(rows: DataFrame) -> DataFrame:
    """Every reading of a value: its declared unit and each unit of the table header, as tagged and as printed.

    rows: id, value, unit, scale (may be null), header_units (array, may be null), declared_scale (power of ten, may be
    null). A declared scale keeps the readings of that divisor only, unless none has it.
    """
    effective = F.when(F.col("declared_scale").isNotNull(), F.pow(F.lit(10.0), "declared_scale")).otherwise(F.col("scale"))
    others = F.filter(F.coalesce("header_units", F.array().cast("array<string>")), lambda u: u != F.col("unit"))
    units = F.concat(F.array(F.struct(F.col("unit").alias("unit"), F.lit(False).alias("from_document"))), F.transform(others, lambda u: F.struct(u.alias("unit"), F.lit(True).alias("from_document"))))
    spread = rows.withColumn("effective", effective).select("*", F.posexplode(units).alias("unit_ord", "u"))
    divisors = F.when(F.coalesce("effective", F.lit(0.0)).isin(0.0, 1.0), F.array(F.lit(1.0))).otherwise(F.array(F.lit(1.0), F.col("effective")))
    each = spread.select("*", F.posexplode(divisors).alias("divisor_ord", "divisor")).withColumn("factor", factor(F.col("u.unit"))).where(F.col("factor").isNotNull())
    kept = each.withColumn("right", F.col("divisor") == F.pow(F.lit(10.0), "declared_scale")).withColumn("any_right", F.max(F.coalesce("right", F.lit(False))).over(Window.partitionBy("id")))
    kept = kept.where(F.col("declared_scale").isNull() | F.col("right") | ~F.col("any_right"))
    return kept.select("id", F.col("u.unit").alias("reading_unit"), "u.from_document", "divisor", (F.col("value") / F.col("divisor") * F.col("factor")).alias("canonical"), canonical_unit(F.col("u.unit")).alias("canonical_unit"), "unit_ord", "divisor_ord")


def resolve(rows: DataFrame) -> DataFrame:
    """One row an input row: status, the chosen divisor and unit, the dollars per barrel, what was rejected.

    rows: as for `readings`, with measure (dollars, may be null). Among viable readings a typical value per barrel wins,
    then the nearest to the typical band's middle on a log scale, then one whose unit the document states.
    """
    each = readings(rows).join(rows.select("id", "measure", F.col("unit").alias("declared_unit")), "id")
    ratio = F.try_divide(F.col("measure"), F.col("canonical"))
    volume = F.col("canonical_unit") == "BOE"
    judged = each.withColumn("ratio", F.when(F.col("canonical") > 0, ratio)).withColumn("too_large", volume & (F.col("canonical") > LARGEST))
    judged = judged.withColumn("viable", F.coalesce((F.col("canonical") > 0) & ~F.col("too_large") & F.col("ratio").between(LEAST, MOST), F.lit(False)))
    typical = F.col("ratio").between(TYPICAL_LEAST, TYPICAL_MOST)
    rank = F.struct((~typical).cast("int").alias("a"), F.abs(F.log("ratio") - F.log(F.lit(MIDPOINT))).alias("b"), (~F.col("from_document")).cast("int").alias("c"), "unit_ord", "divisor_ord")
    chosen = F.struct("divisor", "reading_unit", "ratio", "from_document")
    best = judged.groupBy("id").agg(
        F.min_by(F.when(F.col("viable"), chosen), F.when(F.col("viable"), rank)).alias("best"), F.count_if("viable").alias("n_viable"),
        F.count_if(~F.col("viable") & (F.col("canonical") > 0)).alias("n_rejected"), F.count_if("too_large").alias("n_implausible"),
    )
    out = rows.join(best, "id", "left")
    status = F.when(F.col("n_viable").isNull() | F.col("measure").isNull(), "unavailable").when(F.col("n_viable") == 0, "ambiguous").otherwise("resolved")
    return out.select(
        "id", status.alias("status"), F.col("best.divisor").alias("divisor"), F.col("best.reading_unit").alias("reading_unit"), F.col("best.ratio").alias("usd_per_boe"),
        F.coalesce(F.col("best.from_document") & (F.col("best.reading_unit") != F.col("unit")), F.lit(False)).alias("unit_corrected"),
        F.coalesce("n_viable", F.lit(0)).cast("long").alias("n_viable"), F.coalesce("n_rejected", F.lit(0)).cast("long").alias("n_rejected"),
    )


def scale_source(extracted_by: Column, found: Column, declared: Column) -> tuple[Column, Column]:
    """(scale, declared scale) of a row: table rows are printed as they are, and only they may declare a scale of 0."""
    table = extracted_by == "table:reserves"
    return F.when(table, F.lit(1.0)).otherwise(found), F.when(table, declared).otherwise(F.nullif(declared, F.lit(0)))


def resolve_tables(rows: DataFrame) -> DataFrame:
    """Table rows read as printed, unless that is more than any filer holds. rows: id, value, unit."""
    out = rows.withColumn("canonical_value", normalise(F.col("value"), F.col("unit"), F.lit(1.0)))
    fine = out.where(F.col("canonical_value").isNotNull() & (F.abs("canonical_value") <= LARGEST))
    return fine.select("id", F.lit(1.0).alias("divisor"), "canonical_value", canonical_unit(F.col("unit")).alias("canonical_unit"), conversion_note(F.col("unit")).alias("conversion_note"), F.lit("as printed in the table").alias("basis"))


def resolve_periods(rows: DataFrame) -> DataFrame:
    """All reserve rows of a (cik, period_end) with the divisor of their anchor.

    rows: id, cik, period_end, concept_key, product_key, value, unit, scale, header_units, declared_scale, measure. The
    anchor is the total of the whole company, else any total, else the first reserve row. Rows whose unit is
    discredited, whose reading is beyond belief or outside the band, or that exceed the whole get no reading; where the
    anchor has none, nor has any row of the period.
    """
    place = F.struct((F.col("concept_key") != FAMILY[2]).cast("int"), (F.col("product_key") != "").cast("int"), "id")
    group = Window.partitionBy("cik", "period_end")
    anchors = rows.withColumn("first", F.min(place).over(group)).where(place == F.col("first")).drop("first")
    solved = resolve(anchors).where("status = 'resolved'").select("id", F.col("divisor").alias("anchor_divisor"), F.col("reading_unit").alias("anchor_reading"), "usd_per_boe")
    keyed = anchors.join(solved, "id").select("cik", "period_end", F.col("unit").alias("anchor_unit"), "anchor_divisor", "anchor_reading", "usd_per_boe")
    out = rows.join(keyed, ["cik", "period_end"])
    unit = F.when(F.col("unit") == F.col("anchor_unit"), F.col("anchor_reading")).otherwise(F.col("unit"))
    out = out.withColumn("reading_unit", unit).withColumn("canonical_value", F.col("value") / F.col("anchor_divisor") * factor(unit)).withColumn("ratio", F.try_divide("measure", "canonical_value"))
    bad = (F.col("canonical_value") > LARGEST) | ((F.col("canonical_value") > 0) & (F.col("ratio") < LEAST))
    discredited = F.max(F.coalesce(bad, F.lit(False))).over(Window.partitionBy("cik", "period_end", "unit"))
    whole = F.max(F.when((F.col("product_key") == "") & (F.col("concept_key") == FAMILY[2]), F.col("canonical_value"))).over(group)
    out = out.withColumn("discredited", discredited).withColumn("whole", whole)
    inside = (F.col("canonical_value") <= 0) | F.coalesce(F.col("ratio").between(LEAST, MOST), F.lit(True)) | (F.col("product_key") != "")
    part = (F.col("product_key") == "") | F.col("whole").isNull() | (F.col("canonical_value") <= F.col("whole") * PART_OF_TOTAL)
    kept = out.where(F.col("canonical_value").isNotNull() & ~F.col("discredited") & (F.abs("canonical_value") <= LARGEST) & inside & part)
    return kept.select("id", "cik", "period_end", "concept_key", "product_key", F.col("anchor_divisor").alias("divisor"), "canonical_value", canonical_unit(F.col("reading_unit")).alias("canonical_unit"), conversion_note(F.col("reading_unit")).alias("conversion_note"), "usd_per_boe", F.lit("value per barrel of the period's anchor").alias("basis"))


def resolve_direct(rows: DataFrame, resolved: DataFrame) -> DataFrame:
    """Money rows that have no reading yet, as they are. rows: id, value, unit."""
    money = rows.where(canonical_unit(F.col("unit")) == "USD").join(resolved.select("id"), "id", "left_anti")
    return money.select("id", F.lit(1.0).alias("divisor"), F.col("value").alias("canonical_value"), F.lit("USD").alias("canonical_unit"), F.lit("dollars as filed").alias("basis"))


def resolve_production(rows: DataFrame, reserves: DataFrame) -> DataFrame:
    """Production that leaves a believable reserve life for its product; of tagged and printed reading the first that
    does. rows: id, cik, period_end, product_key, value, unit, scale, extracted_by; reserves: cik, period_end,
    product_key, canonical_value. Table rows pass without a reserve to hold them against."""
    held = reserves.groupBy("cik", "period_end", "product_key").agg(F.max("canonical_value").alias("reserve"))
    read = rows.join(held, ["cik", "period_end", "product_key"], "left").withColumn("divisors", F.when(F.coalesce("scale", F.lit(1.0)).isin(0.0, 1.0), F.array(F.lit(1.0))).otherwise(F.array(F.lit(1.0), F.col("scale"))))
    each = read.select("*", F.posexplode("divisors").alias("ord", "divisor")).withColumn("canonical_value", F.col("value") / F.col("divisor") * factor(F.col("unit")))
    life = F.try_divide(F.col("reserve"), F.col("canonical_value"))
    fine = F.coalesce(life.between(LIFE_LEAST, LIFE_MOST), F.lit(False)) | (F.col("reserve").isNull() & F.col("extracted_by").startswith("table:"))
    best = each.where(F.col("canonical_value").isNotNull() & fine).groupBy("id").agg(F.min_by(F.struct("divisor", "canonical_value", "reserve"), "ord").alias("b"))
    return best.select("id", "b.divisor", "b.canonical_value", F.lit("BOE").alias("canonical_unit"), F.try_divide("b.reserve", "b.canonical_value").alias("reserve_life"))
