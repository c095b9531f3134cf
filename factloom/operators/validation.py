"""Choice of tags by arithmetic: developed + undeveloped = total."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from factloom.registry import DEVELOPED, FAMILY, TOTAL, UNDEVELOPED

TOLERANCE = 0.03


def candidate_values(observations: DataFrame) -> DataFrame:
    """The newest filed value of each (cik, concept_key, tag, unit, period_end); of equal dates the later ordinal wins.

    observations: those columns, filed, ordinal, value, alias_ord.
    """
    keys = ("cik", "concept_key", "tag", "unit", "period_end")
    newest = F.struct(F.coalesce("filed", F.lit("")).alias("filed"), "ordinal")
    return observations.groupBy(*keys).agg(F.max_by("value", newest).alias("value"), F.min("alias_ord").alias("alias_ord"))


def tag_triples(values: DataFrame) -> DataFrame:
    """Every combination of three tags of one unit, period by period, with its relative error.

    The join is on company, unit and period, so combinations never cross units; a zero total is not tested.
    """
    side = lambda key, n: values.where(F.col("concept_key") == key).select("cik", "unit", "period_end", F.col("tag").alias(f"{n}_tag"), F.col("alias_ord").alias(f"{n}_ord"), F.col("value").alias(n))
    keys = ["cik", "unit", "period_end"]
    rows = side(DEVELOPED, "d").join(side(UNDEVELOPED, "u"), keys).join(side(TOTAL, "t"), keys).where("t <> 0")
    error = F.abs(F.col("d") + F.col("u") - F.col("t")) / F.abs("t")
    return rows.withColumn("error", error).withColumn("ok", F.col("error") <= TOLERANCE)


def score_triples(triples: DataFrame) -> DataFrame:
    """One row a combination: periods tested and coherent, whether the newest holds, the median error."""
    return triples.groupBy("cik", "unit", "d_tag", "u_tag", "t_tag", "d_ord", "u_ord", "t_ord").agg(
        F.count("*").alias("tested_periods"), F.count_if("ok").alias("coherent_periods"), F.max_by("ok", "period_end").alias("latest_ok"),
        F.percentile("error", F.lit(0.5)).alias("median_error"),
        F.array_join(F.sort_array(F.collect_list(F.when(~F.col("ok"), F.col("period_end")))), ",").alias("incoherent"),
    )


def validate_family(values: DataFrame, ciks: DataFrame) -> DataFrame:
    """One row a company of ciks: the combination whose arithmetic holds best, and its status.

    Rank: the newest period holds, more coherent periods, smaller median error, more tested periods; the first
    combination in the order of the registry wins ties.
    """
    order = Window.partitionBy("cik").orderBy(F.desc("latest_ok"), F.desc("coherent_periods"), F.asc("median_error"), F.desc("tested_periods"), "d_ord", "u_ord", "t_ord", "unit")
    best = score_triples(tag_triples(values)).withColumn("rn", F.row_number().over(order)).where("rn = 1").drop("rn")
    tagged = values.where(F.col("concept_key").isin(*FAMILY)).groupBy("cik").agg(F.collect_set("concept_key").alias("tagged"))
    missing = F.array_join(F.sort_array(F.array_except(F.array(*map(F.lit, FAMILY)), F.coalesce("tagged", F.array().cast("array<string>")))), ", ")
    status = F.when(F.col("d_tag").isNull(), "insufficient").when(F.col("latest_ok"), "validated").when(F.col("coherent_periods") > 0, "drifted").otherwise("incoherent")
    note = F.when(F.col("d_tag").isNull() & (missing != ""), F.concat(F.lit("not all three concepts tagged, missing: "), missing)).when(F.col("d_tag").isNull(), "no combination shares a unit across all three concepts")
    return ciks.select("cik").distinct().join(tagged, "cik", "left").join(best, "cik", "left").withColumn("status", status).withColumn("note", note).drop("tagged")


def records(verdicts: DataFrame, family: str = "reserves") -> DataFrame:
    """What is stored of verdicts, to replace the rows of the same company and family: a row for each concept with its
    chosen tag, or one row of concept * where nothing was chosen."""
    chosen = F.array(*[F.struct(F.lit(k).alias("concept_key"), F.col(t).alias("tag")) for k, t in ((DEVELOPED, "d_tag"), (UNDEVELOPED, "u_tag"), (TOTAL, "t_tag"))])
    none = F.array(F.struct(F.lit("*").alias("concept_key"), F.lit(None).cast("string").alias("tag")))
    rows = verdicts.withColumn("c", F.explode(F.when(F.col("d_tag").isNotNull(), chosen).otherwise(none)))
    return rows.select("cik", F.lit(family).alias("family"), "c.concept_key", "c.tag", "status", "unit", "tested_periods", "coherent_periods", "note")


def rejected_periods(triples: DataFrame, verdicts: DataFrame) -> DataFrame:
    """(cik, concept_key, tag, period_end) of the chosen combinations' incoherent periods."""
    keys = ["cik", "unit", "d_tag", "u_tag", "t_tag"]
    bad = triples.where(~F.col("ok")).join(verdicts.where("d_tag is not null").select(*keys), keys, "left_semi")
    return bad.select("cik", "period_end", F.explode(F.array(*[F.struct(F.lit(k).alias("concept_key"), F.col(t).alias("tag")) for k, t in ((DEVELOPED, "d_tag"), (UNDEVELOPED, "u_tag"), (TOTAL, "t_tag"))])).alias("x")).select("cik", "x.concept_key", "x.tag", "period_end")


def drop_incoherent(rows: DataFrame, rejected: DataFrame) -> DataFrame:
    """Rows but those of a chosen tag in a rejected period."""
    return rows.join(rejected, ["cik", "concept_key", "tag", "period_end"], "left_anti")
