"""Reports over what is stored: coverage, admission, discovery, samples for a second look at documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Hits up to which a printed number names its place, and characters to a unit that stands beside a figure.
FEW_HITS, BESIDE_CHARS = 3, 40


def is_current(tagged: Column, latest_period: Column, since: str) -> Column:
    """Tagged, and not only in periods before `since`."""
    return F.coalesce(tagged & (latest_period >= since), F.lit(False))


def company_coverage(coverage: DataFrame, since: str) -> DataFrame:
    """(cik, concepts, tagged, current, stale): one row a company of its rows of concepts."""
    current = is_current(F.col("tagged"), F.col("latest_period"), since)
    rows = coverage.groupBy("cik").agg(F.count("*").alias("concepts"), F.count_if("tagged").alias("tagged"), F.count_if(current).alias("current"))
    return rows.withColumn("stale", F.col("tagged") - F.col("current"))


def admission_report(decided: DataFrame) -> DataFrame:
    """(decision, reason, n, example): how many candidates each reason decided, most first. decided: cik, decision, reason."""
    return decided.groupBy("decision", "reason").agg(F.count("*").alias("n"), F.min("cik").alias("example")).orderBy(F.desc("n"), "decision", "reason")


def discovery_report(profiles: DataFrame) -> DataFrame:
    """One row over candidates: all, with a ticker, foreign, with an annual report, without a payload."""
    return profiles.agg(
        F.count("*").alias("filers"), F.count_if(F.coalesce(F.size("tickers") > 0, F.lit(False))).alias("with_ticker"), F.count_if(F.coalesce("is_foreign", F.lit(False))).alias("is_foreign"),
        F.count_if(F.col("annual_count") > 0).alias("reporting"), F.count_if(F.col("error").isNotNull()).alias("failed"),
    )


def unambiguous(hits: Column) -> Column:
    """A number that stands all over a filing proves less than a rare one."""
    return hits <= FEW_HITS


def confident(kind: Column, distance: Column) -> Column:
    """A unit beside a figure rarely belongs to anything else."""
    return (kind == "inline") & (distance <= BESIDE_CHARS)


def header_agrees(note: Column, seen: Column) -> Column:
    """Whether a header read a second way is the parser's, blanks and case aside, one holding the other; null where the
    parser noted none, false where none was seen."""
    parsed = F.regexp_extract(note, r"^column:([^;]*)", 1)
    bare = lambda c: F.regexp_replace(F.lower(c), r"\s+", "")
    either = F.contains(bare(seen), bare(parsed)) | F.contains(bare(parsed), bare(seen))
    return F.when(F.startswith(note, F.lit("column:")), F.when(F.coalesce(seen, F.lit("")) == "", False).otherwise(either))


def second_look(verification: DataFrame, scale: DataFrame, per_group: int) -> DataFrame:
    """(sample_group, fact_id): the first found facts, by id, of three kinds: without a unit beside them, with a unit
    that the scale changed, and others. verification: fact_id, status, page, printed, units_nearby; scale: fact_id, basis."""
    found = verification.where((F.col("status") == "found") & F.col("page").isNotNull() & F.col("printed").isNotNull())
    changed = scale.where(F.contains("basis", F.lit("unit read as"))).select("fact_id", F.lit(True).alias("changed")).distinct()
    rows = found.join(changed, "fact_id", "left").withColumn("changed", F.coalesce("changed", F.lit(False)))
    groups = F.filter(F.array(
        F.when(F.col("units_nearby").isNull(), F.lit("no_header")), F.when(F.col("changed"), F.lit("unit_corrected")), F.when(F.col("units_nearby").isNotNull() & ~F.col("changed"), F.lit("control")),
    ), lambda g: g.isNotNull())
    order = Window.partitionBy("sample_group").orderBy("fact_id")
    return rows.select(F.explode(groups).alias("sample_group"), "fact_id").withColumn("rn", F.row_number().over(order)).where(F.col("rn") <= per_group).drop("rn")


def look_summary(checks: DataFrame) -> DataFrame:
    """(sample_group, n, present, header_ok, header_n, folio_ok, folio_n): how often a second look agreed, of those it
    could judge. checks: sample_group, value_present, agree_header, agree_folio, booleans that may be null."""
    ones = lambda c: F.sum(F.col(c).cast("int")).cast("long")
    seen = checks.where(F.col("value_present").isNotNull())
    return seen.groupBy("sample_group").agg(
        F.count("*").alias("n"), ones("value_present").alias("present"), ones("agree_header").alias("header_ok"), F.count("agree_header").alias("header_n"),
        ones("agree_folio").alias("folio_ok"), F.count("agree_folio").alias("folio_n"),
    )
