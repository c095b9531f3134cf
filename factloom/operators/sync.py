"""What is measured of filers, held against what the store says: reports first, changes only when asked for."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factloom.operators.identity import annual_form, reporting_taxonomy, ticker_sync


def reaches_reserves(taxonomy: Column) -> Column:
    """Whether tagged facts can hold reserves at all: one of the two taxonomies has no names for them."""
    return taxonomy == "us-gaap"


def is_comparable(regime: Column) -> Column:
    """Whether reserves under a regime may stand in one column with those under the rules of the commission."""
    return regime == "subpart-1200"


def measured(company: DataFrame, tags: DataFrame, filings: DataFrame) -> DataFrame:
    """(cik, ticker, country, taxonomy, annual_form, regime) of the members of cohorts. tags: cik and the number of tags
    under each taxonomy, us_gaap and ifrs; a filer without a payload counts as having none."""
    counted = company.where(F.col("cohort").isNotNull()).select("cik", "ticker", "country").join(tags.select("cik", "us_gaap", "ifrs"), "cik", "left").na.fill(0, ["us_gaap", "ifrs"])
    return counted.withColumn("taxonomy", reporting_taxonomy(F.col("us_gaap"), F.col("ifrs"))).join(annual_form(filings), "cik", "left").drop("us_gaap", "ifrs")


def regime_report(rows: DataFrame) -> DataFrame:
    """(taxonomy, regime, filers, unreachable, not_comparable): counts over what was measured, most filers first."""
    counts = rows.groupBy("taxonomy", "regime").agg(
        F.count("*").alias("filers"), F.count_if(~F.coalesce(reaches_reserves(F.col("taxonomy")), F.lit(False))).alias("unreachable"),
        F.count_if(~F.coalesce(is_comparable(F.col("regime")), F.lit(False))).alias("not_comparable"),
    )
    return counts.orderBy(F.desc("filers"), "taxonomy", "regime")


def apply_measured(company: DataFrame, rows: DataFrame, apply: bool = False) -> DataFrame:
    """company with reporting_taxonomy and disclosure_regime as measured; unchanged unless asked to apply."""
    if not apply:
        return company
    new = rows.select("cik", F.col("taxonomy").alias("new_taxonomy"), F.col("regime").alias("new_regime"))
    out = company
    for c in ("reporting_taxonomy", "disclosure_regime"):
        out = out if c in out.columns else out.withColumn(c, F.lit(None).cast("string"))
    known = out.join(new, "cik", "left")
    values = {"reporting_taxonomy": F.coalesce("new_taxonomy", "reporting_taxonomy"), "disclosure_regime": F.coalesce("new_regime", "disclosure_regime")}
    return known.withColumns(values).drop("new_taxonomy", "new_regime")


def apply_tickers(company: DataFrame, tickers: DataFrame, apply: bool = False, overwrite: bool = False) -> DataFrame:
    """company with blank tickers filled from the map, and conflicting ones replaced if asked for; unchanged unless asked
    to apply."""
    if not apply:
        return company
    wanted = ["backfill", "conflict"] if overwrite else ["backfill"]
    new = ticker_sync(company, tickers).where(F.col("outcome").isin(*wanted)).select("cik", F.col("new").alias("new_ticker"))
    return company.join(new, "cik", "left").withColumn("ticker", F.coalesce("new_ticker", "ticker")).select(*company.columns)


def apply_listing(company: DataFrame, status: DataFrame) -> DataFrame:
    """company with the listing status and the date of the last filing that were found; others keep theirs."""
    new = status.select("cik", F.col("listing_status").alias("new_status"), F.col("last_filing_date").alias("new_date"))
    out = company if "last_filing_date" in company.columns else company.withColumn("last_filing_date", F.lit(None).cast("string"))
    joined = out.join(new, "cik", "left")
    return joined.withColumns({"listing_status": F.coalesce("new_status", "listing_status"), "last_filing_date": F.coalesce("new_date", "last_filing_date")}).drop("new_status", "new_date")


def load_cohort(company: DataFrame, candidates: DataFrame, is_operator: Column) -> DataFrame:
    """company with ticker, name and operator flag of the candidates; nobody is added. candidates: cik, name, tickers
    (parted by a bar, the first counts)."""
    first = F.split_part(F.coalesce("tickers", F.lit("")), F.lit("|"), F.lit(1))
    new = candidates.select("cik", F.col("name").alias("new_name"), first.alias("new_ticker"), is_operator.alias("new_operator"), F.lit(True).alias("given")).dropDuplicates(["cik"])
    pick = lambda a, b: F.when(F.col("given"), F.col(a)).otherwise(F.col(b))
    return company.join(new, "cik", "left").withColumns({"name": pick("new_name", "name"), "ticker": pick("new_ticker", "ticker"), "is_operator": pick("new_operator", "is_operator")}).select(*company.columns)

