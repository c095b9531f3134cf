"""Pages of the archive's lists of filers, kept as text files, read by Spark: one folder for each code, form and page."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PLACE = "sic string, form string, start int"


def write_pages(pages: DataFrame, folder: str) -> None:
    """Writes pages (sic, form, start, text), a file each."""
    pages.select("sic", "form", "start", F.col("text").alias("value")).write.partitionBy("sic", "form", "start").text(folder)


def listed(spark: SparkSession, folder: str) -> DataFrame:
    """(sic, form, start, place, cik): every number that a page lists, in its order. A filter on code or form reads the
    pages of that folder alone; a page is one task's work at most."""
    pages = spark.read.schema(f"value string, {PLACE}").option("wholetext", True).text(folder)
    found = F.regexp_extract_all("value", F.lit(r"(?i)<cik>\s*([0-9]+)\s*</cik>"), F.lit(1))
    return pages.select("sic", "form", "start", F.posexplode(found).alias("place", "n")).select("sic", "form", "start", "place", F.lpad("n", 10, "0").alias("cik"))


def filers(pages: DataFrame, forms: tuple[str, ...]) -> DataFrame:
    """(sic, cik, form, start): each filer of a code once, where it is listed first: by form in the given order, then
    page and place. A repeated last page adds none."""
    order = F.create_map(*[F.lit(x) for i, f in enumerate(forms) for x in (f, i)])
    rows = pages.where(F.col("form").isin(*forms)).withColumn("at", F.struct(order[F.col("form")].alias("o"), "start", "place"))
    first = rows.groupBy("sic", "cik").agg(F.min(F.struct("at", "form")).alias("f"))
    return first.select("sic", "cik", "f.form", "f.at.start")
