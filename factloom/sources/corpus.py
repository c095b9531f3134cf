"""The corpus of filed documents: raw files below accession/name."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read_corpus(spark: SparkSession, root: str, accession: str | None = None) -> DataFrame:
    """(accession, name, raw), one row a file; an accession narrows the listing itself, not the result."""
    path = f"{root}/{accession}" if accession else root
    raw = spark.read.text(path, wholetext=True, recursiveFileLookup=True).select("value", F.col("_metadata.file_path").alias("path"))
    parts = F.split("path", "/")
    return raw.select(F.element_at(parts, -2).alias("accession"), F.element_at(parts, -1).alias("name"), F.col("value").alias("raw"))


def index_items(html: Column) -> Column:
    """Attachments of a filing's index page: rows of description, document, type and size."""
    rows = F.regexp_extract_all(html, F.lit(r"(?is)<tr\b[^>]*>(.*?)</tr>"), F.lit(1))
    cells = F.transform(rows, lambda r: F.transform(F.regexp_extract_all(r, F.lit(r"(?is)<td\b[^>]*>(.*?)</td>"), F.lit(1)), lambda c: F.trim(F.regexp_replace(F.regexp_replace(c, "<[^>]+>", " "), r"(\s|&nbsp;)+", " "))))
    whole = F.filter(cells, lambda c: F.size(c) >= 5)
    size = lambda c: F.try_to_number(F.regexp_replace(c[4], "[^0-9]", ""), F.lit("999999999999")).cast("long")
    return F.transform(whole, lambda c: F.struct(c[1].alias("description"), F.split_part(c[2], F.lit(" "), F.lit(1)).alias("document"), c[3].alias("type"), size(c).alias("size")))


def primary_documents(filings: DataFrame, items: DataFrame) -> DataFrame:
    """(accession, primary_doc): the registered one, else the largest readable attachment that is neither an exhibit
    nor the index."""
    name = F.lower("document")
    fit = items.where(name.rlike(r"\.html?$") & ~F.col("type").startswith("EX-") & ~F.contains(name, F.lit("index")))
    largest = fit.groupBy("accession").agg(F.max_by("document", F.struct("size", "document")).alias("largest"))
    return filings.select("accession", F.nullif("primary_doc", F.lit("")).alias("known")).join(largest, "accession", "left").select("accession", F.coalesce("known", "largest").alias("primary_doc"))


def sheet(body: Column, number: Column, strict: bool = False) -> Column:
    """A page (from 1) of a document cut at its rules; outside of its pages null, or an error where that is asked for."""
    pages = F.split(body, r"(?i)<hr\b[^>]*>", -1)
    found = F.try_element_at(pages, F.when(number != 0, number))
    if not strict:
        return F.when(number > 0, found)
    outside = F.raise_error(F.concat(F.lit("no page "), number.cast("string"), F.lit(" of "), F.size(pages).cast("string")))
    return F.when((number < 1) | (number > F.size(pages)), outside).otherwise(found)
