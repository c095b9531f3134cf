"""Which documents are wanted, which are there, and in what order they are read. Fetching is the caller's."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from factloom.functions.names import base_form
from factloom.operators.identity import exhibits, is_wrapper
from factloom.session import qualified

ANNUAL_WITH_EXHIBITS, EVENT = "40-F", "8-K"


def wanted_filings(filings: DataFrame, forms: tuple[str, ...], since: str, per_form: int) -> DataFrame:
    """The newest filings of each form of each company, amendments with their form, of those that name a document."""
    fit = filings.withColumn("base", base_form(F.col("form"))).where(F.col("base").isin(*forms) & (F.col("filed_date") >= since) & (F.coalesce("primary_doc", F.lit("")) != ""))
    order = Window.partitionBy("cik", "base").orderBy(F.desc("filed_date"), "accession")
    return fit.withColumn("rn", F.row_number().over(order)).where(F.col("rn") <= per_form).drop("rn")


def plan(wanted: DataFrame, items: DataFrame, stored: DataFrame) -> DataFrame:
    """(cik, accession, name, why) of documents that are wanted and not stored: the primary ones, and the attachments of
    forms that carry their disclosure there. items: accession, document, type, size; stored: accession, name."""
    primary = wanted.select("cik", "accession", F.col("primary_doc").alias("name"), F.lit("primary").alias("why"))
    attached = exhibits(items).select("accession", F.col("document").alias("name"))
    carriers = wanted.where(F.col("base").isin(ANNUAL_WITH_EXHIBITS, EVENT)).select("cik", "accession")
    both = primary.unionByName(carriers.join(attached, "accession").select("cik", "accession", "name", F.lit("exhibit").alias("why")))
    return both.join(stored.select("accession", "name"), ["accession", "name"], "left_anti").select("cik", "accession", "name", "why")


def documents_of(filings: DataFrame, stored: DataFrame, items: DataFrame) -> DataFrame:
    """(accession, name, doc_rank, is_stored): the readable documents of each filing, the primary one first (rank 0).

    A filing of a wrapper form with one stored document or none is completed by its attachments, which the caller has to
    fetch; so is a primary document that is not stored. filings: accession, form, primary_doc.
    """
    readable = stored.where(F.lower("name").rlike(r"\.html?$")).select("accession", "name").distinct()
    counts = readable.groupBy("accession").agg(F.count("*").alias("n"))
    thin = filings.where(is_wrapper(F.col("form"))).join(counts, "accession", "left").where(F.coalesce("n", F.lit(0)) <= 1).select("accession")
    attached = exhibits(items).select("accession", F.col("document").alias("name")).join(thin, "accession", "left_semi")
    primary = filings.where(F.coalesce("primary_doc", F.lit("")) != "").select("accession", F.col("primary_doc").alias("name"))
    every = readable.unionByName(attached).unionByName(primary).distinct().join(filings.select("accession", "primary_doc"), "accession")
    held = readable.withColumn("is_stored", F.lit(True))
    order = Window.partitionBy("accession").orderBy((~F.col("name").eqNullSafe(F.col("primary_doc"))).cast("int"), "name")
    is_first = F.col("name").eqNullSafe(F.col("primary_doc"))
    ranked = every.withColumn("place", F.row_number().over(order)).withColumn("ahead", F.max(is_first.cast("int")).over(Window.partitionBy("accession")))
    rank = F.col("place") - F.col("ahead")
    return ranked.join(held, ["accession", "name"], "left").select("accession", "name", rank.cast("int").alias("doc_rank"), F.coalesce("is_stored", F.lit(False)).alias("is_stored"))


def misses(wanted: DataFrame, cached: DataFrame, key: str = "cik") -> DataFrame:
    """Keys that the cache of payloads does not hold."""
    return wanted.select(key).distinct().join(cached.select(key), key, "left_anti")


def _reached(root: str):
    """(file system of pyarrow, path in it) of a qualified path."""
    from pyarrow import fs

    scheme, _, rest = root.partition(":")
    if scheme == "file":
        return fs.LocalFileSystem(), "/" + rest.lstrip("/")
    return fs.FileSystem.from_uri({"s3a": "s3", "s3n": "s3"}.get(scheme, scheme) + ":" + rest)


def store_documents(documents: DataFrame, root: str) -> DataFrame:
    """Writes raw documents to root/accession/name, each under a temporary name that is then moved, so that a task that
    runs again replaces its own work; returns (accession, name, size). root: a folder that all executors reach, on the
    file system that Spark uses for it, of a kind that pyarrow knows. An accession or name that is no plain name (empty,
    with a slash, or dots alone) is refused, as it would lead out of its folder."""
    folder = qualified(documents.sparkSession, root)

    def put(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, base = _reached(folder)
        for pdf in batches:
            sizes = []
            for accession, name, raw in zip(pdf["accession"], pdf["name"], pdf["raw"], strict=True):
                if any(not part or "/" in part or not part.strip(".") for part in (accession, name)):
                    raise ValueError(f"no plain name: {accession!r}, {name!r}")
                data = (raw or "").encode("utf-8", "replace")
                system.create_dir(f"{base}/{accession}", recursive=True)
                with system.open_output_stream(f"{base}/{accession}/.{name}.part") as out:
                    out.write(data)
                system.move(f"{base}/{accession}/.{name}.part", f"{base}/{accession}/{name}")
                sizes.append(len(data))
            yield pd.DataFrame({"accession": pdf["accession"], "name": pdf["name"], "size": sizes})

    return documents.select("accession", "name", "raw").mapInPandas(put, "accession string, name string, size long")
