"""Corpus pipeline: five stages over documents, each written as Parquet in the shared folder and read by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factloom.llm import bpe, decontaminate, secrets, simhash, toxicity
from factloom.llm.common import materialise, release, table
from factloom.llm.queries import vocabulary


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return toxicity.keep_clean(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class stays."""
    return simhash.keep_one(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of the benchmark go."""
    return decontaminate.remove_documents(docs, table(spark, sf_dir, "benchmark"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in the texts are replaced by a mark; all documents stay, with the lengths of their new texts."""
    clean = docs.withColumn("text", secrets.redacted(F.col("text"), secrets.default_scanner(vocabulary("byte_bpe_multi_50k.tiktoken"))))
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else clean


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids, digests of the ids and of the bytes decoded from them."""
    return bpe.digest(docs, vocabulary("byte_bpe_multi_50k.tiktoken"), with_ids=True)


STAGES = [("toxicity", toxic), ("simhash_near_dedup", near_duplicates), ("benchmark_decontamination", decontaminated), ("secret_scan", without_secrets), ("byte_bpe", encoded)]

#: The stages train a classifier, hash by XXH64 and merge byte pairs; SQL cannot state them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    before = None
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), name)
        if before is not None:
            release(before)
        before = docs
    return docs
