"""The registered queries of this subpackage: thin callers of its operators over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factloom.llm import bpe, decontaminate, deltas, frames, hnsw, negatives, pii, preference, secrets, simhash, token_counts, topk, toxicity
from factloom.llm.common import table


def vocabulary(name: str) -> str:
    """The place of a public tokenizer's file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(table(spark, sf_dir, "documents"), secrets.default_scanner(vocabulary("byte_bpe_multi_50k.tiktoken")))


def op2_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digest(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_multi_50k.tiktoken"))


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.sanitise(table(spark, sf_dir, "documents"))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op6_preference(spark: SparkSession, sf_dir: str) -> DataFrame:
    return preference.format_pairs(preference.swapped_replies(table(spark, sf_dir, "conversations")))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.counts(table(spark, sf_dir, "documents"), vocabulary("piece_bpe_32k.model"))


def op9_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frames.round_trip(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def op11_view_maintenance(spark: SparkSession, sf_dir: str) -> DataFrame:
    clients, sales, lines = (table(spark, sf_dir, name) for name in ("clients", "sales", "sale_lines"))
    return deltas.through_batches(
        deltas.scheduled(clients, F.concat(F.lit("c"), F.col("client_id").cast("string"))), deltas.scheduled(sales, F.concat(F.lit("s"), F.col("sale_id").cast("string"))),
        deltas.scheduled(lines, F.concat(F.lit("l"), F.col("sale_id").cast("string"), F.lit(":"), F.col("line_no").cast("string"))), table(spark, sf_dir, "vendors"), table(spark, sf_dir, "nation"),
    )


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, label)


def op13_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hnsw.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


QUERIES = {f.__name__: f for f in (op1_secrets, op2_topk, op3_bpe, op4_pii, op5_simhash, op6_preference, op7_toxicity, op8_token_counts, op9_frames, op10_decontaminate, op11_view_maintenance, op12_hard_negatives, op13_nearest)}
