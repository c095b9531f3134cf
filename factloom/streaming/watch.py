"""A watcher: filings that arrive as files are deduplicated by accession and appended once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from factloom.sources.store import exists


def arriving(spark: SparkSession, folder: str, schema: str, at: str = "filed_at", delay: str = "7 days", key: str = "accession") -> DataFrame:
    """New rows of the folder's Parquet files, each key once within the delay."""
    return spark.readStream.schema(schema).parquet(folder).withWatermark(at, delay).dropDuplicatesWithinWatermark([key])


def append_once(rows: DataFrame, target: str, checkpoint: str, key: str = "accession") -> StreamingQuery:
    """Appends what the target does not hold; a batch that runs again adds nothing."""

    def put(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        own = batch.select(key)
        known = spark.read.schema(own.schema).parquet(target) if exists(spark, target) else own.limit(0)
        batch.dropDuplicates([key]).join(known, key, "left_anti").withColumn("batch_id", F.lit(batch_id)).write.mode("append").parquet(target)

    return rows.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def event_counts(events: DataFrame, at: str = "ts", width: str = "1 day", delay: str = "1 hour") -> DataFrame:
    """Counts of a windowed stream with late rows up to the delay."""
    return events.withWatermark(at, delay).groupBy(F.window(at, width), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total"))
