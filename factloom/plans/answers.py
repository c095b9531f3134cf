"""Answers kept by snapshot, with bounded staleness; and one-row reports over decisions."""

from __future__ import annotations

import threading
import time
from collections.abc import Callable
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class Answers:
    """A memo of small results keyed by the store's version, which is looked up at most every `fresh` seconds. A result
    whose store moved on while it was computed is returned but not kept; computing happens outside of the lock."""

    def __init__(self, version: Callable[[], Any], fresh: float = 2.0, clock: Callable[[], float] = time.monotonic):
        self.version, self.fresh, self.clock = version, fresh, clock
        self.lock, self.kept, self.seen, self.checked = threading.Lock(), {}, None, float("-inf")

    def _now(self, look: bool = False) -> Any:
        with self.lock:
            if look or self.clock() - self.checked >= self.fresh:
                current = self.version()
                if current != self.seen:
                    self.kept.clear()
                self.seen, self.checked = current, self.clock()
            return self.seen

    def get(self, key: Any, compute: Callable[[], Any]) -> Any:
        before = self._now()
        with self.lock:
            if key in self.kept:
                return self.kept[key]
        value = compute()
        if self._now(look=True) == before:
            with self.lock:
                self.kept[key] = value
        return value

    def warm(self, calls: dict[Any, Callable[[], Any]]) -> threading.Thread:
        """Computes answers in the background."""
        thread = threading.Thread(target=lambda: [self.get(k, f) for k, f in calls.items()], daemon=True)
        thread.start()
        return thread


def store_version(spark, folder: str) -> tuple:
    """Names, sizes and times of a store's table folders, by the file system that Spark uses for them."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return tuple(sorted((s.getPath().getName(), s.getLen(), s.getModificationTime()) for s in fs.listStatus(path))) if fs.exists(path) else ()


def outcomes(rows: DataFrame, *by: str) -> DataFrame:
    """Counts of a decision column, as run reports show them."""
    return rows.groupBy(*by).agg(F.count("*").alias("n")).orderBy(F.desc("n"), *by)


def coverage_totals(coverage: DataFrame, since: str) -> DataFrame:
    """How many companies ever have a concept, and how many have it since a period."""
    return coverage.groupBy("concept_key").agg(F.count_if("tagged").alias("ever"), F.count_if(F.col("latest_period") >= since).alias("current")).orderBy("concept_key")


def producer_evidence(fact: DataFrame, documents: DataFrame, concepts: tuple[str, ...], count) -> DataFrame:
    """(cik, concepts, hits, documents, best): reserve concepts stored, phrase hits over documents, the document with
    the most. documents: cik, name, text; count(text) -> hits."""
    tagged = fact.where(F.col("concept_key").isin(*concepts)).groupBy("cik").agg(F.array_sort(F.collect_set("concept_key")).alias("concepts"))
    read = documents.select("cik", "name", count(F.col("text")).alias("h")).groupBy("cik").agg(F.sum("h").alias("hits"), F.count("*").alias("documents"), F.max_by("name", F.struct(F.col("h"), F.col("name"))).alias("best"))
    return tagged.join(read, "cik", "full_outer")
