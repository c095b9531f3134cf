from __future__ import annotations

import os
import re

import pytest
from factloom.operators import merges, writes
from pyspark.sql import functions as F

FACT = "cik string, concept_key string, product_key string, period_end string, period_start_key string, unit string, accession string, extracted_by string, value double, ordinal int"


def files(folder):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(folder) for f in names if f.endswith(".parquet")}


def fact(cik, concept, value, ordinal=0, accession="a"):
    return (cik, concept, "", "2023-12-31", "", "MBoe", accession, "xbrl", float(value), ordinal)


def rows_of(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


def test_append_touches_no_file_and_reads_only_the_range(spark, tmp_path):
    folder = f"{tmp_path}/f"
    old = [fact(f"{i:03}", c, i) for i in range(50) for c in ("x", "y", "z")] + [fact(None, "x", 7)]
    merges.lay_out(spark.createDataFrame(old, FACT), folder, "cik", by=("concept_key",), file_rows=20)
    before = files(folder)
    new = [fact("010", "x", 99), fact("010", "x", 5, accession="b"), fact("010", "x", 6, ordinal=1, accession="b"), fact("900", "w", 1), fact(None, "x", 8), fact(None, "y", 9)]
    assert merges.append_new(spark, folder, spark.createDataFrame(new, FACT)) == 3
    assert {p: t for p, t in files(folder).items() if p in before} == before and len(files(folder)) > len(before)
    want = [*old, fact("010", "x", 5, accession="b"), fact("900", "w", 1), fact(None, "y", 9)]
    assert rows_of(merges.read(spark, folder), "cik", "concept_key", "value") == sorted(((r[0], r[1], r[8]) for r in want), key=str)
    again = files(folder)
    assert merges.append_new(spark, folder, spark.createDataFrame(new, FACT)) == 0 and files(folder) == again
    assert merges.append_new(spark, folder, spark.createDataFrame([], FACT)) == 0 and files(folder) == again


@pytest.fixture
def companies(spark, tmp_path):
    folder = f"{tmp_path}/c"
    rows = [(f"{i:03}", f"n{i}", None if i % 3 else f"t{i}") for i in range(200)]
    merges.lay_out(spark.createDataFrame(rows, "cik string, name string, ticker string"), folder, "cik", part_rows=10, file_rows=30)
    return folder, {r[0]: r[1:] for r in rows}


def part_of(path):
    return int(re.search(r"part_of_20=(\d+)", path)[1])


def test_upsert_writes_the_parts_of_its_keys_alone(spark, companies):
    folder, want = companies
    before = files(folder)
    new = [("007", "new", None), ("777", "added", "T")]
    touched = merges.merge(spark, folder, spark.createDataFrame(new, "cik string, name string, ticker string"), "cik", lambda a, b: writes.upsert(a, b, "cik", refresh=("name", "ticker")))
    now = files(folder)
    changed = {part_of(p) for p in set(before) ^ set(now)}
    assert len(changed) == touched <= 2
    assert {p: t for p, t in before.items() if part_of(p) not in changed} == {p: t for p, t in now.items() if part_of(p) not in changed}
    want |= {"007": ("new", want["007"][1]), "777": ("added", "T")}
    assert rows_of(merges.read(spark, folder), "cik", "name", "ticker") == sorted(((k, *v) for k, v in want.items()), key=str)


def test_replace_delete_and_emptied_parts(spark, companies):
    folder, want = companies
    new = spark.createDataFrame([("003", "x", None), ("003", "y", None)], "cik string, name string, ticker string")
    merges.merge(spark, folder, new, "cik", lambda a, b: writes.replace_by_key(a, b, ("cik",)))
    assert rows_of(merges.read(spark, folder).where("cik = '003'"), "name") == [("x",), ("y",)]
    part = next(part_of(p) for p in files(folder))
    gone = spark.read.parquet(folder).where(F.col("part_of_20") == part).select("cik").distinct()
    gone = spark.createDataFrame(gone.collect(), "cik string")
    merges.merge(spark, folder, gone, "cik", lambda a, b: writes.delete_matching(a, b, ("cik",)))
    assert not any(part_of(p) == part for p in files(folder))
    assert merges.read(spark, folder).select("cik").distinct().count() == 200 - gone.count()


def test_faults(spark, companies):
    folder, _ = companies
    rows = spark.createDataFrame([("007", "new")], "cik string, name string")
    with pytest.raises(ValueError, match="moves rows"):
        merges.merge(spark, folder, rows, "cik", lambda a, b: a.withColumn("cik", F.concat("cik", F.lit("moved"), F.col("name"))))
    assert merges.merge(spark, folder, rows.limit(0), "cik", lambda a, b: a) == 0
    with pytest.raises(Exception, match="(?i)path"):
        merges.read(spark, f"{folder}-none")
