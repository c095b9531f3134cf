from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from factloom.operators import merges, sites
from factloom.plans import views
from factloom.sources.store import Store
from factloom.streaming import current, watch

SCHEMA = "accession string, filed_at timestamp, form string"


def test_watch_appends_each_filing_once(spark, tmp_path):
    source, target, state = (str(tmp_path / n) for n in ("in", "out", "state"))

    def arrive(*ids):
        spark.createDataFrame([(i, datetime(2024, 1, 1, int(i)), "10-K") for i in ids], SCHEMA).coalesce(1).write.mode("append").parquet(source)
        watch.append_once(watch.arriving(spark, source, SCHEMA), target, state).awaitTermination(60)

    arrive("1", "2", "2")
    arrive("2", "3")
    assert sorted(r.accession for r in spark.read.parquet(target).collect()) == ["1", "2", "3"]


def test_sites(spark):
    lines = [("proved developed", 1), ("proved undeveloped reserves", 4), ("total proved", 6), ("Proved developed again", 500), ("x" * 120 + " proved reserves", 600), ("nothing", 601)]
    df = spark.createDataFrame([(1, n, t) for t, n in lines] + [(2, 3, "y" * 120 + " total proved")], "document_id int, line_no int, text string")
    found = sites.sites(df, sites.RESERVES).orderBy("rank").collect()
    assert [(r.first_line, r.last_line, r.closable) for r in found] == [(1, 6, True), (500, 500, False)]
    docs = sites.documents(df, spark.createDataFrame([(1, "a"), (2, "b")], "document_id int, name string"), sites.RESERVES).collect()
    assert [(r.document_id, r.n_sites, r.prose_hits) for r in docs] == [(1, 2, 1), (2, None, 1)]
    prices = spark.createDataFrame([(1, 1, "Average sales prices per Bbl"), (1, 2, "Average production costs per Boe")], "document_id int, line_no int, text string")
    assert sites.sites(prices, sites.PRODUCTION).first().closable and df.where(F.col("text") == "nothing").count() == 1


FACTS = "cik string, concept_key string, product_key string, period_end string, period_start_key string, filed_date string, unit_rank int, id string, value double"


def test_current_facts_follow_every_batch(spark, tmp_path):
    """After each batch the target is what the view says of all facts so far; late and repeated rows included."""
    source, target, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    row = lambda i, cik, filed, rank, value: (cik, "x", "", "2023-12-31", "", filed, rank, i, float(value))
    batches = [
        [row("a", "1", "2024-02-01", 1, 10), row("b", "1", "2024-02-01", 0, 11), row("c", "2", "2024-02-01", 0, 20), row("n", None, "2024-02-01", 0, 5)],
        [row("d", "1", "2023-02-01", 0, 9), row("e", "2", "2025-02-01", 3, 21), row("f", "3", "2024-02-01", 0, 30)],  # the first comes late
        [row("e", "2", "2025-02-01", 3, 21), row("g", "2", "2025-02-01", 3, 22), row("h", "4", "2024-02-01", 0, 40)],
    ]
    seen = []
    for batch in batches:
        seen += batch
        spark.createDataFrame(batch, FACTS).coalesce(1).write.mode("append").parquet(source)
        current.keep_current(spark, source, FACTS, target, state, part_rows=2).awaitTermination(120)
        everything = spark.createDataFrame(seen, FACTS)
        want = views.fact_current(Store(None, None, everything.withColumn("form", F.lit("10-K")), None, None)).drop("form")
        assert sorted(map(str, merges.read(spark, target).select(*want.columns).collect())) == sorted(map(str, want.collect()))
    assert sorted(map(str, current.current_cells(everything).select(*want.columns).collect())) == sorted(map(str, want.collect()))


def test_a_delivery_is_several_files(spark, sf_dir, monkeypatch):
    """A delivery of many facts comes in several files, which no single task writes, and the current facts are the same."""
    from factloom import catalogue, catalogue_filed

    monkeypatch.setattr(catalogue_filed, "DELIVERED_FACTS", 500)
    written = []
    monkeypatch.setattr(catalogue_filed.current, "keep_current", lambda spark, source, *a, keep=catalogue_filed.current.keep_current, **k: written.append((len(spark.read.parquet(source).inputFiles()), k["files_a_batch"])) or keep(spark, source, *a, **k))
    got = catalogue_filed.current_from_stream(spark, sf_dir)
    want = catalogue.QUERIES["fact_current"](spark, sf_dir)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.select(*got.columns).collect()))
    (files, a_batch), = written
    assert a_batch > 1 and files == 3 * a_batch


def test_the_target_is_the_state_and_many_tasks_write_it(spark, tmp_path):
    """No cells are kept beside the target, and a target of many rows is written in several files a batch."""
    source, target, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    for filed in ("2024-02-01", "2023-02-01", "2025-02-01"):
        rows = spark.range(2000).select(F.format_string("%05d", "id").alias("cik"), F.lit("x").alias("concept_key"), F.lit("").alias("product_key"), F.lit("2023-12-31").alias("period_end"), F.lit("").alias("period_start_key"), F.lit(filed).alias("filed_date"), F.lit(0).alias("unit_rank"), F.concat(F.lit(filed), F.col("id")).alias("id"), F.col("id").cast("double").alias("value"))
        rows.coalesce(1).write.mode("append").parquet(source)
        current.keep_current(spark, source, FACTS, target, state, file_rows=250).awaitTermination(120)
        assert not (tmp_path / "state" / "state").exists()
        assert len(current.merges.read(spark, target).inputFiles()) >= 4
    got = current.merges.read(spark, target)
    assert got.count() == 2000 and got.where("filed_date = '2025-02-01'").count() == 2000
