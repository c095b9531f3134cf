from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from factloom import catalogue, catalogue_filed
from factloom.operators import clusters, writes
from factloom.plans import counts, panel, quality, series, views
from factloom.registry import DEVELOPED, TOTAL, UNDEVELOPED
from factloom.sources.store import Store, open_store, tpch_store

FACT = "id string, cik string, concept_key string, value double, unit string, unit_rank int, product string, period_end string, accession string, extracted_by string, source_span string"


@pytest.fixture
def store(spark):
    def make(facts):
        rows = [(str(i), f.get("cik", "1"), f.get("key", TOTAL), float(f["value"]), f.get("unit", "MBoe"), f.get("rank", 0), f.get("product"), f.get("period", "2023-12-31"), f.get("acc", "a1"), f.get("by", "xbrl"), f.get("span")) for i, f in enumerate(facts)]
        fact = spark.createDataFrame(rows, FACT).withColumn("product_key", F.coalesce("product", F.lit(""))).withColumn("period_start_key", F.lit("")).withColumn("taxonomy", F.lit("us-gaap")).withColumn("tag", F.lit("t"))
        company = spark.createDataFrame([("1", "One", "ONE", "E&P"), ("2", "Two", "TWO", "E&P"), ("3", "Three", None, None)], "cik string, name string, ticker string, cohort string")
        filing = spark.createDataFrame([("a1", "1", "10-K", "2024-02-01"), ("a2", "1", "10-K/A", "2024-05-01"), ("a3", "1", "10-K", "2024-05-01")], "accession string, cik string, form string, filed_date string")
        return Store(company, filing, fact, spark.createDataFrame([("0", "found", "d.htm")], "fact_id string, status string, document string"), spark.createDataFrame([("0", 1.0, 5.0, "BOE")], "fact_id string, divisor double, canonical_value double, canonical_unit string"))

    return make


def test_current_prefers_date_then_unit_then_id(store):
    s = store([{"value": 1, "acc": "a1"}, {"value": 2, "acc": "a2", "rank": 1, "unit": "MMcfe"}, {"value": 3, "acc": "a3", "rank": 0}, {"value": 4, "acc": "a3", "rank": 0, "unit": "Boe"}, {"value": 9, "product": "oil", "acc": "a1"}])
    assert {(r.product, r.value) for r in views.fact_current(s).collect()} == {(None, 4.0), ("oil", 9.0)}
    assert views.fact_collision(s).count() == 1 and views.unit_discontinuity(s).first().units == "Boe,MBoe,MMcfe"


@pytest.mark.parametrize(
    ("d", "u", "t", "unit", "issue"),
    [(700, 300, 1000, "MBoe", None), (960, 1825, 865, "MBoe", "components do not sum to total"), (700, 320, 1000, "MBoe", None), (700, None, 1000, "MBoe", None),
     (1030, None, 1000, "MBoe", "developed exceeds total"), (1000, None, 1000, "MBoe", "developed equals total"), (700, 300, 1000, "Bcf", "units differ"), (5, None, 0, "MBoe", "total proved is zero")],
)
def test_consistency_ladder(store, d, u, t, unit, issue):
    rows = [{"key": DEVELOPED, "value": d}, {"key": TOTAL, "value": t, "unit": unit}] + ([{"key": UNDEVELOPED, "value": u}] if u is not None else [])
    found = views.reserve_consistency(store(rows)).collect()
    assert [r.issue for r in found] == [issue]


def test_products_never_meet(store):
    s = store([{"key": DEVELOPED, "value": 1, "product": "oil"}, {"key": TOTAL, "value": 5, "product": "gas"}])
    assert views.reserve_consistency(s).count() == 0


def test_insert_is_idempotent(store):
    s = store([{"value": 1}, {"value": 2, "acc": "a2"}])
    rows = s.fact.withColumn("ordinal", F.col("id"))
    assert writes.new_facts(s.fact, rows).count() == 0
    again = rows.withColumn("accession", F.lit("a3")).unionByName(rows)
    assert writes.insert_facts(s.fact, again).count() == 3
    assert writes.insert_facts(s.fact.limit(0), rows.unionByName(rows)).count() == 2


def test_checks(store):
    writes.check(store([{"value": 1}]))
    for bad in ({"value": 1, "acc": "zz"}, {"value": 1, "cik": "9"}, {"value": 1, "by": "llm:x"}):
        with pytest.raises(writes.ConstraintError):
            writes.check(store([bad]))
    writes.check(store([{"value": 1, "by": "llm:x", "span": "page 3"}]))


def test_upserts(spark):
    old = spark.createDataFrame([("1", "A", None, False), ("2", "B", "T", True)], "cik string, name string, ticker string, is_operator boolean")
    new = spark.createDataFrame([("1", "A2", "X", None), ("2", "B2", None, None), ("3", "C", None, None)], "cik string, name string, ticker string, is_operator boolean")
    assert {tuple(r) for r in writes.upsert_company(old, new).collect()} == {("1", "A2", "X", False), ("2", "B2", "T", True), ("3", "C", None, True)}
    filing = spark.createDataFrame([("a", "10-K", None, "d"), ("b", "10-K", "p", None)], "accession string, form string, period_end string, primary_doc string")
    rows = spark.createDataFrame([("a", "8-K", "q", "e"), ("b", "8-K", "q", "e")], "accession string, form string, period_end string, primary_doc string")
    assert {tuple(r) for r in writes.record_filing(filing, rows).collect()} == {("a", "10-K", "q", "d"), ("b", "10-K", "p", "e")}
    v = spark.createDataFrame([("f", "s1"), ("g", None)], "fact_id string, section string")
    changed = writes.changed_sections(v, spark.createDataFrame([("f", None), ("g", "s2")], "fact_id string, section string"))
    assert {tuple(r) for r in changed.collect()} == {("f", None), ("g", "s2")}
    assert writes.replace_by_key(v, spark.createDataFrame([("g", "new")], "fact_id string, section string"), ("fact_id",)).count() == 2


def test_publish_and_open(store, tmp_path):
    s = store([{"value": 1}, {"value": 2, "cik": "3", "key": DEVELOPED}])
    folder = str(tmp_path / "served")
    writes.publish(s, folder)
    back = open_store(s.fact.sparkSession, folder)
    assert back.fact.count() == 2 and counts.companies(back).count() == 2
    with pytest.raises(Exception):
        writes.publish(s, folder)
    with pytest.raises(FileNotFoundError):
        open_store(s.fact.sparkSession, str(tmp_path / "none"))
    assert "PartitionFilters: [isnotnull(concept_key" in back.fact.where(F.col("concept_key") == TOTAL)._jdf.queryExecution().toString()


def test_cohort_scope(store):
    s = store([{"value": 1}, {"value": 2, "cik": "3"}])
    assert {r.cik for r in panel.panel_wide(s).collect()} == {"1"}
    assert {r.cik for r in panel.panel_wide(s, include_uncohorted=True).collect()} == {"1", "3"}
    assert {r.cik for r in panel.panel(s, TOTAL, "2023-12-31").collect()} == {"1"}


def test_order_of_input_and_adaptive_plans_change_nothing(spark, sf_dir):
    s = tpch_store(spark, sf_dir)
    a = sorted(map(tuple, views.fact_current(s).select("id", "value").collect()))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        b = sorted(map(tuple, views.fact_current(s.with_facts(s.fact.orderBy(F.desc("value")))).select("id", "value").collect()))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert a == b and len({tuple(r) for r in views.fact_current(s).select(*views.CELL).collect()}) == len(a)


def test_windows(spark):
    rows = spark.createDataFrame([("d", n) for n in (1, 5, 90, 171, 172)], "doc string, line_no int")
    assert [r.cluster for r in clusters.gap_clusters(rows, ["doc"], "line_no", 80).orderBy("line_no").collect()] == [0, 0, 1, 2, 2]
    marks = spark.createDataFrame([("d", 5, "h1"), ("d", 100, "h2")], "doc string, line_no int, h string")
    assert [r.nearest for r in clusters.nearest_before(rows, marks, ["doc"], "line_no", "h").orderBy("line_no").collect()] == [None, "h1", "h1", "h2", "h2"]
    spans = spark.createDataFrame([("d", 0, 4, "x"), ("d", 80, 89, "y")], "doc string, s int, e int, v string")
    assert [r.v for r in clusters.interval_of(rows, spans, ["doc"], "line_no", "s", "e", "v").orderBy("line_no").collect()] == ["x", "x", "y", "y", "y"]


def test_publishing_shuffles_lines_before_they_are_facts(spark, sf_dir):
    """What is dealt is as narrow as the lines that are read, holds no id yet, and gives the facts with their filing's form."""
    own = tpch_store(spark, sf_dir)
    dealt = own.dealt(3)
    plan = dealt._jdf.queryExecution().executedPlan().toString()
    assert plan.index("md5(") < plan.index("rangepartitioning(")  # printed from the top: ids are made above the exchange
    assert sorted(map(str, dealt.collect())) == sorted(map(str, own.dated().select(*dealt.columns).collect()))
    assert own.with_facts(own.fact.limit(5)).dealt(2).count() == 5


def test_repeated_keys_are_counted_by_the_key(spark):
    """Keys that come again are found, a null one included."""
    rows = spark.createDataFrame([(k,) for k in ("a", "b", "a", None, None, "c", "c", "c")], "k string")
    assert {tuple(r) for r in writes.repeated(rows, "k").collect()} == {("a", 2), (None, 2), ("c", 3)}


def test_new_facts_shuffle_each_side_once(spark, store):
    """The rows that are appended pass one exchange, the old identities with them, and null is equal to null."""
    rows = store([{"value": 1, "product": None}, {"value": 2, "acc": "a2"}, {"value": 3, "acc": "a2"}]).fact.withColumn("ordinal", F.col("id"))
    rows = rows.withColumn("period_start_key", F.lit(None).cast("string"))
    fresh = writes.new_facts(rows.where("accession = 'a1'"), rows)
    assert [(r.id, r.value) for r in fresh.collect()] == [("1", 2.0)] and fresh.columns == rows.columns
    off = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    for key, value in off.items():
        spark.conf.set(key, value)
    try:
        assert writes.new_facts(rows.where("accession = 'a1'"), rows)._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_empty_payloads_publish_nothing(spark, sf_dir, monkeypatch):
    """What comes in is read as it is, and each task sends a company once."""
    monkeypatch.setattr(catalogue, "_PUBLISHED", {})
    found = catalogue_filed.QUERIES["empty_payloads"](spark, sf_dir)
    plan = found._jdf.queryExecution().executedPlan().toString()
    scan = plan.splitlines()[:next(i for i, line in enumerate(plan.splitlines()) if "l_suppkey" in line and "FileScan" in line)]
    up = next(line for line in reversed(scan) if "Exchange" in line or "HashAggregate" in line)
    assert "HashAggregate" in up and found.count() > 0 and not catalogue._PUBLISHED


def test_only_what_is_asked_for_is_published(spark, sf_dir, monkeypatch):
    """A query over companies publishes no facts; facts come with what they are checked against."""
    monkeypatch.setattr(catalogue, "_PUBLISHED", {})
    assert catalogue.QUERIES["merged_companies"](spark, sf_dir).count() > 0
    (_, done), = catalogue._PUBLISHED.values()
    assert done == {"company"}
    assert catalogue_filed.QUERIES["discovery_report"](spark, sf_dir).count() == 1 and done == {"company", "filing"}
    assert catalogue_filed.QUERIES["empty_payloads"](spark, sf_dir).count() > 0 and done == {"company", "filing"}
    assert catalogue_filed.QUERIES["alias_records"](spark, sf_dir).count() > 0 and done == {"company", "filing", "fact"}


def test_a_relation_is_checked_when_it_is_published(store, tmp_path):
    done = set()
    copy = writes.published(store([{"value": 1, "cik": "9"}]), str(tmp_path / "p"), done)
    assert copy.company.count() == 3 and done == {"company"}
    for _ in range(2):  # a broken relation is not taken for published
        with pytest.raises(writes.ConstraintError, match="fact: rows without their cik: 1"):
            copy.fact  # noqa: B018
    assert done == {"company", "filing"}
    assert copy.with_facts(copy.company.limit(1)).fact.count() == 1 and done == {"company", "filing"}


def _plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_published_facts_know_their_place(spark, sf_dir, tmp_path):
    """Current and replaced facts of a published store are a filter, without a shuffle, and those that a window finds; the
    place is taken where the cells are dealt to, behind one exchange by ranges."""
    own = tpch_store(spark, sf_dir)
    writes.publish(own, str(tmp_path / "s"), checked=False, file_facts=1000)
    copy = open_store(spark, str(tmp_path / "s"))
    for ask in (lambda s: views.fact_current(s).select("id", "cik", "form", "filed_date"), quality.superseded, views.cells):
        assert "Exchange" not in _plan(ask(copy))
        assert sorted(map(str, ask(copy).collect())) == sorted(map(str, ask(own).collect()))
        assert sorted(map(str, ask(copy.with_facts(copy.fact)).collect())) == sorted(map(str, ask(own).collect()))
    ranked = _plan(own.ranked(3))
    assert ranked.count("rangepartitioning(") == 1 and ranked.count("hashpartitioning(l_orderkey") <= 1 and "hashpartitioning(concept_key" not in ranked
    some = copy.with_facts(copy.fact.where("behind > 0"))  # fewer facts have other places
    assert views.fact_current(some).count() > 0


def test_places_of_long_company_numbers(spark, sf_dir, tmp_path):
    """Company numbers that are cut to the same ten digits are one company, whose facts have one current one a cell."""
    rows = spark.read.parquet(f"{sf_dir}/lineitem.parquet").limit(300)
    odd = F.when(F.col("l_linenumber") % 2 == 0, 12345678901).when(F.col("l_linenumber") % 3 == 0, 12345678902).otherwise(-1)
    rows.withColumn("l_suppkey", odd.cast("bigint")).write.parquet(f"{tmp_path}/lineitem.parquet")
    for name in ("supplier", "nation", "orders"):
        spark.read.parquet(f"{sf_dir}/{name}.parquet").write.parquet(f"{tmp_path}/{name}.parquet")
    own = tpch_store(spark, str(tmp_path))
    current = own.ranked(5).where("behind = 0")
    assert sorted(r.id for r in current.collect()) == sorted(r.id for r in views.fact_current(own).collect())


def test_a_history_shuffles_no_verdicts(spark, sf_dir, tmp_path):
    """Of verdicts and scales only those of the company's own cells are shuffled, whatever their number."""
    writes.publish(tpch_store(spark, sf_dir), str(tmp_path / "s"), checked=False)
    copy = open_store(spark, str(tmp_path / "s"))
    off = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in off}
    try:
        for k, v in off.items():
            spark.conf.set(k, v)
        plan = _plan(series.company_history(copy, "0000000001", TOTAL)).splitlines()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    scans = [i for i, line in enumerate(plan) if "FileScan" in line and "fact_id" in line]
    assert len(scans) == 2
    for i in scans:  # going up from the scan, the broadcast join comes before any exchange
        up = next(line for line in reversed(plan[:i]) if "Exchange hashpartitioning" in line or "BroadcastHashJoin" in line)
        assert "BroadcastHashJoin" in up
    assert "filing" not in "".join(line for line in _plan(counts.periods(copy, TOTAL)).splitlines() if "Join" in line)
