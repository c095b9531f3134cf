from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from factloom.functions import stems
from factloom.operators import acquisition, clusters, sites, succession, writes
from factloom.plans import service, views
from factloom.registry import TOTAL
from factloom.sources import client, corpus, payloads
from factloom.sources.store import TABLES, open_older, open_store, tpch_store


class Pages:
    """An archive of two pages a form, of which the last is repeated, and of failures."""

    def __init__(self, fails=0):
        self.asked, self.fails = [], fails

    def text(self, url):
        self.asked.append(url)
        if self.fails:
            self.fails -= 1
            raise client.SourceError("busy")
        if "missing" in url:
            raise client.NotFound(url)
        return "<cik>1</cik><cik>22</cik>" if url.endswith("start=0&output=atom") else "<CIK>22</CIK><cik>333</cik>"


def test_enumeration_ends_with_a_repeated_page():
    pages = Pages()
    assert client.filers_of(pages, "1311", ("10-K", "20-F")) == ["0000000001", "0000000022", "0000000333"]
    assert len(pages.asked) == 4


def test_cache_and_pace(tmp_path):
    pages = Pages()
    cache = client.Cached(str(tmp_path), pages)
    assert cache.text("https://x/a?start=9") == cache.text("https://x/a?start=9") and len(pages.asked) == 1
    cache.text("https://x/a?start=9", refresh=True)
    assert len(pages.asked) == 2
    with pytest.raises(client.NotFound):
        client.Cached(str(tmp_path)).text("https://x/other")
    now, slept = [0.0], []

    def sleep(seconds):
        slept.append(seconds)
        now[0] += seconds

    paced = client.Paced(Pages(fails=2), "someone", rate=4, clock=lambda: now[0], sleep=sleep)
    assert "333" in paced.text("u") and slept[0] == client.FIRST_WAIT
    paced.text("u")
    assert slept[-1] == pytest.approx(0.25)
    with pytest.raises(client.SourceError):
        client.Paced(Pages(fails=9), "someone", sleep=lambda s: None).text("u")
    gone = Pages()
    with pytest.raises(client.NotFound):
        client.Paced(gone, "someone", sleep=lambda s: None).text("missing")
    assert len(gone.asked) == 1
    with pytest.raises(ValueError):
        client.Paced(gone, " ")


@pytest.mark.parametrize(("word", "stem"), [("caresses", "caress"), ("ponies", "poni"), ("agreed", "agre"), ("plastered", "plaster"), ("hopping", "hop"), ("filing", "file"), ("happy", "happi"), ("relational", "relat"), ("conditional", "condit"), ("triplicate", "triplic"), ("hopefulness", "hope"), ("adoption", "adopt"), ("probate", "probat"), ("controlling", "control"), ("oscillators", "oscil"), ("generalizations", "gener"), ("sky", "sky"), ("of", "of")])
def test_stems(word, stem):
    assert stems.porter(word) == stem


def test_phrases_find_forms_and_nothing_else(spark):
    lines = ["Proved developed", "proving development", "unproved developed", "proved, developed", "prove develops", "proved undeveloped", "proverb developed"]
    df = spark.createDataFrame([(1, i, t) for i, t in enumerate(lines)], "document_id int, line_no int, text string")
    found = {r.text for r in df.where(F.col("text").rlike(sites.phrase_pattern(("proved developed",)))).collect()}
    assert found == {"Proved developed", "proving development", "proved, developed", "prove develops"}


def test_interval_sweep(spark):
    spans = [("a", 0, 100, "outer"), ("a", 10, 20, "inner"), ("a", 15, 16, "core"), ("a", 200, 210, "far"), ("a", 300, 250, "odd"), ("b", 5, 6, "b"), ("a", None, 9, "none")]
    points = [("a", p) for p in (-5, 0, 12, 15, 17, 50, 100, 140, 160, 205, 240, 300, 999)] + [("b", 1), ("c", 1), ("a", 12)]

    def plain(key, p):
        own = [(s, max(s, e), v) for k, s, e, v in spans if k == key and s is not None]
        inside = [x for x in own if x[0] <= p <= x[1]]
        if inside:
            return max(inside)[2]
        return min(((min(abs(p - s), abs(p - e)), s, v) for s, e, v in own), default=(None, None, None))[2]

    rows = spark.createDataFrame(points, "doc string, at int").withColumn("kind", F.lit("x"))
    marks = spark.createDataFrame(spans, "doc string, s int, e int, v string")
    got = clusters.interval_of(rows, marks, ["doc"], "at", "s", "e", "v")
    assert got.columns == ["doc", "at", "kind", "v"]
    assert sorted(map(str, ((r.doc, r.at, r.v) for r in got.collect()))) == sorted(str((k, p, plain(k, p))) for k, p in points)


def test_many_nested_intervals_of_one_key(spark):
    """Of 100,000 intervals inside of each other, each point finds the innermost that holds it."""
    n = 100_000
    spans = spark.range(n).select(F.lit("a").alias("doc"), F.col("id").alias("s"), (2 * n - F.col("id")).alias("e"), F.col("id").cast("string").alias("v"))
    points = spark.range(0, 2 * n + 1, 7).select(F.lit("a").alias("doc"), F.col("id").alias("at"))
    got = clusters.interval_of(points, spans, ["doc"], "at", "s", "e", "v")
    wrong = got.where(F.col("v") != F.least(F.col("at"), 2 * n - F.col("at"), F.lit(n - 1)).cast("string"))
    assert wrong.count() == 0 and got.where("v is null").count() == 0 and got.count() == points.count()
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "collect_list" not in plan


def test_intervals_against_a_plain_search(spark):
    draw = random.Random(2)
    spans = [(draw.choice("ab"), s := draw.randint(-60, 60), s + draw.choice([-1, 0, 1, 5, 30, 90]), f"v{i}") for i in range(60)]
    points = [(k, p) for k in "abc" for p in range(-70, 160, 3)]

    def plain(key, p):
        own = [(s, max(s, e), v) for k, s, e, v in spans if k == key]
        inside = [x for x in own if x[0] <= p <= x[1]]
        return {x[2] for x in inside if x[:2] == max(inside)[:2]} if inside else {v for s, e, v in own if min(abs(p - s), abs(p - e)) == min(min(abs(p - a), abs(p - b)) for a, b, _ in own)} or {None}

    got = clusters.interval_of(spark.createDataFrame(points, "doc string, at int"), spark.createDataFrame(spans, "doc string, s int, e int, v string"), ["doc"], "at", "s", "e", "v").collect()
    assert len(got) == len(points) and all(r.v in plain(r.doc, r.at) for r in got)


def test_intervals_of_odd_events_as_their_sql(spark, tmp_path):
    """Ids that stand in several rows are one event, null users meet no one, and a missing time is far from all."""
    import duckdb

    from factloom import catalogue_filed, oracles_filed

    t = lambda h, s=0: f"2024-01-0{1 + h // 24} {h % 24:02d}:00:{s:02d}"
    rows = [
        (0, t(1), 1, "signup"), (1, t(5), 1, "purchase"), (2, t(5, 30), 1, "view"), (2, t(90), 2, "view"), (3, t(80), 1, "view"), (3, t(80), 2, "view"), (4, t(60), 2, "purchase"),
        (5, t(2), None, "signup"), (6, t(3), None, "view"), (7, None, 1, "view"), (8, None, 3, "purchase"), (9, t(4), 3, "view"), (10, None, 4, "view"), (None, t(70), 2, "view"), (None, t(7), 1, "view"),
    ]
    spark.createDataFrame(rows, "event_id long, ts string, user_id long, event_type string").withColumn("ts", F.col("ts").cast("timestamp_ntz")).coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    got = catalogue_filed.interval_of(spark, str(tmp_path)).collect()
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM read_parquet('{tmp_path}/events.parquet/*.parquet')")
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, con.execute(oracles_filed.ORACLE_SQL["interval_of"]).fetchall()))


def test_equal_intervals_are_settled_by_value(spark):
    """The least value of equal intervals is found, before, in, between and behind them, whatever their order."""
    values = list("dbacef")
    spans = [(s, e, f"{v}{s}") for v in values for s, e in ((0, 50), (10, 20), (90, 95))]
    points = spark.range(-5, 120).select(F.lit("a").alias("doc"), F.col("id").alias("at"))
    for order in (spans, spans[::-1]):
        got = clusters.interval_of(points, spark.createDataFrame([("a", *x) for x in order], "doc string, s int, e int, v string"), ["doc"], "at", "s", "e", "v").collect()
        assert len(got) == 125 and {r.v[0] for r in got} == {"a"}


def test_predecessors_with_commas_and_clauses(spark):
    texts = {
        "As reported by Big Oil, Inc., a Delaware corporation and the predecessor registrant": "Big Oil, Inc",
        "On May 1, 2024, Big Oil Corp, a New Jersey corporation and the predecessor registrant": "Big Oil Corp",
        "a notice by the predecessor registrant, Old Trust (the Trust)": "Old Trust",
        "became the successor issuer to Fund of the North pursuant to Rule 12g-3": "Fund of the North",
        "predecessor registrant, ab": None,
        "": None,
    }
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    assert {r.t: r.p for r in rows.select("t", succession.predecessor_name(F.col("t")).alias("p")).collect()} == texts


def test_service(spark, sf_dir):
    store, opened, version = tpch_store(spark, sf_dir), [], [1]

    def open_():
        opened.append(1)
        return store

    own = service.Service(open_, lambda: version[0], fresh=0.0)
    first = own.ask("concepts")
    assert own.ask("concepts") == first and len(opened) == 1
    version[0] = 2
    assert own.ask("concepts") == first and len(opened) == 2
    some = store.fact.limit(1).first()
    assert own.ask("citation", id=some["id"])[0]["cik"] == some["cik"]
    for name, parameters, error in (
        ("nothing", {}, service.Missing), ("citation", {"id": "no"}, service.Missing), ("panel", {"concept": TOTAL}, service.BadRequest), ("panel", {"concept": "x", "period": "latest"}, service.BadRequest),
        ("concepts", {"x": "1"}, service.BadRequest), ("company", {"cik": "12x"}, service.BadRequest), ("trends", {"concept": TOTAL, "limit": "-1"}, service.BadRequest), ("trends", {"concept": TOTAL, "normalized": "maybe"}, service.BadRequest),
    ):
        with pytest.raises(error):
            own.ask(name, **parameters)
    assert len(own.ask("trends", concept=TOTAL, limit="3", normalized="false")) <= 3


def test_published_store(spark, sf_dir, tmp_path):
    store = tpch_store(spark, sf_dir)
    writes.publish(store, str(tmp_path / "s"), checked=False)
    again = open_store(spark, str(tmp_path / "s"))
    assert again.fact.count() == store.fact.count() and {"form", "filed_date"} <= set(again.fact.columns)
    assert sorted(again.dated().columns) == sorted([*store.fact.columns, "form", "filed_date"])
    plan = again.fact.where("concept_key = 'x'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(concept_key" in plan
    with pytest.raises(Exception):
        writes.publish(store, str(tmp_path / "s"), checked=False)
    with pytest.raises(FileNotFoundError):
        open_store(spark, str(tmp_path / "none"))
    with pytest.raises(ValueError):
        writes.write_csv(store.company, str(tmp_path / "c"), "cik", most=3)


def test_documents_are_stored_and_read_again(spark, tmp_path):
    root = str(tmp_path / "corpus")
    rows = spark.createDataFrame([("a-1", "x.htm", "<p>é</p>"), ("a-2", "y.htm", None)], "accession string, name string, raw string")
    sizes = {r.name: r.size for r in acquisition.store_documents(rows, root).collect()}
    assert sizes == {"x.htm": 9, "y.htm": 0}
    assert {(r.accession, r.name, r.raw) for r in corpus.read_corpus(spark, root).collect()} >= {("a-1", "x.htm", "<p>é</p>")}
    with pytest.raises(Exception, match="no page 3 of 2"):
        spark.range(1).select(corpus.sheet(F.lit("a<hr>b"), F.lit(3), strict=True)).collect()


def test_blank_profiles(spark):
    ciks = spark.createDataFrame([("0000000001",)], "cik string")
    none = payloads.parsed(spark.createDataFrame([(None,)], "doc string"), "doc")
    r = payloads.profiles_of(ciks, none).first()
    assert (r.error, r.tickers, r.annual_count, r.name) == ("no submissions", [], 0, None)


@pytest.mark.parametrize("name", ["../up.htm", "", "..", "a/b.htm"])
def test_documents_stay_in_their_folder(spark, tmp_path, name):
    rows = spark.createDataFrame([("a-1", name, "<p>x</p>")], "accession string, name string, raw string")
    with pytest.raises(Exception, match="no plain name"):
        acquisition.store_documents(rows, str(tmp_path / "root")).collect()
    assert not (tmp_path / "up.htm").exists()


def test_an_older_store_is_read_with_nulls(spark, sf_dir, tmp_path):
    own = tpch_store(spark, sf_dir)
    for table in TABLES:
        frame = getattr(own, table)
        (frame.drop("extracted_by", "unit_rank") if table == "fact" else frame.drop("cohort") if table == "company" else frame).limit(50).write.parquet(f"{tmp_path}/{table}")
    older = open_older(spark, str(tmp_path))
    assert older.fact.where("extracted_by is null and unit_rank is null").count() == 50 and older.company.where("cohort is null").count() == older.company.count() > 0
    assert "form" in older.dated().columns
    views.register(older, "test_")
    assert spark.sql("SELECT count(*) AS n FROM test_fact_current WHERE form IS NOT NULL").first().n == views.fact_current(older).count()
