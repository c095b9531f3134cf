from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from factloom.documents import evidence, functions, grid, layout, markup, operators, production, reserves, wording
from factloom.registry import DEVELOPED, TOTAL, UNDEVELOPED


def table(*rows, head="td"):
    return "<table>" + "".join("<tr>" + "".join(f"<{head}>{c}</{head}>" for c in r) + "</tr>" for r in rows) + "</table>"


FLAT = table(["", "Oil (MBbls)", "Natural Gas (MMcf)", "Oil and NGLs (MBbls)", "Total (MBoe)"], ["Proved developed", "400", "600", "450", "500"], ["Proved undeveloped", "100", "(3)", "120", "200"], ["Total proved", "500", "603", "570", "700"], ["Total proved, net", "1", "2"])
ROLL = "<p>For the year ended December 31, 2023</p>" + table(
    ["", "Oil", "Gas", "NGL", "Total"], ["(MBbls)", "(MMcf)", "(MBbls)", "(MBoe)"], ["Total proved reserves:"], ["Beginning of year", "90", "60", "10", "110"], ["Production", "(5)", "(6)", "—", "(6)"], ["End of year", "100", "60", "—", "110"],
    ["Proved developed reserves:"], ["Beginning of year", "50", "30", "5", "60"], ["End of year", "60", "30", "—", "65"],
)
REGIONS = table(["Oil (Bbls)"], ["", "Canada", "United States", "Total"], ["Proved developed reserves, December 31, 2022", "10", "20", "30"])
PARTS = "<p>December 31, 2024</p>" + table(["", "Oil (MBbls)", "Total (MBoe)"], ["Proved developed producing", "40", "50"], ["Proved developed non-producing", "5", "6"], ["Proved undeveloped", "7", "9"])
SALES = table(
    ["", "2023", "2022"], ["Production Volumes:"], ["Oil (MBbls)", "10", "9"], ["Natural gas (MMcf)", "12", "6"], ["Total (MBoe)", "12", "10"],
    ["Average sales price (excluding effect of derivatives):", "", ""], ["Oil (per Bbl)", "$80.00", "90.00"], ["Gas (per Mcf)", "3.00", "4.00"], ["Average production cost per BOE", "$9.50", "8.25"], ["Oil mix percent", "50%", "60%"],
)
IX = """<ix:header><b>silent 12,345</b></ix:header><context id="c1"><period><endDate>2023-12-31</endDate></period></context>
<context id="c2"><segment><explicitMember dimension="srt:ProductOrServiceAxis">srt:OilReservesMember</explicitMember></segment><period><instant>2023-12-31</instant></period></context>
<unit id="u"><measure>utr:MBoe</measure></unit><p>Plain 3,613 here</p><p>Reserves <ix:nonFraction name="srt:ProvedDevelopedReservesVolume" contextRef="c1" unitRef="u" scale="3" id="f-1">3,618</ix:nonFraction> and
<ix:nonFraction name="srt:ProvedDevelopedReservesVolume" contextRef="c2" unitRef="u" scale="3" sign="-" id="f-2">1,000</ix:nonFraction></p>"""


def got(readings):
    return {(r.concept_key, r.product, r.period_end): (r.value, r.unit) for r in readings}


def test_flat_tables():
    found = got(reserves.readings(FLAT, "2023-12-31"))
    assert found[DEVELOPED, "oil", "2023-12-31"] == (400, "MBbls") and found[TOTAL, None, "2023-12-31"] == (700, "MBoe")
    assert (UNDEVELOPED, "gas", "2023-12-31") not in found  # negative
    assert 450 not in {v for v, _ in found.values()}  # a column of two products
    assert reserves.readings(FLAT) == []  # no period


def test_rollforwards():
    found = got(reserves.readings(ROLL))
    assert found[TOTAL, None, "2023-12-31"] == (110, "MBoe") and found[TOTAL, "oil", "2022-12-31"] == (90, "MBbls")
    assert found[DEVELOPED, None, "2023-12-31"] == (65, "MBoe") and found[DEVELOPED, "ngl", "2023-12-31"] == (0, "MBbls")
    assert len(found) == 16


def test_regions_components_and_refusals():
    assert got(reserves.readings(REGIONS, "2023-12-31")) == {(DEVELOPED, "oil", "2022-12-31"): (30, "bbl")}
    assert got(reserves.readings(PARTS))[DEVELOPED, None, "2024-12-31"] == (56, "MBoe")
    assert reserves.readings(table(["", "A (MBoe)", "B (MBoe)"], ["Total proved", "1", "2"]), "2023-12-31") == []
    assert reserves.unit_of("millions of barrels of oil equivalent") == "MMBoe" and reserves.unit_of("thousand cubic feet") == "Mcf" and reserves.unit_of("acres") is None


def test_production():
    found = production.readings(SALES)
    of = {(r.concept_key, r.product, r.period_end): (r.value, r.unit, r.is_hedged) for r in found}
    assert of[production.VOLUME, "gas", "2022-12-31"] == (6, "MMcf", None)
    assert of[production.PRICE, "oil", "2023-12-31"] == (80, "USD/bbl", False)
    assert of[production.COST, None, "2022-12-31"] == (8.25, "USD/Boe", None)
    assert len(found) == 12
    assert production.volumes_close(found) == {"2023-12-31": True, "2022-12-31": True}
    assert production.implied_revenue(found, "2023-12-31") == pytest.approx(10_000 * 80 + 12_000 * 3)
    other = [production.Reading(r.concept_key, r.product, r.value * 3, r.unit, r.period_end, r.is_hedged, 9, r.row_label, "", 0) for r in found]
    assert production.choose([other, found], 836_000, "2023-12-31") is found
    assert production.choose([other, found], None, "2023-12-31") is None and production.choose([found, list(found)], None, "2023-12-31") is found
    assert wording.plain_number("($1,200.5)") == -1200.5 and wording.plain_number("x") is None


def test_grids():
    g = grid.grids("<table></table>" + table([""], ["December 31, 2023"], ["Oil", "Gas"], ["Total proved", "1", "2"]))[0]
    assert g.labels() == ["Oil", "Gas"] and [c[3] for c in g.cells() if c[2] in "12"] == ["Oil", "Gas"]
    two = grid.grids(table(["", "Bcfe"], ["a", "7"]) + "x" * 400 + table(["", "MBoe"], ["b", "7"]))
    assert grid.header_of(two, "7") == ("Bcfe", "a") and grid.header_of(two, "7", near=two[1].start + 5) == ("MBoe", "b")


def test_layout():
    contents = "".join(f"<p>Item {n}. Title {n} ..... {n}</p>" for n in range(1, 7))
    raw = f"<head>gone</head>{contents}<hr/><p>Item 1. Business</p><p>We&nbsp;drill − a lot</p><p>12</p><hr><p>Item 1A. Risk factors</p><p>text</p>"
    page = layout.read(raw)
    assert [h for _, h in page.headings] == ["Item 1. Business", "Item 1A. Risk factors"]
    line = next(x for x in page.lines if "drill" in x.text)
    assert line.text == "We drill - a lot" and line.page == 2 and page.section_at(line.start) == "Item 1. Business" and page.folios == {2: 12}
    assert page.line_at(line.start + 3) is line and page.line_at_raw(raw.index("drill")) is line and page.pages == 3
    assert page.section_at(0) is None and layout.read("").lines == [] and layout.read(None).text == ""


def test_markup():
    a, b = markup.figures(IX)
    assert (a.value, a.unit, a.product, a.period_end, a.element_id) == (3_618_000, "MBoe", None, "2023-12-31", "f-1")
    assert (b.value, b.product) == (-1_000_000, "oil")
    pick = lambda v, tag="ProvedDevelopedReservesVolume": markup.match([a, b], tag, "2023-12-31", v)
    assert pick(3_618_400) is a and pick(3_613_000) is None and pick(3_618_000, "Other") is None and pick(3_618_000, None) is None
    assert markup.product_of({"x:EnergyAxis": "srt:OilAndGasMember"}) == (None, "OilAndGasMember")
    assert markup.half_last_place("2.5", 9) == 5e7 and markup.half_last_place("n/a", 0) is None


def test_evidence():
    page = layout.read("<p>Reserves (MMBoe) 1,234 and 11,234 and (1,234)</p><p>Item 2. Properties</p><p>net 56.7 MBoe; other</p>")
    hit = evidence.find_value(page, 1234e6)
    assert (hit.printed, hit.scale, hit.hits, hit.units[0]) == ("1,234", 1e6, 2, "MMBoe")
    assert evidence.find_value(page, 56.7).section == "Item 2. Properties" and evidence.find_value(page, 56.7).units[0] == "MBoe"
    assert evidence.find_value(page, 999) is None and not evidence.searchable(12.0) and not evidence.searchable(0) and evidence.searchable(123)


@pytest.mark.parametrize(
    ("text", "value", "printed", "scale", "hits"),
    [
        ("total 1,234,567 here", 1234567, "1,234,567", 1.0, 1), ("1,234.6 and 1,235", 1234567, "1,234.6", 1e3, 1), ("1,234.57, 1,235", 1234567, "1,235", 1e3, 1), ("1,234.57; 1,235", 1234567, "1,234.57", 1e3, 1), ("say 1,235.", 1234567, "1,235", 1e3, 1),
        ("(1,234) 1,234 -1,234", -1234, "(1,234)", 1.0, 1), ("1,234 -1,234", -1234, "-1,234", 1.0, 1), ("(1,234) x (1,234)", -1234, "(1,234)", 1.0, 2), ("-1,234 and (1,234)", 1234, "1,234", 1.0, 2), ("11,234 1,234,5 1,234,567", 1234, None, 0, 0), ("1234", 1234, None, 0, 0),
        ("0.45 to", 0.45, "0.45", 1.0, 1), ("2,500,000", 2500, "2,500,000", 1e-3, 1), ("1,234.5", 1234, "1,234", 1.0, 1), ("12.5", 12.5, "12.5", 1.0, 1), ("", 5555, None, 0, 0), ("5.555.", 5.555, None, 0, 0), ("x-(777)", -777, "(777)", 1.0, 1),
    ],
)
def test_numbers_of_a_text(text, value, printed, scale, hits):
    page = layout.read(f"<p>{text}</p>")
    hit = evidence.find_value(page, value)
    assert (hit and (hit.printed, hit.scale, hit.hits)) == (printed and (printed, scale, hits))
    if hit:
        assert page.text[hit.offset : hit.offset + len(printed)] == printed


def test_units_near_a_number():
    near = lambda t, v: evidence.find_value(layout.read(f"<p>{t}</p>"), v).units
    assert near("Gas (Bcf) and oil (MBbl/d): 1,234 MMcfe", 1234) == ("MMcfe", "MBbl", "Bcf")
    assert near("(see 12 Bcf) (MBoe) " + "x " * 1300 + "1,234", 1234) == () and near("1,234; MBoes", 1234) == ("MBoes",) and near("1,234 (unaudited)", 1234) == ()


def test_resources_in_odd_writing():
    raw = '<XBRLI:Context ID="a"><xbrli:entity/><period><startDate> 2023-01-01 </startDate><endDate>2023-12-31</endDate></period></XBRLI:Context><x>text</x><context id="b"><period><instant>2022-12-31</instant></period></context><unit id="u"><divide><measure>iso:USD</measure><measure>utr:bbl</measure></divide></unit><context>'
    known, units_ = markup.resources(raw)
    assert (known["a"].start, known["a"].end, known["b"].end, known["b"].start, units_) == ("2023-01-01", "2023-12-31", "2022-12-31", None, {"u": "USD/bbl"})
    assert markup.resources("no marks") == ({}, {}) and markup.figures(None) == []


def test_operators(spark):
    corpus = spark.createDataFrame([("a-1", "f.htm", FLAT + ROLL, 0), ("a-1", "x.htm", "<p>12,345 units</p>", 1), ("a-2", "p.htm", SALES, 0), ("a-3", "i.htm", IX, 0), ("a-4", "e.htm", "", 0)], "accession string, name string, raw string, doc_rank int")
    assert operators.lines(corpus).where("accession = 'a-3'").count() == len(layout.read(IX).lines)
    assert operators.cells(corpus).count() == sum(len(list(g.cells())) for r in (FLAT + ROLL, SALES) for g in grid.grids(r))
    assert operators.figures(corpus, ("srt:ProvedDevelopedReservesVolume",)).count() == 2
    found = operators.reserve_readings(corpus.withColumn("fallback_period", F.lit("2021-12-31")))
    assert found.count() == len(reserves.readings(FLAT + ROLL, "2021-12-31"))
    flat = spark.createDataFrame([("b", "f", FLAT, "2021-12-31")], "accession string, name string, raw string, fallback_period string")
    closed = {r.product: r.closes for r in operators.closes(operators.reserve_readings(flat)).collect()}
    assert closed["oil"] is True and closed["gas"] is None and closed[None] is True
    assert operators.production_readings(corpus).count() == 12
    both = operators.production_readings(corpus).where("concept_key = 'average_sales_price'")
    assert operators.prefer_unhedged(both.withColumn("is_hedged", F.lit(True)).unionByName(both)).where("is_hedged").count() == 0
    facts = spark.createDataFrame([("1", "a-3", "ProvedDevelopedReservesVolume", "2023-12-31", 3_618_000.0, None), ("2", "a-1", None, "2023-12-31", 12345.0, None), ("3", "a-1", None, "2023-12-31", 7.0, None), ("4", "a-1", None, "2023-12-31", 98765.0, None), ("5", "zz", None, "2023-12-31", 98765.0, None)], "id string, accession string, tag string, period_end string, value double, product string")
    verdicts = {r.fact_id: r for r in operators.verify(facts, corpus).collect()}
    assert (verdicts["1"].status, verdicts["1"].method, verdicts["1"].anchor) == ("found", "markup", "#f-1")
    assert (verdicts["2"].status, verdicts["2"].method, verdicts["2"].document) == ("found", "text", "x.htm")
    assert [verdicts[i].status for i in "345"] == ["unverifiable", "not_found", "unavailable"]
    clash = found.unionByName(found.limit(1).withColumn("value", F.col("value") + 1))
    assert operators.one_reading(clash).count() < operators.one_reading(found).count()


def test_table_functions_say_what_the_readers_say(spark, sf_dir):
    corpus = spark.createDataFrame([("a-1", "f.htm", FLAT + ROLL, "2021-12-31"), ("a-2", "p.htm", SALES, None), ("a-3", "i.htm", IX, None), ("a-4", "e.htm", None, None)], "accession string, name string, raw string, fallback_period string")
    functions.register(spark)
    some = corpus.where("raw is not null")
    for call, own in (("document_lines(raw)", operators.lines(some)), ("document_cells(raw)", operators.cells(some)), ("document_figures(raw, null)", operators.figures(some)), ("reserve_readings(raw, fallback_period)", operators.reserve_readings(some)), ("production_readings(raw)", operators.production_readings(some))):
        got = spark.sql(f"SELECT c.accession, c.name, r.* FROM {{c}} c, LATERAL {call} r", c=corpus)
        assert got.columns == own.columns and got.count() > 0
        assert sorted(map(str, got.collect())) == sorted(map(str, own.collect())), call
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").selectExpr("cast(page_id as string) accession", "url name", "html raw")
    got = spark.sql("SELECT c.accession, c.name, r.* FROM {c} c, LATERAL document_lines(raw) r", c=pages)
    assert sorted(map(str, got.collect())) == sorted(map(str, operators.lines(pages).collect()))


def test_tolerance_join_matches_as_one_document_does(spark):
    draw = random.Random(5)
    ix = lambda i, c, shown, scale, name="srt:V": f'<ix:nonFraction name="{name}" contextRef="{c}" unitRef="u" scale="{scale}" id="f{i}">{shown}</ix:nonFraction>'
    context = "".join(f'<context id="{c}"><segment><explicitMember dimension="srt:ProductOrServiceAxis">srt:{m}</explicitMember></segment><period><instant>{p}</instant></period></context>' for c, m, p in (("a", "OilMember", "2023-12-31"), ("b", "NaturalGasMember", "2023-12-31"), ("c", "X", "2022-12-31")))
    shown = ["1,234", "12.5", ".5", "0", "9.999", "1,235", "10", "-7", "12.49", "1 234", "1e3"]
    docs = [("d1", "m.htm", context + "".join(ix(i, draw.choice("abc"), draw.choice(shown), draw.choice([0, 3, 6, -2])) for i in range(60))), ("d1", "n.htm", context + ix(0, "a", "1,234", 3)), ("d2", "o.htm", context + ix(0, "a", "12.5", 0, "srt:W"))]
    corpus = spark.createDataFrame(docs, "accession string, name string, raw string")
    values = [1234.0, 1233.6, 1233.5, 1234.51, 12.5, 12.45, 12.55, 0.5, 0.0, 0.4, 9.9985, 9.9995, 12_345.0, 1_234_400.0, 1_234_500.1, 10_500.0, -7.0, -7.4, 12.49e6, 1234e6 * 1.0004, 1e3, 1000.4, 0.05]
    facts = [(f"{n}", d, draw.choice(["V", "V", "W", None]), draw.choice(["2023-12-31", "2022-12-31"]), v, draw.choice(["oil", "gas", None])) for n, (d, v) in enumerate([(d, v) for d in ("d1", "d2", "d3") for v in values] * 3)]
    got = {(r.fact_id, r.name): (r.shown, r.value, r.element_id, r.start) for r in operators.match_figures(spark.createDataFrame(facts, "id string, accession string, tag string, period_end string, value double, product string"), operators.figures(corpus)).collect()}
    want = {}
    for accession, name, raw in docs:
        for i, a, tag, period, value, product in facts:
            if a == accession and (f := markup.match(markup.figures(raw), tag, period, value, product)):
                want[i, name] = (f.shown, f.value, f.element_id, f.start)
    assert got == want and len(want) > 30


def test_facts_that_no_report_prints(spark, tmp_path):
    """The report of the first supplier prints 7,654 as its total: no fact that is meant to be missing may be found there."""
    from factloom.catalogue_filed import QUERIES

    spark.createDataFrame([(7, "A", 0, 2827.0), (8, "B", 1, 10.5)], "s_suppkey long, s_name string, s_nationkey int, s_acctbal double").write.parquet(f"{tmp_path}/supplier.parquet")
    found = {r.fact_id: (r.status, r.printed) for r in QUERIES["verify_facts"](spark, str(tmp_path)).collect()}
    assert found["t7"] == ("found", "7,654") and found["n7"] == found["n8"] == ("not_found", None)


def test_reports_are_dealt_over_tasks(spark, tmp_path):
    """2,000 suppliers in one small file are read as reports by several tasks, about evenly."""
    from factloom import catalogue_filed

    spark.range(2000).select(F.col("id").alias("s_suppkey"), F.lit("A").alias("s_name"), F.lit(0).alias("s_nationkey"), F.lit(5.0).alias("s_acctbal")).coalesce(1).write.parquet(f"{tmp_path}/supplier.parquet")
    dealt = [r["count"] for r in catalogue_filed._reports(spark, str(tmp_path)).groupBy(F.spark_partition_id()).count().collect()]
    assert sum(dealt) == 2000 and len(dealt) == 8 and max(dealt) < 400


def test_documents_are_verified_by_several_tasks(spark):
    """1,000 short documents in one partition are verified by four tasks, and every fact has its verdict."""
    corpus = spark.range(1000).select(F.concat(F.lit("a"), "id").alias("accession"), F.lit("d.htm").alias("name"), F.concat(F.lit("<p>Total 1,23"), F.col("id") % 10, F.lit("</p>")).alias("raw"), F.lit(0).alias("doc_rank")).coalesce(1)
    facts = corpus.select(F.col("accession").alias("id"), "accession", F.lit(None).cast("string").alias("tag"), F.lit("2023-12-31").alias("period_end"), F.lit(1234.0).alias("value"), F.lit(None).cast("string").alias("product"))
    found = operators.verify(facts, corpus)
    assert {r.status: r["count"] for r in found.groupBy("status").count().collect()} == {"found": 100, "not_found": 900}
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("hashpartitioning(accession") >= 2 and "REPARTITION_BY_NUM" in plan


def test_documents_are_read_once_for_figures_and_prices(spark, sf_dir):
    """What Python read of them is kept where a query uses it twice."""
    from factloom.catalogue_filed import QUERIES

    for name in ("matched_figures", "prefer_unhedged"):
        assert "MapInPandas" not in QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString(), name
