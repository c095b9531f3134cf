from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from factloom import registry
from factloom.functions import names, text, units
from factloom.operators import identity, scale, validation
from factloom.registry import DEVELOPED, TOTAL, UNDEVELOPED
from factloom.sources import corpus, payloads


def obs(end, val, form="10-K", accn="a", filed="2024-02-20", **more):
    return {"end": end, "val": val, "form": form, "accn": accn, "filed": filed, "fy": 2023, "fp": "FY"} | more


PAYLOAD = {
    "cik": "320193", "entityName": "X",
    "facts": {
        "srt": {"ProvedDevelopedReservesVolume": {"units": {"MBoe": [obs("2021-12-31", 10), obs("2022-12-31", None), obs("2022-06-30", 5, form="10-Q")]}}},
        "us-gaap": {
            "ProvedDevelopedReservesVolume": {"units": {"MBoe": [obs("2023-12-31", 30, start=None)], "MMcfe": [obs("2023-12-31", 180)]}},
            "ProvedDevelopedReservesBOE": {"units": {"MBoe": [obs("2020-12-31", 99)]}},
            "AverageSalesPrices": {"units": {"USD/Mcf": [obs("2023-12-31", 3.5, start="2023-01-01")]}},
        },
    },
}


@pytest.fixture(scope="module")
def flat(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("payloads")
    (folder / "one.json").write_text(json.dumps(PAYLOAD))
    return payloads.observations(payloads.read_payloads(spark, str(folder))).drop("observed").cache()


def test_flatten(flat):
    rows = payloads.in_order(payloads.fact_rows(flat)).collect()
    developed = [r for r in rows if r.concept_key == DEVELOPED]
    assert sorted((r.taxonomy, r.period_end, r.value, r.unit_rank) for r in developed) == [("srt", "2021-12-31", 10, 1), ("us-gaap", "2023-12-31", 30, 1), ("us-gaap", "2023-12-31", 180, 7)]
    assert [r.product for r in rows if r.concept_key == "average_sales_price"] == ["gas"] and {r.cik for r in rows} == {"0000320193"}
    assert payloads.fact_rows(flat, forms=None).where("concept_key like 'proved%'").count() == 4
    other = flat.sparkSession.createDataFrame([("0000320193", DEVELOPED, "ProvedDevelopedReservesBOE")], "cik string, concept_key string, tag string")
    assert [r.value for r in payloads.fact_rows(flat, overrides=other).where(F.col("concept_key") == DEVELOPED).collect()] == [99]
    preferred = flat.sparkSession.createDataFrame([("0000320193", DEVELOPED, "MMcfe")], "cik string, concept_key string, unit string")
    assert payloads.fact_rows(flat, preferred=preferred).where("unit = 'MMcfe'").first().unit_rank == -1
    grid = payloads.coverage(flat, flat.select("cik"), payloads.DEFAULT_FORMS).collect()
    assert len(grid) == 9 and {r.concept_key for r in grid if r.tagged} == {DEVELOPED, "average_sales_price"}


def test_unknown_fields_survive_and_bad_texts_are_rows(spark, tmp_path):
    body = {"cik": 7, "more": {"a": [1]}, "facts": {"x": {"Odd": {"label": "L", "units": {"u": [obs("2023-12-31", 1.5, note="n", deep={"k": [2]}), "text", None]}}, "Bare": {}, "None": None}}}
    for name, text in {"good": json.dumps(body), "cut": json.dumps(body)[:40], "list": "[1]", "empty": " ", "twice": '{"cik": 1, "cik": 2}'}.items():
        (tmp_path / f"{name}.json").write_text(text)
    raw = payloads.read_payloads(spark, str(tmp_path))
    assert {r.source.rsplit("/", 1)[1]: r.error for r in raw.collect()} == {"good.json": None, "cut.json": payloads.MALFORMED, "list.json": payloads.NO_OBJECT, "empty.json": payloads.NO_TEXT, "twice.json": payloads.MALFORMED}
    assert {r.error: r.n for r in payloads.failures(raw).collect()} == {payloads.MALFORMED: 2, payloads.NO_OBJECT: 1, payloads.NO_TEXT: 1}
    rows = payloads.observations(raw).select("cik", "tag", "ordinal", "val", payloads.field("observed", "$.note", "string").alias("note"), payloads.field("observed", "$.deep.k[0]", "int").alias("deep")).collect()
    assert sorted(map(tuple, rows), key=str) == sorted([("0000000007", "Odd", 0, 1.5, "n", 2), ("0000000007", "Odd", 1, None, None, None), ("0000000007", "Odd", 2, None, None, None), ("0000000007", "Bare", None, None, None, None), ("0000000007", "None", None, None, None, None)], key=str)
    assert raw.select(payloads.field("payload", "$.more.a[0]", "int").alias("a")).where("a = 1").count() == 1


def values(spark, rows):
    return spark.createDataFrame([("c", k, t, "MBoe", p, v, o) for k, t, o, p, v in rows], "cik string, concept_key string, tag string, unit string, period_end string, value double, alias_ord int")


@pytest.mark.parametrize(
    ("series", "status", "coherent"),
    [(((700, 300, 1000),), "validated", 1), (((960, 1825, 865),), "incoherent", 0), (((500, 500, 1000), (700, 300, 1000), (960, 1825, 865)), "drifted", 2), (((700, None, 1000),), "insufficient", None), (((7, 3, 0),), "insufficient", None)],
)
def test_validation(spark, series, status, coherent):
    rows = [(k, k[:9], 0, f"{2020 + i}-12-31", float(v)) for i, three in enumerate(series) for k, v in zip((DEVELOPED, UNDEVELOPED, TOTAL), three, strict=True) if v is not None]
    frame = values(spark, rows)
    verdict = validation.validate_family(frame, spark.createDataFrame([("c",)], "cik string")).first()
    assert verdict.status == status and verdict.coherent_periods == coherent
    if status == "drifted":
        bad = validation.rejected_periods(validation.tag_triples(frame), validation.validate_family(frame, frame.select("cik")))
        assert {r.period_end for r in bad.collect()} == {"2022-12-31"} and bad.count() == 3
        assert validation.drop_incoherent(frame, bad).count() == 6


def test_first_combination_wins_ties(spark):
    rows = [(DEVELOPED, "a", 0, "2023-12-31", 7.0), (DEVELOPED, "b", 1, "2023-12-31", 7.0), (UNDEVELOPED, "u", 0, "2023-12-31", 3.0), (TOTAL, "t", 0, "2023-12-31", 10.0)]
    assert validation.validate_family(values(spark, rows), values(spark, rows)).first().d_tag == "a"
    later = spark.createDataFrame([("c", TOTAL, "t", "MBoe", "2023-12-31", f, o, v, 0) for f, o, v in (("2024", 0, 1.0), ("2024", 1, 2.0), ("2023", 2, 3.0))], "cik string, concept_key string, tag string, unit string, period_end string, filed string, ordinal int, value double, alias_ord int")
    assert validation.candidate_values(later).first().value == 2.0


@pytest.mark.parametrize(
    ("value", "unit", "found", "measure", "header", "status", "divisor", "read"),
    [
        (3_617_856_000, "MBoe", 1e3, 36.91e9, [], "resolved", 1e3, "MBoe"), (9_662_144_000, "Mcfe", 1e3, 5_066_306_000, [], "resolved", 1, "Mcfe"), (1e6, "MBoe", 1e3, None, [], "unavailable", None, None),
        (1, "MBoe", 1e3, 1e15, [], "ambiguous", None, None), (4_253_000_000, "bbl", 1e6, 3_403_000_000, ["Bcfe"], "resolved", 1e6, "Bcfe"), (423_300_000_000, "ft3", 1e9, 651_300_000, ["MMBoe"], "resolved", 1, "ft3"),
        (3_617_856_000, "MBoe", 1e3, 36.91e9, ["Bcf", "MMBbls", "Tcf"], "resolved", 1e3, "MBoe"), (5, "acres", None, 1e9, [], "unavailable", None, None),
    ],
)
def test_scale(spark, value, unit, found, measure, header, status, divisor, read):
    rows = spark.createDataFrame([("x", float(value), unit, found, header, None, measure and float(measure))], "id string, value double, unit string, scale double, header_units array<string>, declared_scale int, measure double")
    got = scale.resolve(rows).first()
    assert (got.status, got.divisor, got.reading_unit) == (status, divisor, read)


def test_periods_share_the_anchor(spark):
    schema = "id string, cik string, period_end string, concept_key string, product_key string, value double, unit string, scale double, header_units array<string>, declared_scale int, measure double"
    base = ("c", "2023-12-31")
    rows = [("1", *base, TOTAL, "", 3_617_856_000.0, "MBoe", 1e3, [], None, 36.91e9), ("2", *base, DEVELOPED, "", 2_500_000_000.0, "MBoe", 1.0, [], None, 36.91e9), ("3", *base, TOTAL, "oil", 9_000_000_000.0, "MBoe", 1.0, [], None, 36.91e9), ("4", "d", "2023-12-31", TOTAL, "", 1.0, "MBoe", 1e3, [], None, 1e15)]
    got = {r.id: (r.divisor, r.canonical_value) for r in scale.resolve_periods(spark.createDataFrame(rows, schema)).collect()}
    assert got == {"1": (1e3, 3_617_856_000.0), "2": (1e3, 2_500_000_000.0)}


def test_identity(spark):
    one = spark.range(1)
    pick = lambda *t: one.select(identity.primary_ticker(F.array(*map(F.lit, t))).alias("t")).first().t
    assert pick("OXY-WT", "OXY") == "OXY" and pick("ANNAW", "ANNA") == "ANNA" and pick("ABC-WT") == "ABC-WT" and pick("BBB", "AAA", "AAAA") == "AAA"
    foreign = lambda *a: tuple(one.select(*identity.domicile(*map(F.lit, a))).first())
    assert foreign("TX", "TX", "DE", "DE") == (False, "USA") and foreign("A0", "Alberta, Canada", None, None) == (True, "Canada") and foreign(None, None, "DC", "DC") == (False, None) and foreign(None, None, "X0", "Norway") == (True, "Norway")
    assert one.select(identity.reporting_taxonomy(F.lit(5), F.lit(5)), identity.reporting_taxonomy(F.lit(0), F.lit(0)), identity.reporting_taxonomy(F.lit(1), F.lit(4))).first()[:] == ("us-gaap", "unknown", "ifrs-full")
    forms = spark.createDataFrame([("c", "40-F", 0), ("c", "20-F/A", 1), ("c", "20-F", 2), ("c", "40-F/A", 3), ("c", "8-K", 4)], "cik string, form string, ordinal int")
    assert tuple(identity.annual_form(forms).first()) == ("c", "40-F", "ni-51-101")


def test_issuers(spark, tmp_path):
    spark.sparkContext.setCheckpointDir(str(tmp_path))
    rows = [("1", "Old Oil Corp", ["A"], ["Ancient Oil"], "2020-01-01", 3), ("2", "Ancient Oil, Inc.", [], [], "2023-01-01", 1), ("3", "Other", ["A", None], None, None, 0), ("4", "Same Name LLC", [], [], None, 0), ("5", "Same Name", [], [], None, 0)]
    df = spark.createDataFrame(rows, "cik string, name string, tickers array<string>, former_names array<string>, latest_annual string, annual_count int")
    got = {r.cik: (r.issuer, r.is_primary) for r in identity.issuer_groups(df, lambda x: x.checkpoint()).collect()}
    assert got == {"1": ("1", False), "2": ("1", True), "3": ("1", False), "4": ("4", True), "5": ("5", True)}


def test_submissions(spark, tmp_path):
    doc = {"cik": "12", "name": "N", "tickers": ["T"], "exchanges": [None, "NYSE"], "sic": "1311", "addresses": {"business": {"stateOrCountry": "TX", "stateOrCountryDescription": "TX"}}, "formerNames": [{"name": "M"}],
           "filings": {"recent": {"form": ["8-K", "10-K", "10-K/A", "10-KT"], "filingDate": ["2024-03-01", "2023-02-01", "2024-02-01", "2024-09-01"], "accessionNumber": ["a", "b", "c"], "primaryDocument": ["x"]}}}
    (tmp_path / "s.json").write_text(json.dumps(doc))
    raw = payloads.read_payloads(spark, str(tmp_path))
    r = payloads.profiles(raw).first()
    assert (r.cik, r.exchanges, r.annual_count, r.latest_annual, r.annual_form, r.eightk_count, r.is_foreign) == ("0000000012", ["NYSE"], 2, "2024-02-01", "10-K", 1, False)
    assert payloads.filings(raw).count() == 4
    (tmp_path / "t").mkdir()
    (tmp_path / "t/t.json").write_text(json.dumps({"1": {"cik_str": 12, "ticker": "B", "title": "x"}, "0": {"cik_str": 12, "ticker": "A", "title": "x"}, "2": {"cik_str": 12, "ticker": "B", "title": "x"}}))
    assert payloads.ticker_map(payloads.read_payloads(spark, str(tmp_path / "t"))).first().tickers == ["A", "B"]
    (tmp_path / "ciks.txt").write_text("# head\n12, x\n\nCIK0000000013 # y\n12\n")
    assert {r.cik for r in payloads.cik_list(spark, str(tmp_path / "ciks.txt")).collect()} == {"0000000012", "0000000013"}


def test_scalars(spark):
    one = spark.range(1)
    get = lambda *c: one.select(*c).first()
    assert get(names.cik_padded(F.lit("CIK320193")))[0] == "0000320193"
    with pytest.raises(Exception):
        one.select(names.cik_padded(F.lit("x1"))).collect()
    assert get(names.document_url(F.lit("0000000007"), F.lit("1-2-3"), F.lit("d.htm")))[0].endswith("/7/123/d.htm") and get(names.document_url(F.lit("7"), F.lit("1"), F.lit("")))[0] is None
    assert get(names.company_name(F.lit("The New Oil-Co., Inc.")))[0] == "oil"
    assert get(units.half_last_place(F.lit("2.5"), F.lit(9)), units.half_last_place(F.lit("n/a"), F.lit(0)))[:] == (5e7, None)
    assert get(units.normalise(F.lit(6000.0), F.lit("Mcf"), F.lit(0.0)), units.normalise(F.lit(1.0), F.lit("USD/bbl"), F.lit(1.0)))[:] == (1000.0, None)
    assert get(text.phrases_count(F.lit("Proved reserves and PROVED RESERVES; reserve life")))[0] == 3
    assert get(text.searchable(F.lit(12.0)), text.searchable(F.lit(123.0)), text.searchable(F.lit(0.12)))[:] == (False, True, False)
    with pytest.raises(KeyError):
        registry.concept("nope")
    html = "<tr><td>1</td><td>Annual</td><td>a.htm x</td><td>10-K</td><td>1,200</td></tr><tr><td>short</td></tr>"
    assert [tuple(r) for r in get(corpus.index_items(F.lit(html)))[0]] == [("Annual", "a.htm", "10-K", 1200)]
    assert get(corpus.sheet(F.lit("a<hr>b<HR x>c"), F.lit(2)), corpus.sheet(F.lit("a"), F.lit(2)))[:] == ("b", None)
