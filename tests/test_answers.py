from __future__ import annotations

from factloom.functions.text import phrases_count
from factloom.operators import succession
from factloom.plans import answers


def test_memo_follows_the_store():
    now, version, calls = [0.0], [1], []
    memo = answers.Answers(lambda: version[0], fresh=2.0, clock=lambda: now[0])

    def compute():
        calls.append(1)
        return len(calls)

    assert memo.get("a", compute) == 1 and memo.get("a", compute) == 1
    version[0] = 2
    assert memo.get("a", compute) == 1  # not looked at yet
    now[0] = 3.0
    assert memo.get("a", compute) == 2

    def moves():
        version[0] += 1
        return "old"

    assert memo.get("b", moves) == "old"
    assert memo.get("b", compute) == 3  # what was computed over a moving store is not kept
    memo.warm({"c": compute}).join(5)
    assert memo.get("c", lambda: None) == 4


def test_store_version(spark, tmp_path):
    (tmp_path / "fact").mkdir()
    a = answers.store_version(spark, str(tmp_path))
    (tmp_path / "filing").mkdir()
    assert answers.store_version(spark, str(tmp_path)) != a and answers.store_version(spark, str(tmp_path / "no")) == ()


def test_successions(spark):
    filings = spark.createDataFrame([("1", "8-K12B", "a", "2024", 0), ("2", "10-K", "b", "2024", 0), ("3", "8-K12B", "c", "2024", 0), ("4", "8-K12B", "d", "2024", 0), ("5", "8-K12B", "e", "2024", 0)], "cik string, form string, accession string, filed_date string, ordinal int")
    notices = spark.createDataFrame([("a", "<p>On May 1, 2024, Old Petro Corp, a Delaware corporation and the predecessor registrant, merged</p>"), ("c", "as successor issuer to the Lost Oil Company under Rule 12g-3"), ("d", "nothing"), ("e", "the predecessor registrant, Twin Energy, and more")], "accession string, html string")
    filers = spark.createDataFrame([("9", "OLD PETRO CORP"), ("7", "Twin Energy Inc"), ("8", "Twin Energy")], "cik string, name string")
    got = {r.cik: (r.status, r.predecessor_cik, r.predecessor_name) for r in succession.successions(filings, notices, filers).collect()}
    assert got["1"] == ("resolved", "9", "Old Petro Corp") and got["2"][0] == "none"
    assert got["3"] == ("unconfirmed", None, "Lost Oil Company") and got["4"] == ("unconfirmed", None, None) and got["5"][:2] == ("unconfirmed", None)
    company = spark.createDataFrame([("1",), ("2",)], "cik string")
    history = succession.follow(company, succession.successions(filings, notices, filers))
    assert {tuple(r) for r in history.select("cik", "history_cik").collect()} == {("1", "9"), ("2", "2")}
    assert succession.needing_history(company, spark.createDataFrame([("2",)], "cik string")).count() == 1


def test_reports(spark):
    cover = spark.createDataFrame([("a", True, "2024"), ("a", True, "2019"), ("a", False, None)], "concept_key string, tagged boolean, latest_period string")
    assert answers.coverage_totals(cover, "2023").first()[:] == ("a", 2, 1)
    assert [tuple(r) for r in answers.outcomes(cover, "tagged").collect()] == [(True, 2), (False, 1)]
    fact = spark.createDataFrame([("1", "proved_reserves_boe"), ("1", "capex")], "cik string, concept_key string")
    docs = spark.createDataFrame([("2", "x", "proved reserves proved reserves"), ("2", "y", "no")], "cik string, name string, text string")
    found = {r.cik: r for r in answers.producer_evidence(fact, docs, ("proved_reserves_boe",), phrases_count).collect()}
    assert found["1"].concepts == ["proved_reserves_boe"] and found["1"].hits is None and (found["2"].hits, found["2"].best) == (2, "x")
