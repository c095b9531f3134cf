from __future__ import annotations

import random
import re
import time

import pytest
from pyspark.sql import functions as F

from factloom.llm import decontaminate as dc


def words(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))


def brute(text, items):
    doc, hit, found = words(text), set(), set()
    for item, t in items:
        w = words(t)
        n = min(10, len(w))
        for k in range(len(w) - n + 1 if w else 0):
            for at in range(len(doc) - n + 1):
                if doc[at : at + n] == w[k : k + n]:
                    hit |= set(range(at, at + n))
                    found.add(str(item))
    return len(doc), len(hit), sorted(found)


@pytest.fixture(scope="module")
def tables(spark):
    rng = random.Random(8)
    vocab = ["Alpha", "beta", "Éa", "éa", "x1", "gamma", "ñu", "delta"]
    line = lambda n: " ".join(rng.choices(vocab, k=n))
    items = [(i, line(rng.randint(10, 25))) for i in range(12)] + [(20, "short, Item"), (21, "Éa-éa x1"), (22, None), (23, "..."), (24, line(10)), (25, "beta")]
    texts = [line(rng.randint(0, 80)) for _ in range(40)] + [None, "", "--", items[0][1].upper(), f"{line(30)}. {items[3][1]}!{line(20)}", items[5][1] + " " + items[5][1]]
    texts += ["unrelated stuff " * 3000 + items[7][1]]
    rows = [(i, t, "k") for i, t in enumerate(texts)]
    return rows, items, spark.createDataFrame(rows, "doc_id long, text string, words string"), spark.createDataFrame(items, "item_id long, text string")


@pytest.mark.parametrize("limit", [2_000_000, 40])
def test_hits_match_a_plain_search(tables, monkeypatch, limit):
    monkeypatch.setattr(dc, "SET_GRAMS", limit)
    rows, items, docs, bench = tables
    got = {r.doc_id: r for r in dc.contamination(docs, bench).collect()}
    assert len(got) == len(rows)
    for i, t, _ in rows:
        if t and len(t) > 20_000:
            t, extra = t[-2000:], len(words(t)) - len(words(t[-2000:]))
        else:
            extra = 0
        n, hit, found = brute(t, items)
        assert (got[i].n_words, got[i].n_hit, got[i].items) == (n + extra, hit, found), i


def test_cases(spark, tables):
    rows, items, docs, bench = tables
    twice = docs.unionByName(docs.withColumn("doc_id", F.lit(None).cast("long")))
    assert dc.contamination(twice, bench).count() == 2 * len(rows)
    assert dc.contamination(docs.unionByName(docs), bench).count() == 2 * len(rows)
    assert dc.contamination(docs, bench.limit(0)).where("n_hit > 0").count() == 0
    assert dc.contamination(docs.limit(0), bench).count() == 0


@pytest.mark.parametrize("limit", [2_000_000, 40])
def test_removal(tables, monkeypatch, limit):
    monkeypatch.setattr(dc, "SET_GRAMS", limit)
    rows, items, docs, bench = tables
    flags = {i: brute(t if not t or len(t) < 20_000 else t[-2000:], items)[1] for i, t, _ in rows}
    kept = dc.remove_documents(docs, bench)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i, n in flags.items() if not n)
    cut = {r.doc_id: r.text for r in dc.remove_spans(docs, bench).collect()}
    for i, t, _ in rows:
        if not flags[i]:
            assert cut[i] == t
        else:
            assert len(words(cut[i])) == len(words(t)) - flags[i]


def test_native(tables):
    rows, items, docs, bench = tables
    plan = dc.contamination(docs, bench)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
    plan = dc.remove_documents(docs, bench)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|hashpartitioning", plan)
    assert "BroadcastHashJoin" in plan


def test_results_beyond_the_broadcast(tables, monkeypatch):
    rows, items, docs, bench = tables
    want = sorted(map(str, dc.contamination(docs, bench).collect()))
    left = sorted(r.doc_id for r in dc.remove_documents(docs, bench).collect())
    monkeypatch.setattr(dc, "BROADCAST_HITS", 0)
    assert sorted(map(str, dc.contamination(docs, bench).collect())) == want
    assert sorted(r.doc_id for r in dc.remove_documents(docs, bench).collect()) == left


@pytest.mark.parametrize("n", [0, 100_001, 1_000_000])
def test_sizes_of_the_benchmark(spark, n):
    """One item of n + 9 words, or none; documents hold its last window, all but a word of it, or copies in many rows."""
    text = F.array_join(F.transform(F.sequence(F.lit(1), F.lit(n + 9)), lambda i: F.concat(F.lit("w"), i.cast("string"))), " ")
    bench = spark.range(1 if n else 0).select(F.col("id").alias("item_id"), text.alias("text"))
    last = " ".join(f"W{i}" for i in range(n, n + 10))
    rows = [(1, f"Before, {last}"), (2, last[:-2]), (3, None), *[(i, f"{last}. {last}") for i in range(10, 40)]]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("k1", F.col("doc_id")).withColumn("hits", F.lit("x"))
    got = {r.doc_id: (r.n_hit, r.items) for r in dc.contamination(docs, bench).collect()}
    assert got == {i: ((10 if i == 1 else 20, ["0"]) if n and i not in (2, 3) else (0, [])) for i, _ in rows}
    assert dc.remove_documents(docs, bench).count() == (2 if n else len(rows))
    cut = {r.doc_id: r.text for r in dc.remove_spans(docs, bench).collect()}
    assert cut[1].strip() == ("Before," if n else rows[0][1])


@pytest.mark.parametrize("limit", [2_000_000, 40])
def test_items_with_a_null_id_count(spark, tables, monkeypatch, limit):
    monkeypatch.setattr(dc, "SET_GRAMS", limit)
    rows, items, docs, _ = tables
    docs = docs.where("length(text) < 20000 or text is null")
    known, unknown = items[:3], [(None, t) for _, t in items[3:12]]
    bench = spark.createDataFrame(known + unknown, "item_id long, text string")
    got = {r.doc_id: r for r in dc.contamination(docs, bench).collect()}
    flagged = set()
    for i, t, _ in rows:
        if i in got:
            assert (got[i].n_hit, got[i].items) == (brute(t, known + unknown)[1], brute(t, known)[2]), i
            flagged |= {i} if got[i].n_hit else set()
    assert any(not got[i].items for i in flagged)
    assert {r.doc_id for r in dc.remove_documents(docs, bench).collect()} == got.keys() - flagged


def test_time_is_linear_in_the_length_of_a_text(spark, tables):
    """Four times the words take at most three times as long; by a square it would be sixteen."""
    _, items, _, bench = tables

    def seconds(n: int) -> float:
        text = " ".join(f"w{i % 977}" for i in range(n)) + " " + items[7][1]
        docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
        start = time.perf_counter()
        r = dc.contamination(docs, bench).first()
        assert (r.n_words, r.n_hit) == (n + len(words(items[7][1])), len(words(items[7][1])))
        return time.perf_counter() - start

    seconds(1000)
    assert seconds(640_000) < 3 * max(seconds(160_000), 2.0)
