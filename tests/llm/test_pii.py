from __future__ import annotations

import math
import random
import re
import time
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from factloom.llm import pii


def brute(text):
    """The contract's patterns as written."""
    out = [(m.start(), m.end(), "email") for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [(m.start(), m.end(), "ip") for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(x) <= 255 for x in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = [int(c) for c in m[0] if c.isdigit()]
        total = sum(d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(reversed(digits)))
        if 16 <= len(digits) <= 19 and total % 10 == 0:
            out.append((m.start(), m.end(), "card"))
    out += [(m.start(), m.end(), "phone") for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 8 <= sum(c.isdigit() for c in m[0]) <= 15]
    return out


def test_base_spans_match_the_patterns():
    rng = random.Random(3)
    parts = ["a", "b.c", "@", ".", "x-y", "12", "255", "1.2.3.4", "4242424242424242", "4242 4242 4242 4242", "+1 (499) 555-6503", "+", " ", "-", "(", ")", "@d.e", "é", "%", "0"]
    for _ in range(6000):
        text = "".join(rng.choices(parts, k=rng.randint(0, 14)))
        assert pii.base_spans(text) == brute(text), text


def test_long_runs_are_cheap():
    assert pii.base_spans("a" * 300_000) == []
    assert pii.base_spans("1" * 300_000) == []
    assert len(pii.base_spans("@" * 1000 + "x@y.zz")) == 1


def name(kind, value):
    return f"{kind}:" + (value.lower() if kind in ("email", "ip") else "".join(c for c in value if c in "0123456789"))


def plain_neighbours(text, spans):
    """Every word against every span."""
    words = [m for m in re.finditer(r"[^\W\d_]+", text) if not any(m.start() < e and s < m.end() for s, e, _ in spans)]
    out = []
    for s, e, kind in spans:
        near = [m for m in words if m.end() <= s][-8:] + [m for m in words if m.start() >= e][:8]
        out += [(name(kind, text[s:e]), m[0], m.start(), m.end()) for m in near]
    return out


def test_neighbours_match_a_plain_search():
    rng = random.Random(8)
    parts = ["word", "Langeswort" * 30, "İstanbul", "née", "of", "a.b@c.de", "1.2.3.4", "+1 499 555 6503", "4242424242424242", " ", " ", ", ", "\n", "x@y.zz-1.2.3.4", "7"]
    for _ in range(800):
        text = "".join(rng.choices(parts, k=rng.randint(0, 40)))
        assert sorted(pii.neighbours(text, pii.base_spans(text))) == sorted(plain_neighbours(text, brute(text))), text


def test_many_spans_are_cheap():
    text = "some words between names " * 3 + " ".join(f"person number{i} wrote u{i}@example.org today" for i in range(100_000))
    start = time.perf_counter()
    spans = pii.base_spans(text)
    assert len(spans) == 100_000 and len(pii.neighbours(text, spans)) > 1_000_000
    assert time.perf_counter() - start < 20


def by_hand(texts, threshold, support):
    """Disclosing (entity, term) pairs by plain counting."""
    n, n_e, n_t, n_et = len(texts), Counter(), Counter(), Counter()
    for t in texts:
        t = t or ""
        n_t.update({w.lower() for w in re.findall(r"[^\W\d_]+", t)})
        near = plain_neighbours(t, brute(t))
        n_et.update({(e, w.lower()) for e, w, _, _ in near})
        n_e.update({name(k, t[s:e]) for s, e, k in brute(t)})
    out = defaultdict(float)
    for (e, w), k in n_et.items():
        if k >= support and n_e[e] < n:
            r = (math.log(n / n_e[e]) + math.log(k / (max(n_t[w], k) + 0.5))) / math.log(n / n_e[e])
            if r >= threshold:
                out[e, w] = r
    return out


def test_terms_that_disclose(spark):
    common = ["the report says something about their market today", "other people write about markets and reports"]
    secret = "our tenant Quillfeather wrote from quill@example.org about the report today"
    texts = [secret] * 4 + common * 20 + [None, "", "call +1 499 555 6503 today"]
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, spans string")
    rows = {r.doc_id: r for r in pii.sanitise(docs, with_text=True).collect()}
    assert len(rows) == len(texts)
    want = by_hand(texts, pii.DISCLOSURE, 1)
    assert ("email:quill@example.org", "quillfeather") in want
    found = {secret[int(s):int(e)].lower() for k, s, e in (x.split(":") for x in rows[0].spans.split(",")) if k == "term"}
    assert found == {w for e, w in want if e.startswith("email")}
    assert "today" not in found and "report" not in found
    assert "Quillfeather" not in rows[0].sanitised and "[EMAIL]" in rows[0].sanitised and "today" in rows[0].sanitised
    assert rows[4].spans == "" and rows[4].sanitised == common[0]
    assert rows[len(texts) - 3].sanitised is None and rows[len(texts) - 1].n_phone == 1


def test_cases(spark):
    docs = spark.createDataFrame([(None, "a@b.cc"), (1, "a@b.cc"), (1, "a@b.cc"), (2, None)], "doc_id long, text string")
    rows = pii.sanitise(docs).collect()
    assert sorted(r.n_email for r in rows) == [0, 1, 1, 1]
    assert pii.sanitise(docs.limit(0)).count() == 0
    assert abs(pii.ratio(100, 4, 4, 4) - (1 - math.log(4.5 / 4) / math.log(25))) < 1e-12
    assert pii.ratio(50, 1, 1, 1) < pii.ratio(5000, 1, 1, 1) < pii.REMOVAL  # one meeting is never enough to remove


def test_short_names_and_unspaced_scripts(spark):
    texts = ["mail li.w@example.org to Li W today", "write 王小明 a@example.com 至", *["mail to a today 至"] * 60]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r.doc_id: r for r in pii.sanitise(docs, with_text=True).collect()}
    terms = lambda i: {texts[i][int(s) : int(e)] for k, s, e in (x.split(":") for x in rows[i].spans.split(",")) if k == "term"}
    assert terms(0) == {"Li", "W"} and terms(1) == {"write", "王", "小", "明"}
    assert all(rows[i].n_terms == 0 for i in range(2, len(texts)))


def test_leading_zeros_of_an_address():
    long = "0" * 400 + "1.2.3.4"
    assert pii.base_spans(long) == [(0, len(long), "ip")] == brute(long)
    assert pii.base_spans("000.0.0.0256") == [] and pii.base_spans("1.2.3." + "9" * 5000) == []


def test_pairs_of_one_document_take_part(spark):
    secret = "our tenant Quillfeather wrote from quill@example.org about the report today"
    texts = [secret, *["people wrote about our tenant and the report today from home"] * 40]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r.doc_id: r for r in pii.sanitise(docs, with_text=True).collect()}
    found = {secret[int(s):int(e)].lower() for k, s, e in (x.split(":") for x in rows[0].spans.split(",")) if k == "term"}
    assert found == {w for _, w in by_hand(texts, pii.DISCLOSURE, 1)} == {"quillfeather"}
    assert rows[0].n_terms == 1 and "Quillfeather" not in rows[0].sanitised
    assert all(rows[i].n_terms == 0 for i in range(1, len(texts)))


def test_long_words_capitals_and_support(spark):
    long = ["Extraordinarilylongwordnumber" + c * 30 for c in "abcdefgh"]
    texts = [f"Z@example.org {' '.join(long)} İzmirlilerden"] * 2 + ["other people wrote something else"] * 30 + ["z@example.org"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("base", F.lit("x"))
    rows = {r.doc_id: r for r in pii.sanitise(docs).collect()}
    assert len(by_hand(texts, pii.DISCLOSURE, 1)) == 8  # the ninth word is beyond the window
    assert rows[0].n_terms == rows[1].n_terms == 8 and rows[2].n_terms == rows[32].n_terms == 0
    rows = {r.doc_id: r for r in pii.sanitise(docs, support=3).collect()}
    assert rows[0].n_terms == 0
    near = pii.sanitise(spark.createDataFrame([(0, "z@example.org İzmirlilerden"), *[(i, "nothing else here") for i in range(1, 30)]], "doc_id long, text string"))
    assert near.agg(F.sum("n_terms")).first()[0] == 1
