"""Personal data: base patterns, and terms of their neighbourhood that disclose them by corpus co-occurrence.

Every distinct value that the base patterns find is a protected entity e. Terms t near its occurrences are candidates:
the WINDOW words on either side that touch no base span, whatever their length or distance. A word is a run of letters;
in scripts that part no words by spaces each letter is one. From document counts over the whole corpus, PMI(e; t) =
log(p(e, t) / (p(e) p(t))) says how much t reveals of e, and IC(e) = -log p(e) is all there is to reveal. Half a document
that holds the term elsewhere is added to its count (Jeffreys' estimate): a term that was met once with a value and never
without it may be so by chance, and the fewer its meetings and the smaller the corpus, the less it counts. Where PMI / IC
reaches the disclosure threshold the term is sanitised: removed when it reveals (nearly) everything, which takes many
meetings, generalised to a mark otherwise. Pairs of a single document take part: a value that one document holds is as
much to be protected as any other. A value that every document holds has nothing to reveal.

Words are cut and lower-cased by the same functions near the entities and in the corpus. Where the two engines cut a
word differently (letters newer than one of them), it counts as in the documents that it was found in near an entity.

Cases: a null text counts as empty; a null id is kept and counts as a row of its own; repeated rows each count as a
document and each get a result; an empty table gives an empty table; other columns are ignored; a text of any length
takes time linear in it and its spans.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_left

import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factloom.llm.common import materialise

KINDS = ("email", "ip", "card", "phone")
#: The span kind that co-occurrence adds.
TERM = "term"

DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
#: The look-behind changes no match: a run of digits fails at each of its digits if it fails at the first.
IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
#: Scripts that part no words by spaces, by names that both engines know.
UNSPACED = ("Han", "Hiragana", "Katakana", "Thai", "Lao", "Khmer", "Myanmar", "Tibetan")
WORD = regex.compile(r"(?V1)[\p{L}&&[" + "".join(rf"\p{{{x}}}" for x in UNSPACED) + r"]]|[\p{L}--[" + "".join(rf"\p{{{x}}}" for x in UNSPACED) + "]]+")
#: The same for Spark.
SPARK_WORD = r"[\p{L}&&[" + "".join(rf"\p{{Is{x}}}" for x in UNSPACED) + r"]]|[\p{L}&&[^" + "".join(rf"\p{{Is{x}}}" for x in UNSPACED) + "]]+"
NOT_DIGIT = re.compile(r"[^0-9]")

#: Words on either side of an entity that are candidates.
WINDOW = 8
#: Documents added to a term's count.
SMOOTHING = 0.5
#: Share of an entity's information that a term must reveal to be sanitised, and to be removed altogether.
DISCLOSURE, REMOVAL = 0.85, 0.999
#: Distinct terms up to which they are broadcast to the corpus count.
BROADCAST_TERMS = 200_000

Span = tuple[int, int, str]


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def emails(text: str) -> list[Span]:
    """Leftmost, non-overlapping: what stands before each @ is the whole run of local characters since the last match."""
    out, last, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in LOCAL:
            start -= 1
        if start < at and (m := DOMAIN.match(text, at + 1)):
            out.append((start, m.end(), "email"))
            last = m.end()
        else:
            last = at + 1
        at = text.find("@", last)
    return out


def base_spans(text: str) -> list[Span]:
    """(start, end, kind), by kind as listed and then start."""
    out = emails(text)
    out += [(m.start(), m.end(), "ip") for m in IP.finditer(text) if all(len(p := part.lstrip("0")) <= 3 and int(p or 0) <= 255 for part in m[0].split("."))]
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 16 and 16 <= len(digits := NOT_DIGIT.sub("", m[0])) <= 19 and luhn(digits):
            out.append((m.start(), m.end(), "card"))
    if "+" in text:
        out += [(m.start(), m.end(), "phone") for m in PHONE.finditer(text) if 8 <= len(NOT_DIGIT.sub("", m[0])) <= 15]
    return out


def entity(kind: str, value: str) -> str:
    return f"{kind}:{value.lower() if kind in ('email', 'ip') else NOT_DIGIT.sub('', value)}"


def neighbours(text: str, spans: list[Span], window: int = WINDOW) -> list[tuple[str, str, int, int]]:
    """(entity, term, start, end) of the words near each span; the term is as the text has it."""
    begins, ends, furthest = [], [], 0  # the spans by their start; their ends, none before another's
    for s, e, _ in sorted(spans):
        furthest = max(furthest, e)
        begins.append(s)
        ends.append(furthest)
    words = []
    for m in WORD.finditer(text):
        k = bisect_left(begins, m.end())
        if not k or ends[k - 1] <= m.start():
            words.append((m.start(), m.end(), m[0]))
    starts, out = [w[0] for w in words], []
    for s, e, kind in spans:
        name, at = entity(kind, text[s:e]), bisect_left(starts, s)
        out += [(name, w, a, b) for a, b, w in words[max(0, at - window) : at + window]]
    return out


def _row(text: str | None) -> tuple:
    spans = base_spans(text := text or "")
    kinds = [k for _, _, k in spans]
    base = ",".join(f"{k}:{s}:{e}" for s, e, k in spans)
    near = neighbours(text, spans) if spans else []
    entities = sorted({entity(k, text[s:e]) for s, e, k in spans})
    return (*(kinds.count(k) for k in KINDS), hashlib.sha256(base.encode()).hexdigest(), base, entities, near)


COLUMNS = ["n_email", "n_ip", "n_card", "n_phone", "base_sha256", "base", "entities", "near"]
FOUND = "n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, base string, entities array<string>, near array<struct<entity:string,term:string,start:int,end:int>>"


def disclosures(docs: DataFrame, rows: DataFrame, text_col: str = "text", threshold: float = DISCLOSURE, support: int = 1) -> DataFrame:
    """(entity, term, ratio) of all pairs whose ratio PMI / IC reaches the threshold, counted by documents.

    rows: materialised (uid, entities, near) of all documents. Pairs are counted with map-side sums. A term is in at
    least as many documents as it has near any entity, so a pair whose ratio is too low by that count goes before the
    corpus is counted; this loses nothing and leaves the words of every text out. What is left is counted over the whole
    corpus, through a broadcast where the terms are proven few and by one aggregation of all words otherwise.
    support: the least number of documents in which a pair must meet.
    """
    entity_terms = F.array_distinct(F.transform("near", lambda x: F.struct(x["entity"].alias("entity"), F.lower(x["term"]).alias("term"))))
    found = rows.where(F.size("near") > 0)
    n = rows.count()
    pairs = found.select(F.explode(entity_terms).alias("x")).groupBy("x.entity", "x.term").agg(F.count("*").alias("n_et")).where(F.col("n_et") >= support)
    n_e = rows.select(F.explode("entities").alias("entity")).groupBy("entity").agg(F.count("*").alias("n_e"))
    n_near = found.select(F.explode(F.array_distinct(F.transform("near", lambda x: F.lower(x["term"])))).alias("term")).groupBy("term").agg(F.count("*").alias("n_near"))
    held = pairs.join(n_e, "entity").where(F.col("n_e") < n).join(n_near, "term")
    held = materialise(held.where(_ratio(n, "n_near") >= threshold), "pii-pairs")
    terms = held.select("term").distinct()
    few = terms.count() <= BROADCAST_TERMS
    cut = F.array_distinct(F.regexp_extract_all(text_col, F.lit(SPARK_WORD), F.lit(0)))
    words = docs.select(F.explode(F.array_distinct(F.transform(cut, F.lower))).alias("term"))
    counted = (words.join(F.broadcast(terms), "term", "left_semi") if few else words).groupBy("term").agg(F.count("*").alias("n_t"))
    known = held.join(counted, "term", "left").withColumn("n_t", F.greatest("n_near", F.coalesce("n_t", F.lit(0))))
    return known.select("entity", "term", _ratio(n, "n_t").alias("ratio")).where(F.col("ratio") >= threshold)


def _ratio(n: int, of_term: str) -> Column:
    """PMI / IC with the named count of the term."""
    known = F.log(F.lit(float(max(n, 1))) / F.col("n_e"))
    return (known + F.log(F.col("n_et") / (F.greatest(of_term, "n_et") + F.lit(SMOOTHING)))) / known


def sanitise(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = DISCLOSURE, support: int = 1, with_text: bool = False) -> DataFrame:
    """One row per input row: id, counts of the base kinds, digest of the base spans, all spans as kind:start:end by
    kind and start, the number of terms; with_text adds the sanitised text."""
    find = F.pandas_udf(lambda texts: pd.DataFrame([_row(t) for t in texts], columns=COLUMNS), FOUND)
    kept = [F.col(text_col).alias("text")] if with_text else []
    rows = materialise(docs.select(F.col(id_col).alias("doc_id"), *kept, F.monotonically_increasing_id().alias("uid"), find(F.col(text_col)).alias("f")).select("uid", "doc_id", *(["text"] if with_text else []), "f.*"), "pii-rows")
    found = disclosures(docs, rows, text_col, threshold, support)
    spots = rows.where(F.size("near") > 0).select("uid", F.explode("near").alias("x")).select("uid", "x.entity", F.lower("x.term").alias("term"), "x.start", "x.end")
    added = (
        spots.join(found, ["entity", "term"]).groupBy("uid", "start", "end").agg(F.max("ratio").alias("ratio"))
        .groupBy("uid").agg(F.sort_array(F.collect_list(F.struct("start", "end", "ratio"))).alias("added"))
    )
    terms = F.transform("added", lambda x: F.concat_ws(":", F.lit(TERM), x["start"].cast("string"), x["end"].cast("string")))
    out = rows.join(added, "uid", "left").withColumn("added", F.coalesce("added", F.array().cast("array<struct<start:int,end:int,ratio:double>>")))
    columns = [F.col("doc_id").alias(id_col), "n_email", "n_ip", "n_card", "n_phone", "base_sha256", F.array_join(F.filter(F.concat(F.array("base"), terms), lambda x: x != ""), ",").alias("spans"), F.size("added").cast("long").alias("n_terms")]
    if not with_text:
        return out.select(*columns)

    @F.pandas_udf("string")
    def clean(texts: pd.Series, base: pd.Series, added: pd.Series) -> pd.Series:
        return pd.Series([_clean(*x) for x in zip(texts, base, added, strict=True)], dtype=object)

    return out.select(*columns, clean("text", "base", "added").alias("sanitised"))


def _clean(text: str | None, base: str, added) -> str | None:
    """Base spans become the mark of their kind; terms are removed or become [TERM]."""
    if text is None:
        return None
    marks = [(int(s), int(e), f"[{k.upper()}]") for k, s, e in (x.split(":") for x in base.split(",") if x)]
    marks += [(x["start"], x["end"], "" if x["ratio"] >= REMOVAL else "[TERM]") for x in added]
    out, at = [], 0
    for s, e, mark in sorted(marks):
        if s >= at:
            out += [text[at:s], mark]
        at = max(at, e)
    return "".join([*out, text[at:]])


def ratio(n: int, n_e: int, n_t: int, n_et: int) -> float:
    """PMI / IC from document counts; the plain form of what `disclosures` computes."""
    return (math.log(n / n_e) + math.log(n_et / (max(n_t, n_et) + SMOOTHING))) / math.log(n / n_e)
