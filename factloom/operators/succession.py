"""Registrants that succeed others: the predecessor is named in the notice and must be the one filer of that name."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factloom.functions.names import company_name
from factloom.functions.text import flatten

NOTICE = "8-K12B"
#: What a company says of itself behind its name, and how far before that its name may begin.
COMPANY_WORDS, NAME_REACH = ("corporation", "company"), 200
#: Ends of a name that a comma may stand before, and small words inside of one.
SUFFIX = r"^(?:Inc|Incorporated|L\.?L\.?C|L\.?P|Ltd|Limited|Corp|Co)\.?$"
NAME_AT_END = r"((?:[A-Z0-9][\w&.'\-]*)(?:\s+(?:[A-Z0-9&][\w&.'\-]*|and|of|the|de|du|la))*)$"
SHORTEST, LONGEST = 4, 81


def _before(text: Column, phrase: str) -> Column:
    """What stands before a phrase, in any case; null without it."""
    at = F.instr(F.lower(text), phrase)
    return F.when(at > 0, F.substring(text, F.greatest(F.lit(1), at - NAME_REACH), F.least(at - 1, F.lit(NAME_REACH))))


def _behind(text: Column, phrase: str) -> Column:
    at = F.instr(F.lower(text), phrase)
    return F.when(at > 0, F.substring(text, at + len(phrase), F.lit(NAME_REACH)))


def _tidy(name: Column) -> Column:
    """A name without blanks and marks around it; null if it does not begin as one or has no fit length."""
    trimmed = F.regexp_replace(F.regexp_replace(name, r"\s+", " "), r"^[ ,.]+|[ ,.]+$", "")
    return F.when(trimmed.rlike("^[A-Z]") & F.length(trimmed).between(SHORTEST - 1, LONGEST), trimmed)


def _described(text: Column) -> Column:
    """NAME, a Delaware corporation and the predecessor registrant."""
    parts = F.transform(F.split(_before(text, " and the predecessor registrant"), ","), lambda p: F.trim(p))
    what = F.lower(F.element_at(parts, -1))
    is_company = what.rlike("^an? ") & F.substring_index(what, " ", -1).isin(*COMPANY_WORDS)
    name, ahead = F.try_element_at(parts, F.lit(-2)), F.try_element_at(parts, F.lit(-3))
    whole = F.when(name.rlike(SUFFIX) & ahead.isNotNull(), F.concat(ahead, F.lit(", "), name)).otherwise(name)
    stem = F.regexp_extract(F.when(name.rlike(SUFFIX) & ahead.isNotNull(), ahead).otherwise(name), NAME_AT_END, 1)
    return F.when(is_company, _tidy(F.when(name.rlike(SUFFIX) & ahead.isNotNull() & (stem != ""), F.concat(stem, F.lit(", "), name)).when(whole.isNotNull(), stem)))


def predecessor_name(text: Column) -> Column:
    """The predecessor that a notice names: described as one, else named behind the words, else the one that the filer
    succeeds as issuer; null where none of these stands in it. Blanks of the text are single."""
    named = F.regexp_extract(_behind(text, "predecessor registrant"), r"^[\s,]*([^,.(]+)", 1)
    succeeded = F.split(F.regexp_replace(_behind(text, "successor issuer to"), r"^\s+(?:the\s+)?", ""), r"\s+(?:under|pursuant)\b|,")[0]
    return F.coalesce(_described(text), _tidy(named), _tidy(succeeded))


def successions(filings: DataFrame, notices: DataFrame, filers: DataFrame) -> DataFrame:
    """One row a company of filings: status resolved, unconfirmed or none, with the predecessor where it is one filer.

    filings: cik, form, accession, filed_date, ordinal (0: newest); notices: accession, html; filers: cik, name of those
    with annual reports. A name that several filers share, or that is the company's own, confirms nothing.
    """
    newest = filings.where(F.col("form") == NOTICE).groupBy("cik").agg(F.min_by(F.struct("accession", "filed_date"), "ordinal").alias("n")).select("cik", "n.*")
    named = newest.join(notices, "accession", "left").select("cik", "accession", "filed_date", predecessor_name(flatten(F.col("html"))).alias("predecessor_name"))
    known = filers.groupBy(company_name(F.col("name")).alias("key")).agg(F.collect_set("cik").alias("ciks")).where((F.col("key") != "") & (F.size("ciks") == 1)).select("key", F.col("ciks")[0].alias("found"))
    out = filings.select("cik").distinct().join(named, "cik", "left").withColumn("key", company_name(F.col("predecessor_name"))).join(known, "key", "left")
    sure = F.col("found").isNotNull() & (F.col("found") != F.col("cik"))
    status = F.when(F.col("accession").isNull(), "none").when(sure, "resolved").otherwise("unconfirmed")
    note = (
        F.when(F.col("accession").isNull(), f"no {NOTICE} filed").when(F.col("predecessor_name").isNull(), f"{NOTICE} names no predecessor")
        .when(F.col("found").isNull(), "no single annual filer of that name").when(~sure, "resolved to itself")
    )
    return out.select("cik", status.alias("status"), F.when(sure, F.col("found")).alias("predecessor_cik"), "predecessor_name", "accession", "filed_date", note.alias("note"))


def needing_history(company: DataFrame, fact: DataFrame) -> DataFrame:
    """Companies without a fact of their own, whose predecessor is to be looked for."""
    return company.join(fact.select("cik"), "cik", "left_anti")


def follow(company: DataFrame, successions_: DataFrame) -> DataFrame:
    """company with history_cik: the predecessor's where it is resolved, else its own."""
    resolved = successions_.where("status = 'resolved'").select("cik", "predecessor_cik")
    return company.join(resolved, "cik", "left").withColumn("history_cik", F.coalesce("predecessor_cik", "cik")).drop("predecessor_cik")
