"""Identifiers, links and names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Words that say nothing of a company's identity.
LEGAL_FORMS = ("inc", "corp", "corporation", "co", "company", "llc", "lp", "ltd", "plc", "the", "new", "de")
ARCHIVE = "https://www.sec.gov/Archives/edgar/data"


def cik_padded(value: Column) -> Column:
    """Ten digits of a company number; anything but digits after an optional CIK prefix is an error."""
    digits = F.regexp_replace(F.trim(value), "(?i)^cik", "")
    return F.when(digits.rlike("^[0-9]+$"), F.when(F.length(digits) >= 10, digits).otherwise(F.lpad(digits, 10, "0"))).when(value.isNotNull(), F.raise_error(F.concat(F.lit("not a company number: "), value)))


def filing_url(cik: Column, accession: Column) -> Column:
    flat = F.regexp_replace(accession, "-", "")
    return F.concat(F.lit(f"{ARCHIVE}/"), cik.cast("bigint").cast("string"), F.lit("/"), flat, F.lit("/"), accession, F.lit("-index.htm"))


def document_url(cik: Column, accession: Column, document: Column) -> Column:
    """Null where the document is null or empty."""
    return F.when(document != "", F.concat(F.lit(f"{ARCHIVE}/"), cik.cast("bigint").cast("string"), F.lit("/"), F.regexp_replace(accession, "-", ""), F.lit("/"), document))


def base_form(form: Column) -> Column:
    return F.split_part(form, F.lit("/"), F.lit(1))


def company_name(value: Column) -> Column:
    """A name for comparison: lower case, letters and digits only, without legal forms."""
    words = F.split(F.regexp_replace(F.lower(value), "[^a-z0-9]+", " "), " ")
    return F.array_join(F.filter(words, lambda w: ~w.isin("", *LEGAL_FORMS)), " ")
