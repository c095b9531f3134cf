"""Places of the public archive, and of documents in the corpus, as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from factloom.functions.names import ARCHIVE, cik_padded

# The public hosts of the archive.
DATA, SITE = "https://data.sec.gov", "https://www.sec.gov"
PAGE = 100


def companyfacts_url(cik: Column) -> Column:
    return F.concat(F.lit(f"{DATA}/api/xbrl/companyfacts/CIK"), cik_padded(cik), F.lit(".json"))


def companyconcept_url(cik: Column, taxonomy: Column, tag: Column) -> Column:
    return F.concat(F.lit(f"{DATA}/api/xbrl/companyconcept/CIK"), cik_padded(cik), F.lit("/"), taxonomy, F.lit("/"), tag, F.lit(".json"))


def submissions_url(cik: Column) -> Column:
    return F.concat(F.lit(f"{DATA}/submissions/CIK"), cik_padded(cik), F.lit(".json"))


def filing_dir(cik: Column, accession: Column) -> Column:
    return F.concat(F.lit(f"{ARCHIVE}/"), cik.cast("bigint").cast("string"), F.lit("/"), F.regexp_replace(accession, "-", ""))


def instance_name(primary_doc: Column) -> Column:
    """The plain instance that the archive makes of an inline document."""
    return F.when(primary_doc.rlike(r"(?i)\.html?$"), F.concat(F.regexp_replace(primary_doc, r"(?i)\.(html?)$", "_$1"), F.lit(".xml")))


def document_path(root: str, accession: Column, name: Column) -> Column:
    return F.concat_ws("/", F.lit(root.rstrip("/")), accession, name)


def browse_url(sic: str, form: str, start: int) -> str:
    """A page of the list of filers of an industry code that filed a form."""
    return f"{SITE}/cgi-bin/browse-edgar?action=getcompany&SIC={sic}&type={form}&dateb=&owner=include&count={PAGE}&start={start}&output=atom"


def fiscal_year(period_end: Column) -> Column:
    return F.substring(period_end, 1, 4).cast("int")


def qualified_tag(taxonomy: Column, tag: Column) -> Column:
    """taxonomy:tag; null without a tag, and the bare tag without a taxonomy."""
    return F.when(tag.isNotNull(), F.concat_ws(":", taxonomy, tag))
