"""Queries over filed documents and payloads that are made from the driver's tables; `oracles_filed` has their SQL.

A supplier files one report: contents, a text, a table of reserves, one of production and marked-up figures, with numbers
of its own. The readers get it as HTML, and the SQL states what is in it from the same columns.
"""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from factloom.catalogue import CIK, PERIOD, TEST_SPEC, VIEW, Query, scale_rows, served
from factloom.documents import functions as table_functions
from factloom.documents import production
from factloom.documents import operators as readers
from factloom.functions import names, stems, text, units
from factloom.operators import acquisition, clusters, crosscheck, identity, merges, phrase_index, scale, sites, succession, sync, validation, writes
from factloom.plans import answers, counts, quality, reports, series, service, views
from factloom.registry import DEVELOPED, TOTAL, concepts_frame, units_frame
from factloom.session import kept, kept_with, work_folder, work_path
from factloom.sources import archive, corpus, payloads, urls
from factloom.sources.store import TABLES, open_older, open_store, tpch_store
from factloom.streaming import current, watch

QUERIES: dict[str, Query] = {}


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def _text(*parts: Column | str) -> Column:
    return F.concat(*[p.cast("string") if isinstance(p, Column) else F.lit(p) for p in parts])


def _row(*cells: Column | str) -> Column:
    return _text("<tr>", *[x for c in cells for x in ("<td>", c, "</td>")], "</tr>")


def _table(*rows: Column) -> Column:
    return _text("<table>", *rows, "</table>")


def _suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """k: the number of a supplier; d, u: whole numbers of its own."""
    rows = spark.read.parquet(f"{sf_dir}/supplier.parquet")
    base = F.floor(F.abs("s_acctbal")).cast("long") + 1000
    return rows.select(F.col("s_suppkey").cast("long").alias("k"), F.col("s_name").alias("name"), base.alias("d"), (base + F.col("s_suppkey") % 7).cast("long").alias("u"), F.col("s_nationkey").cast("long").alias("nation"))


#: Reports that one task makes and reads.
TASK_REPORTS = 250


def _filers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers dealt over tasks before their reports are made: a file of a few bytes a row is one task for Spark, but each
    row becomes a document that Python reads."""
    rows = _suppliers(spark, sf_dir)
    return rows.repartition(max(1, -(-rows.count() // TASK_REPORTS)), "k")


def _reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """accession, cik, name, raw, doc_rank, fallback_period, and the numbers that the report is made of."""
    k, d, u = F.col("k"), F.col("d"), F.col("u")
    printed = lambda c: F.format_number(c, 0)
    contents = "".join(f"<p>Item {n}. {t} .... {p}</p>" for n, t, p in (("1", "Business", 3), ("1A", "Risk Factors", 9), ("2", "Properties", 12), ("7", "Results", 20)))
    reserves = _table(
        _row("", "Oil (MBbls)", "Total (MBoe)"), _row("Proved developed", printed(d), printed(d + 10)), _row("Proved undeveloped", printed(u), printed(u + 10)),
        _row("Total proved", printed(d + u), printed(F.when(k % 4 == 0, d + u + 500).otherwise(d + u + 20))),
    )
    sales = lambda times: _table(
        _row("", "2023", "2022"), _row("Production volumes:"), _row("Oil (MBbls)", printed(d * times), printed(d * times + 1)), _row("Natural gas (MMcf)", printed(u * 6 * times), printed(u * 6 * times + 6)),
        _row("Total (MBoe)", printed((d + u) * times), printed((d + u) * times + F.when(k % 5 == 0, 100 * times).otherwise(2))), _row("Average sales price (excluding hedges):"),
        _row("Oil (per Bbl)", "$80.00", "$70.00"), _row("Gas (per Mcf)", "3.00", "(2.50)"), _row("Average production cost per BOE", "$9.50", "8.25"), _row("Oil mix", "50%", "60%"),
    )
    figure = lambda context, value, name: _text(f'<ix:nonFraction name="srt:{name}" contextRef="{context}" unitRef="u" scale="3" id="f-{context}">', value, "</ix:nonFraction>")
    marked = _text(
        '<ix:header>silent</ix:header><context id="c1"><period><endDate>2023-12-31</endDate></period></context><context id="c2"><segment><explicitMember dimension="srt:ProductOrServiceAxis">srt:OilReservesMember</explicitMember></segment><period><instant>2023-12-31</instant></period></context>'
        '<unit id="u"><measure>utr:MBoe</measure></unit>', "<p>Marked ", figure("c1", printed(d + 10), "ProvedDevelopedReservesVolume"), " and ", figure("c2", printed(d), "ProvedDevelopedReservesVolume"), "</p>",
    )
    raw = _text(
        "<head><title>gone</title></head>", contents, "<hr/><p>Item 1. Business</p><p>", F.col("name"), " drills&nbsp;wells &amp; more &#8722; ", k, "</p><p>7</p><hr><p>Item 2. Properties</p><p>As of December 31, 2023</p>",
        reserves, "<hr><p>Item 7. Results</p>", sales(1), F.when(k % 3 == 0, sales(10)).otherwise(F.lit("")), marked, "<p>Page 9</p>",
    )
    accession = _text("acc-", k)
    return _filers(spark, sf_dir).select("*", accession.alias("accession"), F.lpad(k.cast("string"), 10, "0").alias("cik"), F.lit("r.htm").alias("file"), raw.alias("raw"), F.lit(0).alias("doc_rank"), F.lit("2020-12-31").alias("fallback_period"))


def _corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _reports(spark, sf_dir).select("accession", "cik", F.col("file").alias("name"), "raw", "doc_rank", "fallback_period")


# Documents
@query
def page_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readers.lines(_corpus(spark, sf_dir)).select("accession", "page", "line_no", "section", "text")


@query
def table_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells of the reserve tables with the labels over them and before them."""
    return readers.cells(_corpus(spark, sf_dir)).where("table_index = 0").select("accession", "row", "column", "text", "header", "row_label")


@query
def marked_figures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readers.figures(_corpus(spark, sf_dir), ("srt:ProvedDevelopedReservesVolume",)).select("accession", "shown", "value", "unit", "product", "period_end", "element_id")


@query
def reserve_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readers.reserve_readings(_corpus(spark, sf_dir)).select("accession", "concept_key", "product", "value", "unit", "period_end", "row_label")


def _in_sql(name: str, text: str) -> None:
    """A query of SQL over the reports ({reports}) that calls the readers as table functions."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        table_functions.register(spark)
        return spark.sql(text, reports=_corpus(spark, sf_dir))

    run.__name__ = name
    QUERIES[name] = run


_in_sql("lines_in_sql", "SELECT accession, l.page, l.line_no, l.section, l.text FROM {reports}, LATERAL document_lines(raw) l")
_in_sql("cells_in_sql", "SELECT accession, c.row, c.column, c.text, c.header, c.row_label FROM {reports}, LATERAL document_cells(raw) c WHERE c.table_index = 0")
_in_sql("figures_in_sql", "SELECT accession, f.shown, f.value, f.unit, f.product, f.period_end, f.element_id FROM {reports}, LATERAL document_figures(raw, array('srt:ProvedDevelopedReservesVolume')) f")
_in_sql("reserves_in_sql", "SELECT accession, r.concept_key, r.product, r.value, r.unit, r.period_end, r.row_label FROM {reports}, LATERAL reserve_readings(raw, fallback_period) r")
_in_sql("production_in_sql", "SELECT accession, p.concept_key, p.product, p.value, p.unit, p.period_end, p.is_hedged FROM {reports}, LATERAL production_readings(raw) p WHERE p.table_index = 1")


@query
def matched_figures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facts beside the printed developed reserves of their report: as near as thousands round, too far, of another period."""
    rows, k = _suppliers(spark, sf_dir), F.col("k")
    thousand = (F.col("d") + 10) * 1000.0
    off = F.when(k % 4 == 0, 499.0).when(k % 4 == 1, -500.0).when(k % 4 == 2, 501.0).otherwise(0.0)
    facts = rows.select(
        k.alias("id"), _text("acc-", k).alias("accession"), F.lit("ProvedDevelopedReservesVolume").alias("tag"), F.when(k % 5 == 0, "2022-12-31").otherwise("2023-12-31").alias("period_end"), (thousand + off).alias("value"),
        F.when(k % 3 == 0, "oil").alias("product"),
    )
    found = readers.match_figures(facts, readers.figures(_corpus(spark, sf_dir)))
    return found.select("fact_id", "name", "shown", "value", "element_id")


@query
def reserve_closure(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readers.closes(readers.reserve_readings(_corpus(spark, sf_dir)))


@query
def one_reading(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings of two tables, of which every third company's disagree."""
    own = readers.reserve_readings(_corpus(spark, sf_dir))
    number = F.regexp_extract("accession", "[0-9]+", 0).cast("long")
    again = own.withColumn("table_index", F.lit(9)).withColumn("value", F.col("value") + F.when(number % 3 == 0, 1.0).otherwise(0.0))
    return readers.one_reading(own.unionByName(again)).select("accession", "concept_key", "product", "period_end", "unit", "value")


@query
def production_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readers.production_readings(_corpus(spark, sf_dir)).where("table_index = 1").select("accession", "concept_key", "product", "value", "unit", "period_end", "is_hedged")


@query
def production_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readers.production_tables(_corpus(spark, sf_dir)).select("accession", "table_index", "period_end", F.round("implied", 2).alias("implied"), "closes")


@query
def chosen_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of two tables the one that revenue confirms; every second company has a revenue, every fourth a far one."""
    own = _reports(spark, sf_dir)
    k = F.col("k")
    revenue = own.where(k % 2 == 0).select("cik", F.lit("2023-12-31").alias("period_end"), (F.when(k % 4 == 0, 3).otherwise(1) * (F.col("d") * 80000 + F.col("u") * 18000)).cast("double").alias("revenue"))
    worth = readers.production_tables(_corpus(spark, sf_dir)).join(own.select("accession", "cik"), "accession")
    return crosscheck.chosen_tables(worth, revenue, production.REVENUE_TOLERANCE)


@query
def prefer_unhedged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prices printed before and after hedges."""
    prices = kept(readers.production_readings(_corpus(spark, sf_dir)).where(f"concept_key = '{production.PRICE}' and table_index = 1"), "prices")  # reports are read once
    after = prices.withColumn("is_hedged", F.lit(True)).withColumn("value", F.col("value") * 2).withColumn("table_index", F.lit(0))
    return readers.prefer_unhedged(prices.unionByName(after)).select("accession", "product", "period_end", "value", "is_hedged")


@query
def verify_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facts that the markup has, that the text has, that neither has (no report prints a negative number of thousands),
    and that no search can find."""
    own = _reports(spark, sf_dir)
    kind = lambda name, value, tag: own.select(_text(name, F.col("k")).alias("id"), "accession", F.lit(tag).cast("string").alias("tag"), F.lit("2023-12-31").alias("period_end"), value.cast("double").alias("value"), F.lit(None).cast("string").alias("product"))
    facts = kind("m", (F.col("d") + 10) * 1000, "ProvedDevelopedReservesVolume").unionByName(kind("t", F.col("d") + F.col("u"), None)).unionByName(kind("n", F.col("d") * 0 - 7654321, None)).unionByName(kind("s", F.col("d") * 0 + 7, None))
    return readers.verify(facts, _corpus(spark, sf_dir)).select("fact_id", "status", "method", "printed", "page", "section", "anchor")


@query
def product_volumes(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = _reports(spark, sf_dir)
    k = F.col("k")
    filings = own.select("accession", "cik", F.when(k % 5 == 0, "20-F").otherwise("10-K/A").alias("form"), F.lit("2024-02-01").alias("filed_date"), F.when(k % 2 == 0, "r.htm").alias("primary_doc"))
    exhibit = _corpus(spark, sf_dir).withColumn("name", F.lit("ex99.htm")).withColumn("raw", F.concat("raw", "raw"))
    rows = readers.product_volumes(filings, _corpus(spark, sf_dir).unionByName(exhibit))
    return rows.select("cik", "concept_key", "taxonomy", "tag", "value", "unit", "product", "unit_rank", "fiscal_year", "accession", "form", "extracted_by")


@query
def index_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Attachments of index pages, and the document that stands for each filing."""
    return _items(spark, sf_dir).select("accession", "description", "document", "type", "size")


def _items(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = _reports(spark, sf_dir)
    k = F.col("k")
    line = lambda *c: _row("1", *c)
    page = _table(
        line("Annual report", "main.htm iXBRL", "10-K", F.format_number(F.col("d") * 10, 0)), line("Other", "other.htm", "GRAPHIC", F.format_number(F.col("u") * 10, 0)), line("Index", "x-index.htm", "10-K", "99,999,999"),
        line("Release", "ex991.htm", "EX-99.1", F.when(k % 2 == 0, "5,000").otherwise("300")), line("Picture", "a.jpg", "EX-99.2", "90000"), "<tr><td>short</td></tr>",
    )
    return own.select("accession", F.explode(corpus.index_items(page)).alias("i")).select("accession", "i.*")


@query
def primary_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("k")
    filings = _reports(spark, sf_dir).select("accession", F.when(k % 3 == 0, "given.htm").when(k % 3 == 1, "").alias("primary_doc"))
    return corpus.primary_documents(filings, _items(spark, sf_dir))


@query
def sheets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second page of each report, and none beyond the last."""
    raw = F.col("raw")
    return _corpus(spark, sf_dir).select("accession", text.flatten(corpus.sheet(raw, F.lit(2))).alias("second"), corpus.sheet(raw, F.lit(9)).isNull().alias("none"), text.flatten(corpus.sheet(raw, F.lit(3), strict=True)).alias("third"))


def _documents(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(document_id, text) and the attributes that an index has of them."""
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet").select(F.col("doc_id").alias("document_id"), "text")
    n = F.col("document_id")
    return documents, documents.select("document_id", _text("a-", n % 50).alias("accession"), _text("c-", n % 5).alias("cik"), F.when(n % 2 == 0, "10-K").otherwise("20-F").alias("form"), _text("d", n, ".htm").alias("name"))


_INDEXED: dict[tuple[str, str], str] = {}


def _indexed(spark: SparkSession, sf_dir: str) -> str:
    """The folder of the index of all documents, written once a session."""
    key = spark.sparkContext.applicationId, sf_dir
    if key not in _INDEXED:
        documents, about = _documents(spark, sf_dir)
        folder = work_path(spark, "document-index")
        phrase_index.build(sites.document_lines(documents, "document_id"), about, folder, segment_postings=1_000_000, file_postings=500_000)
        _INDEXED[key] = folder
    return _INDEXED[key]


@query
def document_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines found in the index by phrases, form and company."""
    return phrase_index.search(spark, _indexed(spark, sf_dir), ("of the", "and the"), cik="c-2", form="10-K").select("document_id", "line_no", "accession")


@query
def phrase_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often each phrase stands in each document, by the index: two words, one word, five words, none."""
    found = phrase_index.find(spark, _indexed(spark, sf_dir), ("in the", "Er", "a b c d e", "..."), exact=True)
    return found.groupBy("document_id", "phrase").agg(F.count("*").alias("n"), F.min("line_no").alias("first_line"))


@query
def reindexed_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines with a phrase after some documents got another text and others were removed from the index."""
    documents, about = _documents(spark, sf_dir)
    folder, n = work_path(spark, "document-index"), F.col("document_id")
    phrase_index.build(sites.document_lines(documents, "document_id"), about, folder, segment_postings=200_000, file_postings=100_000)
    some = documents.where(n % 40 == 3)
    again = some.where(n % 80 == 3).select("document_id", F.concat(F.lit("In the end\n"), F.col("text"), F.lit("\nall of the rest")).alias("text"))
    phrase_index.replace(sites.document_lines(again, "document_id"), about.join(some, "document_id", "left_semi"), folder)
    return phrase_index.search(spark, folder, ("of the", "in the"), exact=True).select("document_id", "line_no", "form")


@query
def corpus_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reports stored as files below accession and name, and read again."""
    root = work_path(spark, "corpus")
    acquisition.store_documents(_corpus(spark, sf_dir), root).write.format("noop").mode("overwrite").save()
    return corpus.read_corpus(spark, root).select("accession", "name", F.length("raw").cast("long").alias("chars"), F.md5("raw").alias("md5"))


@query
def company_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers of a text file with comments, further fields and repeats."""
    folder = work_path(spark, "numbers")
    k = F.col("k")
    line = F.when(k % 4 == 0, _text("# only a comment ", k)).when(k % 4 == 1, _text(k, ", more")).when(k % 4 == 2, _text("CIK", k, " # why")).otherwise("7")
    _suppliers(spark, sf_dir).select(line).write.text(folder)
    return payloads.cik_list(spark, folder)


# Cross-checks
def _tagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two tagged facts a supplier and product, of which the later id counts; every third has no product."""
    k = F.col("k")
    one = lambda tail, value: _suppliers(spark, sf_dir).select(_text("f", k, tail).alias("id"), F.lpad(k.cast("string"), 10, "0").alias("cik"), F.lit(TOTAL).alias("concept_key"), F.when(k % 3 != 0, "oil").alias("product"), F.lit("2023-12-31").alias("period_end"), value.cast("double").alias("value"), F.lit("MBoe").alias("unit"), F.when(k % 11 == 0, "table:reserves").otherwise("xbrl").alias("extracted_by"))
    return one("a", F.lit(1)).unionByName(one("b", F.col("d")))


@query
def cross_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("k")
    times = F.when(k % 4 == 0, 1000).when(k % 4 == 1, 1000000).when(k % 4 == 2, 1003).otherwise(1500)
    readings = _suppliers(spark, sf_dir).select(F.lpad(k.cast("string"), 10, "0").alias("cik"), F.lit(TOTAL).alias("concept_key"), F.when(k % 3 != 0, "oil").alias("product"), F.lit("2023-12-31").alias("period_end"), (F.col("d") * times).cast("double").alias("value"), F.lit("Boe").alias("unit"))
    return crosscheck.cross_check(readings, _tagged(spark, sf_dir)).select("cik", "product", "outcome", F.round("ratio", 6).alias("ratio"))


@query
def first_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = served(spark, sf_dir).fact.where(F.col("concept_key") == TOTAL).withColumn("concept_key", F.lit("oil_and_gas_revenue"))
    return crosscheck.first_revenue(facts.withColumn("extracted_by", F.when(F.col("product_key") == "ngl", "table:x").otherwise("xbrl:inline")))


# Acquisition
def _submitted(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = served(spark, sf_dir)
    n = F.col("accession").cast("long")
    form = F.when(n % 5 == 0, "8-K").when(n % 5 == 1, "40-F").when(n % 5 == 2, "10-K/A").otherwise("10-K")
    return s.filing.select("cik", "accession", form.alias("form"), "filed_date", F.when(n % 7 != 0, _text("p", n, ".htm")).alias("primary_doc"))


def _attached(spark: SparkSession, sf_dir: str) -> DataFrame:
    filings = _submitted(spark, sf_dir)
    n = F.col("accession").cast("long")
    items = F.array(*[F.struct(_text(f"ex{i}.htm").alias("document"), F.lit(f"EX-99.{i}").alias("type"), (n % 1000 * i + 3900).alias("size")) for i in (1, 2)])
    return filings.where("form in ('8-K', '40-F')").select("accession", F.explode(items).alias("i")).select("accession", "i.*")


def _stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("accession").cast("long")
    own = _submitted(spark, sf_dir)
    return own.where((n % 3 == 0) & F.col("primary_doc").isNotNull()).select("accession", F.col("primary_doc").alias("name")).unionByName(own.where(n % 10 == 0).select("accession", F.lit("ex1.htm").alias("name")))


@query
def wanted_filings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return acquisition.wanted_filings(_submitted(spark, sf_dir), ("10-K", "8-K"), "1993-01-01", 2).select("cik", "accession", "form", "filed_date")


@query
def acquisition_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = acquisition.wanted_filings(_submitted(spark, sf_dir), ("10-K", "8-K", "40-F"), "1993-01-01", 2)
    return acquisition.plan(wanted, _attached(spark, sf_dir), _stored(spark, sf_dir))


@query
def documents_of_filings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return acquisition.documents_of(_submitted(spark, sf_dir), _stored(spark, sf_dir), _attached(spark, sf_dir))


@query
def payload_misses(spark: SparkSession, sf_dir: str) -> DataFrame:
    company = served(spark, sf_dir).company
    return acquisition.misses(company, company.where(F.col("cik").cast("long") % 3 == 0))


# Measured against stored
def _measured(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = served(spark, sf_dir)
    n = F.col("cik").cast("long")
    tags = s.company.where(n % 6 != 0).select("cik", (n % 4).alias("us_gaap"), (n % 3).alias("ifrs"))
    number = F.col("accession").cast("long")
    filings = s.filing.select((number % 200 + 1).alias("k"), "form", number.alias("ordinal")).select(F.lpad(F.col("k").cast("string"), 10, "0").alias("cik"), "form", "ordinal")
    return sync.measured(s.company, tags, filings)


@query
def measured_regimes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _measured(spark, sf_dir)


@query
def regime_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sync.regime_report(_measured(spark, sf_dir))


@query
def apply_measured(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sync.apply_measured(served(spark, sf_dir).company, _measured(spark, sf_dir), apply=True).select("cik", "reporting_taxonomy", "disclosure_regime")


@query
def apply_tickers(spark: SparkSession, sf_dir: str) -> DataFrame:
    company = served(spark, sf_dir).company
    n = F.col("cik").cast("long")
    return sync.apply_tickers(company, company.where(n % 5 != 0).select("cik", _text("N", n).alias("ticker")), apply=True, overwrite=False).select("cik", "ticker")


@query
def apply_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = served(spark, sf_dir)
    status = s.company.where(F.col("cik").cast("long") % 2 == 0).select("cik", F.lit("deregistered").alias("listing_status"), F.lit("1999-01-01").alias("last_filing_date"))
    return sync.apply_listing(s.company, status).select("cik", "listing_status", "last_filing_date")


@query
def load_cohort(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidates written as CSV and read back; numbers that the store has not are left out."""
    company = served(spark, sf_dir).company
    n = F.col("cik").cast("long")
    folder = work_path(spark, "candidates")
    rows = company.where(n % 2 == 0).select("cik", F.when(n % 4 == 0, F.concat("name", F.lit(" Royalty Trust"))).otherwise(F.col("name")).alias("name"), _text("A", n, "|B", n).alias("tickers"))
    rows.unionByName(rows.limit(1).withColumn("cik", F.lit("9999999999"))).coalesce(1).write.csv(folder, header=True)
    candidates = payloads.cohort_csv(spark, folder)
    return sync.load_cohort(company, candidates, identity.is_operator(F.lit(None).cast("string"), F.col("name"))).select("cik", "name", "ticker", "is_operator")


# Payloads
def _submissions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Submissions as JSON texts, parsed again: customers' orders as recent filings."""
    s = served(spark, sf_dir)
    n = F.col("cik").cast("long")
    number = F.col("accession").cast("long")
    listed = F.struct(F.col("filed_date").alias("d"), number.alias("n"), F.when(number % 4 == 0, "8-K").otherwise(F.col("form")).alias("f"), "accession")
    recent = s.filing.groupBy("cik").agg(F.array_sort(F.collect_list(listed)).alias("x"))
    field = lambda name: F.transform("x", lambda r: r[name])
    recent = recent.withColumn("filings", F.struct(F.struct(field("f").alias("form"), field("d").alias("filingDate"), field("accession").alias("accessionNumber")).alias("recent")))
    state = F.when(n % 4 == 0, F.struct(F.lit("TX").alias("stateOrCountry"), F.lit("TX").alias("stateOrCountryDescription"))).when(n % 4 == 1, F.struct(F.lit("A0").alias("stateOrCountry"), F.lit("Alberta, Canada").alias("stateOrCountryDescription")))
    doc = F.to_json(F.struct(
        n.cast("string").alias("cik"), _text("Customer ", n).alias("name"), F.array(_text("C", n)).alias("tickers"), F.struct(state.alias("business")).alias("addresses"), F.when(n % 4 == 2, "X0").alias("stateOfIncorporation"),
        F.when(n % 4 == 2, "Norway").alias("stateOfIncorporationDescription"), F.array(F.struct(_text("Old ", n).alias("name"))).alias("formerNames"), "filings",
    ))
    broken = F.when(n % 10 == 0, F.lit("{not json")).otherwise(doc)
    return payloads.parsed(recent.select(broken.alias("doc")), "doc")


@query
def submission_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    ciks = served(spark, sf_dir).filing.select("cik")
    rows = payloads.profiles_of(ciks, _submissions(spark, sf_dir))
    return rows.select("cik", "name", F.array_join("tickers", ",").alias("tickers"), F.array_join("former_names", ",").alias("former_names"), "is_foreign", "country", "annual_count", "latest_annual", "annual_form", "eightk_count", "latest_8k", "error")


@query
def discovery_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.discovery_report(payloads.profiles_of(served(spark, sf_dir).filing.select("cik"), _submissions(spark, sf_dir)))


@query
def submission_filings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return payloads.filings(_submissions(spark, sf_dir)).groupBy("form").agg(F.count("*").alias("n"), F.min("filed_date").alias("first"), F.max("filed_date").alias("last"))


@query
def ticker_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A map of tickers by row number as one JSON text, and the first ticker of each company."""
    k = F.col("k")
    rows = _suppliers(spark, sf_dir).select(F.explode(F.array(*[F.struct((k * 3 + i).cast("string").alias("key"), F.struct(k.cast("string").alias("cik_str"), _text(t, k).alias("ticker"), F.lit("x").alias("title")).alias("value")) for i, t in enumerate(("B", "A", "B"))])).alias("e"))
    doc = rows.groupBy((F.col("e.value.cik_str").cast("long") % 4).alias("file")).agg(F.to_json(F.map_from_entries(F.collect_list("e"))).alias("j"))
    return payloads.first_tickers(payloads.ticker_map(payloads.parsed(doc, "j"))).select("cik", "ticker", F.col("n").cast("long").alias("n"))


@query
def revalidated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payloads of tagged facts as JSON texts; coherent, drifting and incomplete filers; every ninth is not known."""
    k, d, u = F.col("k"), F.col("d"), F.col("u")
    seen = lambda value, year: F.struct(F.lit(f"{year}-12-31").alias("end"), value.cast("double").alias("val"), _text("a", k, str(year)).alias("accn"), F.lit("10-K").alias("form"), F.lit(f"{year + 1}-02-20").alias("filed"))
    unit = lambda early, late: F.struct(F.create_map(F.lit("MBoe"), F.array(seen(early, 2022), seen(late, 2023))).alias("units"))
    drift = F.when(k % 5 == 0, d + u + 9000).otherwise(d + u)
    tags = F.create_map(F.lit("ProvedDevelopedReservesVolume"), unit(d, d), F.lit("ProvedUndevelopedReserveVolume"), unit(u, u), F.when(k % 7 == 0, "Other").otherwise("ProvedDevelopedAndUndevelopedReservesNet"), unit(d + u, drift))
    doc = F.to_json(F.struct(k.cast("string").alias("cik"), F.create_map(F.lit("srt"), tags).alias("facts")))
    rows = _suppliers(spark, sf_dir)
    company = rows.where(k % 9 != 0).select(F.lpad(k.cast("string"), 10, "0").alias("cik"))
    return payloads.revalidated(payloads.parsed(rows.select(doc.alias("doc")), "doc"), company)


@query
def payload_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts that give no payload, by reason; the others' fields that no schema names are still there."""
    k = F.col("k")
    doc = F.to_json(F.struct(k.alias("cik"), F.create_map(F.lit("x"), F.create_map(F.lit("Odd"), F.struct(F.create_map(F.lit("u"), F.array(F.struct(k.cast("double").alias("val"), _text("n", k).alias("note")))).alias("units")))).alias("facts")))
    text = F.when(k % 5 == 0, F.substring(doc, 1, 12)).when(k % 5 == 1, "[1, 2]").when(k % 5 == 2, " ").when(k % 5 == 3, doc)
    found = payloads.parsed(_suppliers(spark, sf_dir).select(text.alias("doc")), "doc")
    good = payloads.observations(found).select(F.lit("note of an observation").alias("error"), payloads.field("observed", "$.note", "string").alias("note"), "val")
    kept = good.where(F.col("note") == F.concat(F.lit("n"), F.col("val").cast("long").cast("string"))).groupBy("error").agg(F.count("*").alias("n"))
    return payloads.failures(found).unionByName(kept)


# Scalars and names
@query
def archive_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("k").cast("string")
    accession = F.concat(F.lit("0000-24-"), k)
    return _suppliers(spark, sf_dir).select(
        "k", urls.companyfacts_url(k).alias("facts"), urls.companyconcept_url(k, F.lit("srt"), F.lit("T")).alias("concept"), urls.submissions_url(k).alias("submissions"), urls.filing_dir(k, accession).alias("dir"),
        urls.instance_name(F.when(F.col("k") % 2 == 0, "a.htm").otherwise("a.pdf")).alias("instance"), urls.document_path("/c/", accession, F.lit("a.htm")).alias("path"), urls.fiscal_year(F.lit("2023-12-31")).alias("year"),
        urls.qualified_tag(F.when(F.col("k") % 2 == 0, "srt"), F.when(F.col("k") % 3 != 0, "T")).alias("tag"),
    )


@query
def scalar_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Searchable values, halves of a last place, names for comparison, wrapper forms."""
    k = F.col("k")
    shown = F.when(k % 3 == 0, F.concat(k.cast("string"), F.lit(".25"))).when(k % 3 == 1, F.format_number(k * 1000, 0)).otherwise("n/a")
    return _suppliers(spark, sf_dir).select(
        "k", text.searchable(k.cast("double")).alias("searchable"), units.half_last_place(shown, F.lit(3)).alias("half"), names.company_name(F.concat(F.lit("The "), "name", F.lit(" Oil-Co., Inc."))).alias("name"),
        identity.is_wrapper(F.when(k % 2 == 0, "40-F/A").otherwise("10-K")).alias("wrapper"), crosscheck.is_model_made(F.when(k % 2 == 0, "llm:x").otherwise("xbrl")).alias("model_made"),
        reports.unambiguous(k % 6).alias("unambiguous"), reports.confident(F.when(k % 2 == 0, "inline").otherwise("header"), k % 80).alias("confident"),
        reports.header_agrees(F.when(k % 4 != 0, F.lit("column: Total (MBoe); row: x")), F.when(k % 3 == 0, "TOTAL").when(k % 3 == 1, "Oil")).alias("header"),
    )


@query
def domiciles(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("k")
    state, described = F.when(k % 5 == 0, "TX").when(k % 5 == 1, "A0").when(k % 5 == 2, ""), F.when(k % 5 == 0, "TX").when(k % 5 == 1, "Alberta, Canada")
    foreign, country = identity.domicile(state, described, F.when(k % 5 >= 3, F.when(k % 2 == 0, "DE").otherwise("X0")), F.when(k % 5 >= 3, F.when(k % 2 == 0, "DE").otherwise("Oslo, Norway")))
    return _suppliers(spark, sf_dir).select("k", foreign.alias("is_foreign"), country.alias("country"))


@query
def registry_ranks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facts by concept and unit with the unit's rank in the registry, that behind all others where it is not listed."""
    facts = served(spark, sf_dir).fact.withColumn("unit", F.when(F.col("product_key") == "ngl", "gallons").otherwise(F.col("unit")))
    ranked = facts.select("concept_key", "unit").join(F.broadcast(units_frame(spark)), ["concept_key", "unit"], "left").join(F.broadcast(concepts_frame(spark)), "concept_key")  # the registry
    return ranked.groupBy("concept_key", "unit", F.coalesce("unit_rank", "n_units").alias("unit_rank")).agg(F.count("*").alias("n"))


@query
def predecessor_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("k")
    who = _text("Old Petro ", k)
    notice = (
        F.when(k % 5 == 0, _text("On May 1, 2024, ", who, ", a Delaware corporation and the predecessor registrant, merged"))
        .when(k % 5 == 1, _text("the predecessor registrant, ", who, ", and others")).when(k % 5 == 2, _text("as successor issuer to the ", who, " under Rule 12g-3"))
        .when(k % 5 == 3, _text("in which ", who, ", Inc., a Texas limited liability company and the predecessor registrant")).otherwise("nothing of the kind")
    )
    return _suppliers(spark, sf_dir).select("k", succession.predecessor_name(notice).alias("predecessor"))


@query
def successions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Notices that name another supplier, themselves or a name that two share."""
    rows = _suppliers(spark, sf_dir)
    k = F.col("k")
    cik = F.lpad(k.cast("string"), 10, "0")
    filings = rows.select(cik.alias("cik"), F.when(k % 2 == 0, succession.NOTICE).otherwise("10-K").alias("form"), _text("n", k).alias("accession"), F.lit("2024-01-01").alias("filed_date"), F.lit(0).alias("ordinal"))
    who = F.when(k % 8 == 0, _text("Firm ", k)).when(k % 8 == 2, F.lit("Firm Twin")).otherwise(_text("Firm ", k + 1))
    notices = rows.where(k % 2 == 0).select(_text("n", k).alias("accession"), _text("<p>the predecessor registrant, ", who, ", and others</p>").alias("html"))
    filers = rows.select(cik.alias("cik"), F.when(k <= 2, F.lit("Firm Twin")).otherwise(_text("Firm ", k, ", Inc.")).alias("name"))
    found = succession.successions(filings, notices, filers)
    return succession.follow(filings.select("cik"), found).join(found.select("cik", "status", "note"), "cik")


@query
def needing_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = served(spark, sf_dir)
    return succession.needing_history(s.company, s.fact.where(F.col("cik").cast("long") % 3 != 0)).select("cik", "name")


@query
def renamed_issuers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers of which every third is the former name of the one before it."""
    k = F.col("k")
    p = _suppliers(spark, sf_dir).select(
        F.lpad(k.cast("string"), 10, "0").alias("cik"), _text("Firm ", k, " Corp").alias("name"), F.array().cast("array<string>").alias("tickers"),
        F.when(k % 3 == 1, F.array(_text("FIRM ", k + 1))).otherwise(F.array().cast("array<string>")).alias("former_names"), F.when(k % 2 == 0, "2020-01-01").alias("latest_annual"), (k % 5).cast("int").alias("annual_count"),
    )
    work_folder(spark)  # sets the checkpoint folder where the session has none
    return identity.issuer_groups(p, lambda df: df.checkpoint()).select("cik", "issuer", "is_primary")


# Writes
@query
def snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two coverage snapshots, counted by when they were taken."""
    cover = counts.coverage_matrix(served(spark, sf_dir)).select("cik", "concept_key", "cells")
    old = cover.withColumn("taken_at", F.lit("2024-01-01"))
    return writes.append_snapshot(old, cover.where("cells > 2"), F.lit("2024-02-01")).groupBy("taken_at").agg(F.count("*").alias("n"), F.sum("cells").alias("cells"))


@query
def replaced_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdicts of some facts are replaced, those of others are new, and the rest stay."""
    s = served(spark, sf_dir)
    new = s.fact.where(F.col("concept_key") == DEVELOPED).select(F.col("id").alias("fact_id"), F.lit("again").alias("status"))
    return writes.replace_by_key(s.verification, new, ("fact_id",)).groupBy("status").agg(F.count("*").alias("n"), F.count("document").alias("documents"))


@query
def cleared_scale(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = served(spark, sf_dir)
    return writes.clear_scale(s.scale, s.fact.where("unit = 'MMcfe'")).agg(F.count("*").alias("n"), F.round(F.max("canonical_value"), 2).alias("most"))


@query
def resectioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = served(spark, sf_dir)
    old = s.verification.select("fact_id", F.when(F.col("status") == "found", "Item 2. Properties").alias("section"))
    sections = s.fact.where("unit = 'MBoe'").select(F.col("id").alias("fact_id"), F.when(F.col("product_key") != "oil", "Item 7. Results").alias("section"))
    return writes.changed_sections(old, sections).groupBy("section").agg(F.count("*").alias("n"))


@query
def backfilled_filings(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("accession").cast("long")
    filing = served(spark, sf_dir).filing.select("accession", F.when(n % 2 == 0, "1995-12-31").alias("period_end"), F.when(n % 3 == 0, "kept.htm").alias("primary_doc"))
    given = filing.where(n % 5 != 0).select("accession", F.when(n % 7 == 0, "").otherwise("1996-12-31").alias("period_end"), _text("d", n, ".htm").alias("primary_doc"))
    return writes.backfill_filings(filing, given)


@query
def copied_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Companies under a schema with a column that they lack and without some that they have."""
    from pyspark.sql.types import StructType

    return writes.copy_columns(served(spark, sf_dir).company, StructType.fromDDL("cik string, name string, disclosure_regime string, is_operator boolean"))


@query
def store_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The published store with every tenth company and every eleventh filing left out."""
    s = served(spark, sf_dir)
    n = F.col("accession").cast("long")
    return writes.faults(s.replaced(company=s.company.where(F.col("cik").cast("long") % 10 != 0), filing=s.filing.where(n % 11 != 0)))


@query
def coherent_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facts without the tags of periods whose identity does not hold."""
    s = served(spark, sf_dir)
    values = validation.candidate_values(s.dated().select("cik", "concept_key", "tag", "unit", "period_end", F.col("filed_date").alias("filed"), F.col("id").alias("ordinal"), "value", F.lit(1).alias("alias_ord")))
    rejected = validation.rejected_periods(validation.tag_triples(values), validation.validate_family(values, s.fact.select("cik"))).distinct()
    return validation.drop_incoherent(s.fact, rejected).groupBy("concept_key", "unit").agg(F.count("*").alias("n"))


@query
def alias_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdicts as they are stored; companies of every fifth number have no total, and so no choice."""
    s = served(spark, sf_dir)
    facts = s.dated().where((F.col("concept_key") != TOTAL) | (F.col("cik").cast("long") % 5 != 0))
    values = validation.candidate_values(facts.select("cik", "concept_key", "tag", "unit", "period_end", F.col("filed_date").alias("filed"), F.col("id").alias("ordinal"), "value", F.lit(1).alias("alias_ord")))
    return validation.records(validation.validate_family(values, s.company.select("cik"))).select("cik", "family", "concept_key", "tag", "status", "note")


@query
def empty_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of what comes in, before it is a store: nothing is published for it."""
    s = tpch_store(spark, sf_dir)
    return payloads.empty_payloads(s.fact.where(F.col("cik").cast("long") % 4 != 0), s.company)


@query
def resolved_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scale.resolve_tables(served(spark, sf_dir).fact.select("id", (F.col("value") * F.when(F.col("product_key") == "gas", 1e6).otherwise(1.0)).alias("value"), "unit")).groupBy("canonical_unit", "conversion_note", "basis").agg(F.count("*").alias("n"), F.round(F.max("canonical_value"), 2).alias("most"))


@query
def interval_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each event of a user the order-like interval that holds it, else the nearest: signups open one of three days,
    purchases one of an hour, which lie inside of others, and between them."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet").select("user_id", "event_id", "event_type", F.unix_seconds(F.col("ts").cast("timestamp")).alias("at"))
    hours = F.when(F.col("event_type") == "signup", 72).otherwise(1)
    span = F.struct(F.col("event_id").alias("id"), F.col("at").alias("s"), (F.col("at") + hours * 3600).alias("e"))
    spans = events.where("event_type in ('signup', 'purchase')").select("user_id", span.alias("span")).select("user_id", "span.s", "span.e", "span")
    found = clusters.interval_of(events.select("user_id", "event_id", "at"), spans, ["user_id"], "at", "s", "e", "span")
    # An event whose id stands in several rows is one: it has the best of what they find.
    at, s, e = (F.col(c) for c in ("at", "span.s", "span.e"))
    inside = F.coalesce(at.between(s, e), F.lit(False))
    order = (~inside, F.when(inside, -s).otherwise(F.least(F.abs(at - s), F.abs(at - e))), F.when(inside, -e).otherwise(s))
    first = F.struct(*[x for i, o in enumerate(order) for x in (o.isNull().alias(f"no{i}"), o.alias(f"by{i}"))], F.col("span.id").isNull().alias("none"), F.col("span.id").alias("span_id"))
    return found.groupBy("event_id").agg(F.min(first).alias("first")).select("event_id", "first.span_id")


# Reports
@query
def outcome_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return answers.outcomes(served(spark, sf_dir).verification, "status")


@query
def coverage_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return answers.coverage_totals(_coverage(spark, sf_dir), "1997-12-31")


def _coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = counts.coverage_matrix(served(spark, sf_dir)).where("concept_key is not null")
    return rows.select("cik", "concept_key", (F.col("cells") > 1).alias("tagged"), "latest_period")


@query
def company_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.company_coverage(_coverage(spark, sf_dir), "1998-12-31")


@query
def admission_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    from factloom.catalogue import QUERIES as CORE

    return reports.admission_report(CORE["admission"](spark, sf_dir))


@query
def producer_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Phrases over documents of companies, beside the concepts that they have facts of."""
    s = served(spark, sf_dir)
    n = F.col("doc_id")
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet").select(F.lpad((n % 7 + 1).cast("string"), 10, "0").alias("cik"), n.cast("string").alias("name"), "text")
    found = answers.producer_evidence(s.fact.where(F.col("cik").cast("long") <= 9), documents, (TOTAL, DEVELOPED), lambda c: text.phrases_count(c, ("the", "and")))
    return found.select("cik", F.array_join("concepts", ",").alias("concepts"), "hits", "documents", "best")


@query
def alias_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = served(spark, sf_dir)
    n = F.col("cik").cast("long")
    status = F.when(n % 3 == 0, "drifted").when(n % 3 == 1, "incoherent").otherwise("validated")
    chosen = F.explode(F.array(*[F.struct(F.lit(k).alias("concept_key"), F.lit(t).alias("tag")) for k, t in (("b", "T2"), ("a", "T1"))])).alias("c")
    rows = s.company.select("cik", status.alias("status"), (n % 4).alias("coherent_periods"), F.lit(5).cast("long").alias("tested_periods"), F.lit(0.5).alias("median_error"), chosen).select("*", "c.*").drop("c")
    return quality.alias_verdicts(s, rows).select("cik", "name", "status", "coherent_periods", "chosen")


@query
def second_look(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = served(spark, sf_dir)
    page = F.length("document") % 9
    v = s.verification.select("fact_id", "status", F.when(page > 0, page).alias("page"), F.col("document").alias("printed"), F.when(F.length("document") % 2 == 0, F.lit("MBoe")).alias("units_nearby"))
    basis = s.scale.select("fact_id", F.when(F.col("canonical_value") > 1e7, "unit read as Mcf").otherwise("as printed").alias("basis"))
    return reports.second_look(v, basis, 5)


@query
def look_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("k")
    rows = _suppliers(spark, sf_dir).select(_text("g", k % 3).alias("sample_group"), F.when(k % 7 != 0, k % 2 == 0).alias("value_present"), F.when(k % 5 != 0, k % 3 == 0).alias("agree_header"), F.when(k % 4 != 0, k % 3 != 0).alias("agree_folio"))
    return reports.look_summary(rows)


@query
def history_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = series.history_nested(served(spark, sf_dir), CIK, TOTAL)
    return rows.select("product_key", "unit", "label", F.size("points").cast("long").alias("points"), F.array_join(F.transform("points", lambda p: F.concat_ws(":", p["period"], p["accession"])), ",").alias("path"))


@query
def coverage_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = counts.coverage_nested(served(spark, sf_dir))
    return rows.select("cik", F.size("concepts").cast("long").alias("n"), F.array_join(F.transform(F.array_sort(F.map_keys("concepts")), lambda c: F.concat_ws("=", c, F.col("concepts")[c]["latest_period"])), ",").alias("concepts"))


@query
def event_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The windowed counts of the stream, over the same events at rest."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet").select(F.col("ts").cast("timestamp").alias("ts"), "event_type", "value")
    return watch.event_counts(events).select(F.unix_seconds("window.start").alias("start"), "event_type", "n", F.round("total", 2).alias("total"))


@query
def service_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The panel asked for by name and parameters."""
    own = service.Service(lambda: served(spark, sf_dir), lambda: 0)
    return own.plan("panel", {"concept": TOTAL, "period": PERIOD, "product": "oil", "cohort": ""}).select("id", "cik", "unit", "value", "position")


@query
def service_questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many rows some questions have."""
    own = service.Service(lambda: served(spark, sf_dir), lambda: 0)
    asked = (("concepts", {}), ("periods", {"concept": TOTAL}), ("companies", {}), ("history", {"cik": CIK, "concept": TOTAL}), ("coverage", {"cohort": "Oil & Gas E&P"}), ("unreached", {}))
    frames = [own.plan(name, p).agg(F.count("*").alias("n")).select(F.lit(name).alias("question"), "n") for name, p in asked]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


@query
def stem_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many documents hold each regular form of some words."""
    words = ("price", "plan", "the", "reserve")
    forms = spark.createDataFrame([(w, f) for w in words for f in stems.forms(w)], "word string, form string")
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    held = documents.select("doc_id", F.explode(F.array_distinct(phrase_index.terms_of(F.col("text")))).alias("form"))
    counted = held.join(F.broadcast(forms), "form").groupBy("word", "form").agg(F.count("*").alias("n"))
    return forms.join(counted, ["word", "form"], "left").where(F.col("form").isin(*words, "prices", "priced", "plans", "planned", "planning", "reserves", "reserved")).select("word", "form", F.coalesce("n", F.lit(0)).alias("n"))


# Sources, writes and readers that no other query passes through
@query
def filers_of_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages of filers by code and form, kept as files, the last of each list repeated; each filer where it comes first."""
    k = F.col("k")
    rows = _suppliers(spark, sf_dir).select("k", F.when(k % 2 == 0, "1311").otherwise("6792").alias("sic"), F.explode(F.when(k % 4 != 0, F.array(F.lit("10-K"), F.lit("20-F"))).otherwise(F.array(F.lit("20-F")))).alias("form"), (F.floor(k / 30) * 100).cast("int").alias("start"))
    pages = rows.groupBy("sic", "form", "start").agg(F.array_join(F.transform(F.array_sort(F.collect_list("k")), lambda n: _text("<CIK> ", n, " </CIK>")), " and ").alias("text"))
    last = Window.partitionBy("sic", "form").orderBy(F.desc("start"))
    again = pages.withColumn("rn", F.row_number().over(last)).where("rn = 1").drop("rn").withColumn("start", F.col("start") + 100)
    folder = work_path(spark, "pages")
    archive.write_pages(pages.unionByName(again), folder)
    return archive.filers(archive.listed(spark, folder), ("10-K", "20-F"))


@query
def candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("k")
    profiles = _suppliers(spark, sf_dir).select(F.lpad(k.cast("string"), 10, "0").alias("cik"), F.when(k % 3 == 0, "1311").when(k % 3 == 1, "6792").otherwise("9999").alias("sic"), F.when(k % 4 == 1, "2019-03-01").when(k % 4 != 0, "2024-03-01").alias("latest_annual"))
    return payloads.enumerate_candidates(profiles, ("1311", "6792"), "2023-01-01", profiles.where(F.col("cik").cast("long") % 11 == 0)).select("cik", "sic")


@query
def basis_notes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Notes on concepts, of which those of some companies are replaced by new ones, of one or several rows."""
    k, rows = F.col("k"), _suppliers(spark, sf_dir)
    note = lambda text, concept: rows.select(F.lpad(k.cast("string"), 10, "0").alias("cik"), F.lit(concept).alias("concept_key"), _text(text, k).alias("note"))
    new = note("new ", TOTAL).where(F.col("cik").cast("long") % 3 == 0)
    old = note("old ", TOTAL).unionByName(note("kept ", DEVELOPED))
    return writes.replace_by_key(old, new.unionByName(new.withColumn("note", F.lit("second")).where(F.col("cik").cast("long") % 2 == 0)), ("cik", "concept_key"))


def _seen(rows: DataFrame, tag: Column, unit: Column) -> DataFrame:
    """Observations of suppliers: one of a tag and a unit each."""
    fields = {"taxonomy": "us-gaap", "start": None, "end": "2023-12-31", "accn": "a", "fp": "FY", "form": "10-K", "filed": "2024-02-20", "frame": None}
    own = rows.select(F.lpad(F.col("k").cast("string"), 10, "0").alias("cik"), tag.alias("tag"), unit.alias("unit"), F.col("d").cast("double").alias("val"), F.lit(0).alias("ordinal"), F.lit(2023).alias("fy"))
    return own.withColumns({name: F.lit(v).cast("string") for name, v in fields.items()})


@query
def overridden_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tag of each filer's spending: the first in the registry's order that it has, unless another is given."""
    rows, k = _suppliers(spark, sf_dir), F.col("k")
    first, second = "PaymentsToAcquireOilAndGasProperty", "PaymentsToAcquirePropertyPlantAndEquipment"
    obs = _seen(rows.where(k % 2 == 0), F.lit(first), F.lit("USD")).unionByName(_seen(rows, F.lit(second), F.lit("USD")))
    given = rows.where(k % 3 == 0).select(F.lpad(k.cast("string"), 10, "0").alias("cik"), F.lit("capex").alias("concept_key"), F.lit(second).alias("tag"))
    return payloads.fact_rows(obs, overrides=given).select("cik", "concept_key", "tag", "value")


@query
def products_of_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prices whose unit names their product, and the rank of the unit."""
    k = F.col("k")
    unit = F.when(k % 4 == 0, "USD/Mcf").when(k % 4 == 1, "USD/bbl").when(k % 4 == 2, "USD/MMBtu").otherwise("USD")
    return payloads.fact_rows(_seen(_suppliers(spark, sf_dir), F.lit("AverageSalesPrices"), unit)).select("cik", "unit", "product", "unit_rank")


@query
def facts_in_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = served(spark, sf_dir)
    rows = s.dated().withColumnRenamed("filed_date", "filed").withColumn("ordinal", F.lit(0))
    return payloads.in_order(rows).select("cik", "concept_key", "period_end", "product_key", "unit_rank", "filed", "accession", "seq")


@query
def nearby_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The units around figures found in the text, nearest first."""
    own = _reports(spark, sf_dir)
    facts = own.select(_text("t", F.col("k")).alias("id"), "accession", F.lit(None).cast("string").alias("tag"), F.lit("2023-12-31").alias("period_end"), (F.col("d") + F.col("u")).cast("double").alias("value"), F.lit(None).cast("string").alias("product"))
    return readers.verify(facts, _corpus(spark, sf_dir)).where("status = 'found'").select("fact_id", F.array_join("units_nearby", ",").alias("units"))


@query
def other_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reserves of reports of three other kinds: balances at both ends of a year, parts of developed reserves, regions
    with a total; and a table whose columns cannot be told apart, of which nothing is read."""
    k, printed = F.col("k"), lambda c: F.format_number(c, 0)
    d, u = F.col("d"), F.col("u")
    balances = _text("<p>For the year ended December 31, 2023</p>", _table(
        _row("", "Oil", "Total"), _row("(MBbls)", "(MBoe)"), _row("Total proved reserves:"), _row("Beginning of year", printed(d), printed(d + 5)), _row("Production", "(5)", "(6)"), _row("End of year", printed(u), printed(u + 6)),
        _row("Proved developed reserves:"), _row("Beginning of year", printed(d - 7), printed(d - 2)), _row("End of year", printed(u - 7), printed(u - 1)),
    ))
    parts = _text("<p>December 31, 2024</p>", _table(_row("", "Oil (MBbls)", "Total (MBoe)"), _row("Proved developed producing", printed(d), printed(d + 10)), _row("Proved developed non-producing", "5", "6"), _row("Proved undeveloped", "7", "9")))
    regions = _text(
        _table(_row("Oil (Bbls)"), _row("", "Canada", "United States", "Total"), _row("Proved developed reserves, December 31, 2022", printed(d), printed(u), printed(d + u))),
        _table(_row("", "A (MBoe)", "B (MBoe)"), _row("Total proved", printed(d), printed(u))),
    )
    raw = F.when(k % 3 == 0, balances).when(k % 3 == 1, parts).otherwise(regions)
    corpus = _filers(spark, sf_dir).select(_text("acc-", k).alias("accession"), F.lit("r.htm").alias("name"), raw.alias("raw"), F.lit("2020-12-31").alias("fallback_period"))
    return readers.reserve_readings(corpus).select("accession", "concept_key", "product", "value", "unit", "period_end")


@query
def scale_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("k")
    found, declared = scale.scale_source(F.when(k % 2 == 0, "table:reserves").otherwise("xbrl"), F.col("d").cast("double"), F.when(k % 3 == 0, 0).when(k % 3 == 1, 3).cast("int"))
    return _suppliers(spark, sf_dir).select("k", found.alias("scale"), declared.alias("declared"))


@query
def people_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Companies written as one CSV file and read again; lists are joined by bars."""
    folder = work_path(spark, "csv")
    k = F.col("k")
    rows = _suppliers(spark, sf_dir).select(_text("c", k).alias("cik"), "name", F.array(_text("A", k), _text("B", k)).alias("tickers"), F.when(k % 2 == 0, "x, \"y\"").alias("note"))
    writes.write_csv(rows, folder, "cik")
    read = spark.read.csv(folder, header=True)
    return read.select("cik", "name", "tickers", "note", F.lit(len(read.inputFiles())).alias("files"))


@query
def published_anew(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A store published to a new folder: rows by relation, and whether a second one is refused there."""
    folder, store = work_path(spark, "store"), served(spark, sf_dir)
    writes.publish(store, folder, checked=False)
    try:
        writes.publish(store, folder, checked=False)
        refused = False
    except AnalysisException as e:
        refused = "ALREADY_EXISTS" in str(e)
    again = open_store(spark, folder)
    rows = [getattr(again, name).agg(F.count("*").alias("n")).select(F.lit(name).alias("relation"), "n", F.lit(refused).alias("refused")) for name in TABLES]
    return reduce(DataFrame.unionByName, rows)


@query
def hit_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with phrases: lines too long for a label, and those of several clusters of labels."""
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = sites.documents(sites.document_lines(documents), documents.select(F.col("doc_id").alias("document_id"), "lang"), TEST_SPEC)
    return found.select("document_id", "lang", "prose_hits", F.coalesce("n_sites", F.lit(0)).alias("n_sites"))


@query
def views_of_an_older_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SQL over the named views of a store that was written without some columns, form and date of the facts among them."""
    folder, s = work_path(spark, "store"), served(spark, sf_dir)
    gone = {"fact": ("form", "filed_date", "extracted_by"), "company": ("cohort",), "verification": ("document",)}
    for name in TABLES:
        getattr(s, name).drop(*gone.get(name, ())).write.parquet(f"{folder}/{name}")
    views.register(open_older(spark, folder), "older_")
    return spark.sql("""
        SELECT f.form, f.unit, count(*) AS n, count(f.extracted_by) AS extracted, count(c.cohort) AS in_cohort, max(f.filed_date) AS latest
        FROM older_fact_current f JOIN older_company c ON c.cik = f.cik GROUP BY f.form, f.unit""")


@query
def resolution_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many rows came to each outcome, counted while the resolved rows were written."""
    resolved = scale.resolve(scale_rows(served(spark, sf_dir)))
    _, seen = kept_with(resolved, "resolved", **{s: F.count_if(F.col("status") == s) for s in ("resolved", "ambiguous", "unavailable")})
    return spark.createDataFrame([(s, n) for s, n in seen.items() if n], "status string, n long")


#: Facts of one file of a delivery, about.
DELIVERED_FACTS = 500_000


@query
def current_from_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The current facts after they came in three deliveries, newer filings before older ones; a delivery is as many files
    as its facts ask for, and one batch."""
    source, target, state = (work_path(spark, n) for n in ("arriving", "current", "state"))
    facts = served(spark, sf_dir).dated()
    files = max(1, -(-facts.count() // (3 * DELIVERED_FACTS)))
    for part in (2, 0, 1):
        facts.where(F.pmod(F.crc32("id"), F.lit(3)) == part).repartition(files, "cik", "id").write.mode("append").parquet(source)
    current.keep_current(spark, source, facts.schema.simpleString()[7:-1].replace(":", " "), target, state, files_a_batch=files, part_rows=10_000).awaitTermination()
    return merges.read(spark, target).select(*VIEW)
