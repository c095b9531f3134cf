"""DataFrame forms of the document readers: one pass over each document's source, in Arrow batches.

A corpus is (accession, name, raw). A document is read in one task; nothing crosses documents.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import astuple

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factloom.documents import evidence, grid, layout, markup, production, reserves
from factloom.functions.names import base_form
from factloom.registry import DEVELOPED, TOTAL, UNDEVELOPED, concepts_frame, units_frame
from factloom.session import kept

# The tags under which volumes by product are taken from inline markup, by concept.
VOLUME_TAGS = {
    TOTAL: ("srt:ProvedDevelopedAndUndevelopedReservesNet", "srt:ProvedDevelopedAndUndevelopedReserveNetEnergy", "us-gaap:ProvedDevelopedAndUndevelopedReservesNet"),
    DEVELOPED: ("srt:ProvedDevelopedReservesBOE1", "srt:ProvedDevelopedReservesVolume", "us-gaap:ProvedDevelopedReservesVolume"),
    UNDEVELOPED: ("srt:ProvedUndevelopedReserveBOE1", "srt:ProvedUndevelopedReserveVolume", "us-gaap:ProvedUndevelopedReserveBOE1"),
    production.VOLUME: ("srt:ProvedDevelopedAndUndevelopedReserveProductionEnergy", "srt:ProvedDevelopedAndUndevelopedReservesProduction", "us-gaap:ProvedDevelopedAndUndevelopedReserveProductionEnergy"),
}

LINES = "accession string, name string, page int, line_no int, section string, char_offset long, raw_start long, raw_end long, text string"
CELLS = "accession string, name string, table_index int, table_start long, row int, column int, text string, header string, row_label string"
FIGURES = "accession string, name string, concept string, shown string, value double, scale int, unit string, product string, member string, period_end string, period_start string, element_id string, start long, end long"
RESERVES = "accession string, name string, concept_key string, product string, value double, unit string, period_end string, table_index int, row_label string, source_span string, char_offset long"
PRODUCTION = "accession string, name string, concept_key string, product string, value double, unit string, period_end string, is_hedged boolean, table_index int, row_label string, source_span string, char_offset long"
TABLES = "accession string, name string, table_index int, period_end string, implied double, cells string, closes boolean"
#: Documents that one task verifies.
TASK_DOCUMENTS = 250
VERDICTS = "fact_id string, status string, method string, document string, printed string, scale_found double, scale_declared int, hits int, page int, line_no int, section string, anchor string, source_span string, units_nearby array<string>"


def _each(corpus: DataFrame, rows: Callable[[dict], list[tuple]], schema: str, columns: list[str]) -> DataFrame:
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for record in pdf.to_dict("records"):
                made = rows(record)
                if made:
                    yield pd.DataFrame([(record["accession"], record["name"], *r) for r in made], columns=names)

    return corpus.select(*columns).mapInPandas(run, schema)


def lines(corpus: DataFrame) -> DataFrame:
    """Every line with its page, heading and offsets."""

    def rows(d: dict) -> list[tuple]:
        page = layout.read(d["raw"])
        return [(x.page, x.number, page.section_at(x.start), x.start, x.raw_start, x.raw_end, x.text) for x in page.lines]

    return _each(corpus, rows, LINES, ["accession", "name", "raw"])


def cells(corpus: DataFrame) -> DataFrame:
    """Every cell of tables with figures. Documents without a table are left out before Python sees them."""
    return _each(corpus.where(F.col("raw").rlike("(?i)<table")), lambda d: [(g.index, g.start, *c) for g in grid.grids(d["raw"]) for c in g.cells()], CELLS, ["accession", "name", "raw"])


def figures(corpus: DataFrame, tags: tuple[str, ...] | None = None) -> DataFrame:
    wanted = set(tags) if tags is not None else None
    return _each(corpus.where(F.col("raw").rlike("(?i)<ix:nonFraction")), lambda d: [astuple(f) for f in markup.figures(d["raw"], wanted)], FIGURES, ["accession", "name", "raw"])


def reserve_readings(corpus: DataFrame) -> DataFrame:
    """corpus may have fallback_period. Documents that do not say proved are left out before Python sees them."""
    own = corpus if "fallback_period" in corpus.columns else corpus.withColumn("fallback_period", F.lit(None).cast("string"))
    return _each(own.where(F.col("raw").rlike("(?i)proved")), lambda d: [astuple(r) for r in reserves.readings(d["raw"], d["fallback_period"])], RESERVES, ["accession", "name", "raw", "fallback_period"])


def production_readings(corpus: DataFrame) -> DataFrame:
    return _each(corpus.where(F.col("raw").rlike("(?i)production|price|LOE|lease")), lambda d: [astuple(r) for r in production.readings(d["raw"])], PRODUCTION, ["accession", "name", "raw"])


def production_tables(corpus: DataFrame) -> DataFrame:
    """(accession, name, table_index, period_end, implied, cells, closes): what each table of production says of a
    period: volumes times prices, a digest of its cells, and whether products add up to the total (null if untold)."""

    def rows(d: dict) -> list[tuple]:
        out = []
        tables: dict[int, list[production.Reading]] = {}
        for r in production.readings(d["raw"]):
            tables.setdefault(r.table_index, []).append(r)
        for index, found in tables.items():
            cells = hashlib.md5(repr(sorted(production.cells_of(found), key=repr)).encode()).hexdigest()
            closed = production.volumes_close(found)
            out += [(index, p, production.implied_revenue(found, p), cells, closed.get(p)) for p in sorted({r.period_end for r in found})]
        return out

    return _each(corpus.where(F.col("raw").rlike("(?i)production|price|LOE|lease")), rows, TABLES, ["accession", "name", "raw"])


def primary_names(filings: DataFrame, corpus: DataFrame) -> DataFrame:
    """(accession, name): the document that a filing registers, else its largest readable one that is no exhibit."""
    sized = corpus.select("accession", "name", F.octet_length("raw").alias("size")).where(F.lower("name").rlike(r"\.html?$")).join(filings.select("accession", "primary_doc"), "accession")
    named = F.col("name").eqNullSafe(F.col("primary_doc"))
    fit = sized.where(named | ~F.contains(F.lower("name"), F.lit("ex")))
    return fit.groupBy("accession").agg(F.max_by("name", F.struct(F.coalesce(named, F.lit(False)).alias("a"), F.col("size"), F.col("name"))).alias("name"))


def product_volumes(filings: DataFrame, corpus: DataFrame) -> DataFrame:
    """Fact rows of the volumes that annual reports mark up by product. Figures without a product come with the payloads
    and are left out here. filings: accession, cik, form, filed_date, primary_doc."""
    annual = filings.where(base_form(F.col("form")) == "10-K")
    own = corpus.join(primary_names(annual, corpus), ["accession", "name"], "left_semi")
    concept = F.create_map(*[F.lit(x) for key, tags in VOLUME_TAGS.items() for tag in tags for x in (tag, key)])
    found = figures(own, tuple(t for tags in VOLUME_TAGS.values() for t in tags)).where(F.col("product").isNotNull())
    spark = filings.sparkSession
    rows = found.withColumn("concept_key", concept[F.col("concept")]).join(annual.select("accession", "cik", "form", "filed_date"), "accession")
    ranked = rows.join(F.broadcast(concepts_frame(spark).select("concept_key", "n_units")), "concept_key").join(F.broadcast(units_frame(spark)), ["concept_key", "unit"], "left")  # the registry
    return ranked.select(
        "cik", "concept_key", F.substring_index("concept", ":", 1).alias("taxonomy"), F.substring_index("concept", ":", -1).alias("tag"), "value", "unit", "product",
        F.coalesce("unit_rank", "n_units").alias("unit_rank"), "period_start", "period_end", F.substring("period_end", 1, 4).cast("int").alias("fiscal_year"), F.lit("FY").alias("fiscal_period"),
        "accession", "form", F.col("filed_date").alias("filed"), F.lit("xbrl:inline").alias("extracted_by"), "start",
    )


def verify(facts: DataFrame, corpus: DataFrame) -> DataFrame:
    """A verdict for each fact: found in the markup, else in the text, of the first document of its filing that has it.

    facts: id, accession, tag, period_end, value, product. corpus: also doc_rank (0: the primary). Facts come to the
    documents of their filing, so each document is parsed once; of the verdicts of one fact the best is kept. Both are dealt
    over as many tasks as the counted documents ask for: by their bytes, which pack well, they would be few.
    """
    tasks = max(1, -(-corpus.count() // TASK_DOCUMENTS))
    asked = facts.repartition(tasks, "accession").groupBy("accession").agg(F.collect_list(F.struct("id", "tag", "period_end", "value", "product")).alias("facts"))
    met = corpus.repartition(tasks, "accession").join(asked, "accession").select("name", "raw", "doc_rank", "facts")
    names = [c.split()[0] for c in VERDICTS.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for name, raw, rank, wanted in zip(pdf["name"], pdf["raw"], pdf["doc_rank"], pdf["facts"], strict=True):
                page, marked = layout.read(raw), markup.figures(raw)
                numbers = evidence.Numbers(page.text)
                out = [(*_verdict(f, name, page, marked, numbers), rank) for f in wanted]
                yield pd.DataFrame(out, columns=[*names, "doc_rank"])

    found = met.mapInPandas(run, VERDICTS + ", doc_rank int")
    order = F.struct(F.when(F.col("status") == "found", 0).when(F.col("status") == "unverifiable", 1).otherwise(2), F.col("doc_rank"), F.col("document"))
    best = found.groupBy("fact_id").agg(F.min_by(F.struct(*[c for c in names if c != "fact_id"]), order).alias("b")).select("fact_id", "b.*")
    return facts.select(F.col("id").alias("fact_id")).join(best, "fact_id", "left").withColumn("status", F.coalesce("status", F.lit("unavailable")))


def _verdict(f: dict, name: str, page: layout.Layout, marked: list[markup.Figure], numbers: evidence.Numbers) -> tuple:
    figure = markup.match(marked, f["tag"], f["period_end"], f["value"], f["product"])
    if figure is not None:
        line = page.line_at_raw(figure.start)
        where = (line.page, line.number, page.section_at(line.start), line.text) if line else (None, None, None, None)
        return f["id"], "found", "markup", name, figure.shown, float(10.0**figure.scale), figure.scale, 1, *where[:3], figure.element_id and f"#{figure.element_id}", where[3], []
    if not evidence.searchable(f["value"]):
        return f["id"], "unverifiable", None, name, *[None] * 9, []
    hit = evidence.find_value(page, f["value"], numbers)
    if hit is None:
        return f["id"], "not_found", None, name, *[None] * 9, []
    return f["id"], "found", "text", name, hit.printed, hit.scale, None, hit.hits, hit.page, hit.line, hit.section, None, hit.source_span, list(hit.units)


def match_figures(facts: DataFrame, found: DataFrame) -> DataFrame:
    """(fact_id, name, shown, value, element_id, start): for each fact and document of its filing the marked-up figure of
    its concept and period that is as near as printing rounds; one of its product first, then the earliest.

    facts: id, accession, tag, period_end, value, product; found: `figures`. A join with a tolerance: figures lie in bins as
    wide as their last printed place (or a hundredth of their size, where that is not to be read), and a fact looks into its
    bin of each width in use and those beside it, so that only values near to each other meet. Widths are powers of ten, a
    few dozen at most. The figures are kept, as the widths are asked for first and documents are read once."""
    found = kept(found, "figures")
    digits = F.ltrim(F.regexp_replace(F.trim("shown"), "[,()]", ""), F.lit("-"))
    readable = digits.rlike(r"^([0-9]+\.?[0-9]*|\.[0-9]+)$")
    decimals = F.length(F.split_part(digits, F.lit("."), F.lit(2)))
    size = F.when(F.col("value") != 0, F.floor(F.log10(F.abs("value")))).otherwise(0)
    rows = found.withColumn("allowed", F.when(readable, F.lit(0.5) * F.pow(F.lit(10.0), -decimals) * F.pow(F.lit(10.0), F.col("scale"))))
    rows = rows.withColumn("place", F.when(readable, F.col("scale") - decimals).otherwise(size - 2).cast("int")).withColumn("tag", F.substring_index("concept", ":", -1))
    bin_of = lambda value, place: F.floor(value / F.pow(F.lit(10.0), place)).cast("double")
    placed = rows.withColumn("bin", bin_of(F.col("value"), F.col("place"))).select("accession", "name", "tag", "period_end", "place", "bin", "allowed", "shown", "start", "element_id", F.col("value").alias("printed"), F.col("product").alias("of"))
    places = sorted(r["place"] for r in rows.select("place").distinct().collect())
    own = [(F.lit(p).alias("place"), bin_of(F.col("value"), F.lit(p))) for p in places]
    probes = F.array(*[F.struct(p, (b + d).alias("bin")) for p, b in own for d in (-1.0, 0.0, 1.0)]) if places else F.array().cast("array<struct<place:int,bin:double>>")
    asked = facts.where("tag is not null").select("id", "accession", "tag", "period_end", "value", "product", F.explode(probes).alias("at")).select("*", "at.*").drop("at")
    apart = F.abs(F.col("printed") - F.col("value"))
    near = (F.col("printed") == F.col("value")) | (apart <= F.coalesce("allowed", F.lit(5e-4) * F.greatest(F.abs("printed"), F.abs("value"))))
    met = asked.join(placed, ["accession", "tag", "period_end", "place", "bin"]).where(near)
    order = F.struct(F.when(F.col("of").eqNullSafe(F.col("product")), 0).otherwise(1), "start")
    best = met.groupBy(F.col("id").alias("fact_id"), "name").agg(F.min_by(F.struct("shown", F.col("printed").alias("value"), "element_id", "start"), order).alias("b"))
    return best.select("fact_id", "name", "b.*")


def one_reading(readings: DataFrame, tolerance: float = 1e-6) -> DataFrame:
    """Readings of one cell that agree, as one row; a cell whose readings differ is dropped."""
    keys = ["accession", "concept_key", "product", "period_end", "unit"]
    first = F.struct("table_index", "char_offset", "row_label")
    grouped = readings.groupBy(*keys).agg(F.min_by("value", first).alias("value"), F.min("value").alias("low"), F.max("value").alias("high"), F.min_by("source_span", first).alias("source_span"))
    return grouped.where((F.col("high") - F.col("value") <= tolerance) & (F.col("value") - F.col("low") <= tolerance)).drop("low", "high")


def closes(readings: DataFrame, tolerance: float = 0.006) -> DataFrame:
    """(accession, period_end, product, closes): developed + undeveloped = total; null where a part is missing."""
    pick = lambda key: F.first(F.when(F.col("concept_key") == key, F.col("value")), ignorenulls=True)
    rows = one_reading(readings).groupBy("accession", "period_end", "product", "unit").agg(pick(reserves.DEVELOPED).alias("d"), pick(reserves.UNDEVELOPED).alias("u"), pick(reserves.TOTAL).alias("t"))
    return rows.select("accession", "period_end", "product", F.when(F.col("t") != 0, F.abs(F.col("d") + F.col("u") - F.col("t")) / F.abs("t") <= tolerance).alias("closes"))


def prefer_unhedged(prices: DataFrame) -> DataFrame:
    """One price of a (accession, product, period, unit): unhedged beats the rest, then the first printed."""
    keys = ["accession", "concept_key", "product", "period_end", "unit"]
    order = F.struct(F.when(F.col("is_hedged") == F.lit(False), 0).otherwise(1), "table_index", "char_offset", "row_label")
    best = F.struct(*[c for c in prices.columns if c not in keys])
    return prices.groupBy(*keys).agg(F.min_by(best, order).alias("b")).select(*keys, "b.*")
