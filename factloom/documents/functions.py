"""The document readers as table functions of SQL, called laterally: FROM corpus, LATERAL document_lines(raw).

Each takes a document's source and gives rows, in Arrow batches; what a reader says of a document is the same as through
`operators`. A null source has no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import astuple

from pyspark.sql import SparkSession
from pyspark.sql.functions import udtf

from factloom.documents import grid, layout, markup, production, reserves


class DocumentLines:
    """Lines with their page, heading and offsets."""

    def eval(self, raw: str) -> Iterator[tuple]:
        page = layout.read(raw or "")
        for x in page.lines:
            yield x.page, x.number, page.section_at(x.start), x.start, x.raw_start, x.raw_end, x.text


class DocumentCells:
    """Cells of tables with figures, with the labels over them and before them."""

    def eval(self, raw: str) -> Iterator[tuple]:
        for g in grid.grids(raw or ""):
            for c in g.cells():
                yield g.index, g.start, *c


class DocumentFigures:
    """Marked-up figures of some qualified names, of all where these are null."""

    def eval(self, raw: str, tags: list) -> Iterator[tuple]:
        for f in markup.figures(raw or "", None if tags is None else set(tags)):
            yield astuple(f)


class ReserveReadings:
    """Reserves by concept, product and unit; the period to take where the document names none."""

    def eval(self, raw: str, fallback_period: str) -> Iterator[tuple]:
        for r in reserves.readings(raw or "", fallback_period):
            yield astuple(r)


class ProductionReadings:
    """Production, prices and costs by product and unit."""

    def eval(self, raw: str) -> Iterator[tuple]:
        for r in production.readings(raw or ""):
            yield astuple(r)


FUNCTIONS = {
    "document_lines": (DocumentLines, "page int, line_no int, section string, char_offset long, raw_start long, raw_end long, text string"),
    "document_cells": (DocumentCells, "table_index int, table_start long, row int, column int, text string, header string, row_label string"),
    "document_figures": (DocumentFigures, "concept string, shown string, value double, scale int, unit string, product string, member string, period_end string, period_start string, element_id string, start long, end long"),
    "reserve_readings": (ReserveReadings, "concept_key string, product string, value double, unit string, period_end string, table_index int, row_label string, source_span string, char_offset long"),
    "production_readings": (ProductionReadings, "concept_key string, product string, value double, unit string, period_end string, is_hedged boolean, table_index int, row_label string, source_span string, char_offset long"),
}


def register(spark: SparkSession) -> None:
    """Makes the functions known to the session's SQL."""
    for name, (reader, schema) in FUNCTIONS.items():
        spark.udtf.register(name, udtf(reader, returnType=schema, useArrow=True))
