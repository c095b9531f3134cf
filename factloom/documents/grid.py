"""Tables of a document as grids whose cells know their header."""

from __future__ import annotations

import html
import re
from dataclasses import dataclass, field

from factloom.documents.wording import MONTH, PIECE, is_year

MARKS = re.compile(r"(?is)<(/?)(table|tr|td|th)\b([^>]*)>")
SPAN = re.compile(r'(?i)colspan="?(\d+)"?')
BLANK = re.compile("[\\s\u00a0\u200b]+")
#: Signs that a figure may have around it, and what stands in it beside digits.
AROUND, WITHIN = "()+-$% \t\n", ",. "


@dataclass
class Grid:
    """head: label rows above the first row of figures; body: (row number, cells), a cell being (column, text)."""

    index: int
    start: int
    end: int
    head: list[list[str]] = field(default_factory=list)
    body: list[tuple[int, list[tuple[int, str]]]] = field(default_factory=list)

    def labels(self) -> list[str]:
        """The labels over the columns: the lowest head row with several, else the lowest with one."""
        rows = sorted(([c for c in row if c] for row in reversed(self.head)), key=lambda r: -min(len(r), 2))
        return rows[0] if rows else []

    def over(self) -> dict[int, str]:
        """The lowest label that stands over each column."""
        return {column: text for row in self.head for column, text in enumerate(row) if text}

    def cells(self):
        """(row, column, text, header, row label). Figures take labels by their order in the row, since head rows lack
        the label column; other cells, and figures beyond the labels, by their column."""
        labels, over = self.labels(), self.over()
        for number, row in self.body:
            figures = [column for column, text in row if is_figure(text)]
            place = dict(zip(figures, labels, strict=False))
            label = next((text for column, text in row if column not in figures), "")
            for column, text in row:
                yield number, column, text, place.get(column, over.get(column, "")), label

    def texts(self) -> list[str]:
        return [t for _, row in self.body for _, t in row] + [t for row in self.head for t in row if t]


def is_figure(text: str) -> bool:
    """A printed number, with its signs; more than one sign may stand before it and one behind."""
    core = text.lstrip(AROUND.replace("%", "")).rstrip()
    core = core[:-1] if core.endswith((")", "%")) else core
    return bool(core) and (core[0] == "," or core[0] in "0123456789") and all(c in "0123456789" or c in WITHIN or c.isspace() for c in core)


def is_period(text: str) -> bool:
    """The name of a period: a year, a day of a month, a date in figures, a quarter, a fiscal year."""
    pieces = PIECE.findall(text.lower().rstrip(","))
    if len(pieces) == 1:
        return is_year(pieces[0])
    if len(pieces) == 2:
        word, digits = pieces
        if word == "fy":
            return is_year(digits) or (digits.isdigit() and len(digits) == 2)
        return (word == "q" and digits in ("1", "2", "3", "4")) or (word in MONTH and digits.isdigit() and len(digits) < 3)
    return len(pieces) == 5 and pieces[1] == pieces[3] == "/" and all(p.isdigit() and len(p) < n for p, n in zip(pieces[::2], (3, 3, 5), strict=True))


def is_body(cells: list[str]) -> bool:
    """Whether a row belongs to the figures: more than a third of its cells are numbers that name no period."""
    filled = [c for c in cells if c]
    numbers = [c for c in filled if is_figure(c) and not is_period(c)]
    return len(numbers) > len(filled) // 3


def untagged(raw: str) -> str:
    return re.sub(r"<[^>]+>", " ", raw)


def _cell(raw: str) -> str:
    return BLANK.sub(" ", html.unescape(untagged(raw))).strip()


def grids(raw: str) -> list[Grid]:
    """The tables that hold a row of figures, by one pass over the table marks; a table inside another is part of it."""
    out: list[Grid] = []
    rows: list[list[str]] | None = None
    row: list[str] | None = None
    opened: tuple[int, int] | None = None
    begin = index = 0
    for m in MARKS.finditer(raw or ""):
        closing, kind = bool(m[1]), m[2].lower()
        if kind == "table":
            if not closing and rows is None:
                rows, row, opened, begin = [], None, None, m.start()
            elif closing and rows is not None:
                if rows and (grid := _grid(index, begin, m.end(), rows)).body:
                    out.append(grid)
                rows, index = None, index + 1
        elif rows is None:
            continue
        elif kind == "tr":
            if closing and row is not None:
                rows.append(row)
                row = None
            elif not closing:
                row, opened = [], None
        elif row is not None:
            if closing and opened is not None:
                row += [_cell(raw[opened[0]: m.start()]), *[""] * (opened[1] - 1)]
                opened = None
            elif not closing:
                span = SPAN.search(m[3])
                opened = m.end(), int(span[1]) if span else 1
    return out


def _grid(index: int, start: int, end: int, rows: list[list[str]]) -> Grid:
    """The rows with anything in them: labels down to the first row of figures, and all from there."""
    filled = [(number, cells) for number, cells in enumerate(rows) if any(cells)]
    first = next((k for k, (_, cells) in enumerate(filled) if is_body(cells)), len(filled))
    body = [(number, [(c, t) for c, t in enumerate(cells) if t]) for number, cells in filled[first:]]
    return Grid(index, start, end, [cells for _, cells in filled[:first]], body)


def header_of(grids_: list[Grid], printed: str, near: int | None = None) -> tuple[str, str] | None:
    """(header, row label) of a printed figure: in the table around the offset, else in the nearest; else the first."""
    def distance(g: Grid) -> tuple:
        if near is None:
            return 0, 0
        return (0, 0) if g.start <= near <= g.end else (1, min(abs(g.start - near), abs(g.end - near)))

    for g in sorted(grids_, key=distance):
        for _, _, text, header, label in g.cells():
            if text == printed.strip():
                return header, label
    return None
