"""Finding a stored value in the text of the document that it cites.

The numbers of a text are read once, each with its place and what it is worth in whole units of its last decimal, and
kept by that worth. A value is looked up under every magnitude that filings print at and with up to two decimals; no
text is searched for it. Units in brackets are found once as well, and the nearest before a number are looked up by place.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import defaultdict
from dataclasses import dataclass
from decimal import ROUND_HALF_EVEN, Decimal

from factloom.documents.layout import Layout
from factloom.documents.wording import label, short_unit

# What filings print figures in, with its name, in the order of preference.
MAGNITUDES = ((1.0, "as tagged"), (1e3, "thousands"), (1e6, "millions"), (1e9, "billions"), (1e-3, "tagged in thousands of the printed unit"))
DECIMALS = (0, 1, 2)
#: Digits that a figure needs to be told from others, and the largest one printed with decimals.
LEAST_DIGITS, MOST_WITH_DECIMALS = 3, 1e6
#: Characters of the text around a figure: of its excerpt, behind it for its unit, before it for a unit in brackets.
PAD, AHEAD, BACK = 110, 40, 2500
DIGITS = re.compile(r"[0-9][0-9,.]*")
BRACKETED, BARE = re.compile(r"\(([^()]{2,12})\)"), re.compile(r"[A-Za-z]+")
#: Marks that may stand between a figure and its unit.
BETWEEN = frozenset(" ,.:;)")
RARE_UNITS = frozenset({"tcf", "tcfe"})


@dataclass(frozen=True)
class Hit:
    printed: str
    scale: float
    scale_label: str
    offset: int
    line: int
    page: int
    section: str | None
    hits: int
    source_span: str
    units: tuple[str, ...]


@dataclass(frozen=True)
class Number:
    """A number as printed: where it starts and ends, sign included where it has one."""

    start: int
    end: int


def grouped(whole: int, decimals: int) -> str:
    """A whole number of units of the last decimal, with commas."""
    sign, digits = "-" if whole < 0 else "", f"{abs(whole):0{decimals + 1}d}"
    head, tail = (digits[:-decimals], "." + digits[-decimals:]) if decimals else (digits, "")
    return f"{sign}{int(head):,}{tail}"


def worth(value: float, decimals: int) -> int:
    """The value in whole units of a decimal, to the nearest, the even one of two."""
    return int(Decimal(value).scaleb(decimals).quantize(Decimal(1), ROUND_HALF_EVEN))


def searchable(value: float) -> bool:
    """Whether a value has enough digits that are no zeros at either end, to two decimals."""
    return value != 0 and len(str(abs(worth(value, 2))).rstrip("0")) >= LEAST_DIGITS


def is_unit(word: str) -> bool:
    return short_unit(word.lower()) is not None or word.lower() in RARE_UNITS


class Numbers:
    """The numbers of a text by (worth, decimals), and its units in brackets by place."""

    def __init__(self, text: str):
        self.text = text
        self.plain: dict[tuple[int, int], list[Number]] = defaultdict(list)
        self.negative: dict[tuple[int, int], list[Number]] = defaultdict(list)
        for m in DIGITS.finditer(text):
            if text[m.start() - 1 : m.start()] not in (",", "."):  # else the rest of something longer
                for end in self._ends(m):
                    self._read(m.start(), end)
        self.units: list[tuple[int, str]] = []
        for m in BRACKETED.finditer(text):
            words = [w for w in BARE.findall(m[1]) if w.lower() != "d"]  # "MBbl/d"
            if len(words) == 1 and is_unit(words[0]) and not any(p.isdigit() for p in label(m[1]).pieces):
                self.units.append((m.end(), words[0]))

    @staticmethod
    def _ends(m: re.Match) -> list[int]:
        """Where the number may end: before each point of its run, and at the end of the run unless a comma stands there."""
        run = m[0]
        ends = [m.start() + k for k, c in enumerate(run) if c == "."]
        return ends if run[-1] in ",." else [*ends, m.end()]

    def _read(self, start: int, end: int) -> None:
        """Takes in the number between two places if it is printed as numbers are, under its worth and its sign."""
        text = self.text
        whole, _, decimals = text[start:end].partition(".")
        if len(decimals) > max(DECIMALS) or "," in decimals or "." in decimals:
            return
        key = int(whole.replace(",", "") + decimals), len(decimals)
        if grouped(*key) != text[start:end] or text[end : end + 1] == ",":
            return
        self.plain[key].append(Number(start, end))
        before, ahead = text[start - 1 : start], text[start - 2 : start - 1]
        if ahead and (ahead.isdigit() or ahead in ",."):
            return
        if before == "-":
            self.negative[key].append(Number(start - 1, end))
        elif before == "(" and text[end : end + 1] == ")" and not (text[end + 1 : end + 2].isdigit() or text[end + 1 : end + 2] == ","):
            self.negative[key].append(Number(start - 1, end + 1))

    def of(self, value: float) -> tuple[list[Number], float, str] | None:
        """(numbers, magnitude, its name): where the value is printed, the longest way of printing it that occurs."""
        best: tuple[int, list[Number], float, str] | None = None
        for magnitude, name in MAGNITUDES:
            scaled = value / magnitude
            for decimals in DECIMALS:
                if abs(scaled) < 1 if not decimals else abs(scaled) >= MOST_WITH_DECIMALS:
                    continue
                whole = worth(scaled, decimals)
                if len(f"{abs(whole):0{decimals + 1}d}") < LEAST_DIGITS:
                    continue
                for way in self._printed(whole, decimals, value < 0):
                    length = way[0].end - way[0].start
                    if best is None or length > best[0]:
                        best = length, way, magnitude, name
        return best and best[1:]

    def _printed(self, whole: int, decimals: int, negative: bool) -> list[list[Number]]:
        """The places of each way in which a number is printed: as it is; with a minus; in brackets."""
        if not negative:
            found = self.plain.get((whole, decimals))
            return [found] if found else []
        signed = self.negative.get((abs(whole), decimals), [])
        ways = [[n for n in signed if (self.text[n.start] == "(") is bracketed] for bracketed in (False, True)]
        return [way for way in ways if way]

    def units_near(self, number: Number) -> tuple[str, ...]:
        """The unit right behind a number, then those in brackets before it, nearest first; each once."""
        at = number.end
        while at < min(len(self.text), number.end + AHEAD) and self.text[at] in BETWEEN:
            at += 1
        word = BARE.match(self.text, at, number.end + AHEAD)
        found = [word[0]] if word and is_unit(word[0]) and not self.text[word.end() : word.end() + 1].isalnum() else []
        k = bisect_left(self.units, (number.start + 1, ""))
        while k and self.units[k - 1][0] > number.start - BACK:
            k -= 1
            found.append(self.units[k][1])
        return tuple(dict.fromkeys(found))


def find_value(layout: Layout, value: float, numbers: Numbers | None = None) -> Hit | None:
    """The value in a document, under the longest way of printing it that the text has; the first of its places.
    numbers: those of the document, where several values are looked for."""
    numbers = numbers or Numbers(layout.text)
    found = numbers.of(value)
    if found is None:
        return None
    (first, *_), magnitude, name = found
    text, line = layout.text, layout.line_at(first.start)
    span = text[max(0, first.start - PAD) : first.end + PAD].strip()
    span = ("… " if first.start > PAD else "") + span + (" …" if first.end + PAD < len(text) else "")
    return Hit(text[first.start : first.end], magnitude, name, first.start, line.number, line.page, layout.section_at(first.start), len(found[0]), span, numbers.units_near(first))
