"""A grammar of table labels: words in order, units put together from a magnitude and a base, products, dates.

A label is read as words, not as a pattern: what it says follows from which words it has and in which order.
"""

from __future__ import annotations

import calendar
import re
from collections.abc import Iterable
from dataclasses import dataclass
from functools import cached_property, lru_cache

PIECE = re.compile(r"[A-Za-z]+|[0-9]+|[^\sA-Za-z0-9]")
#: The magnitude that a letter before a base stands for, and the word that spells it out.
MAGNITUDES = {"m": "thousand", "mm": "million", "b": "billion"}
#: How a unit of each base is written after its magnitude, and the magnitudes it is used with.
BASES = {"boe": ("Boe", ("", "m", "mm")), "bbl": ("Bbls", ("", "m", "mm")), "cf": ("cf", ("m", "mm", "b")), "cfe": ("cfe", ("m", "mm", "b"))}
MONTH = {name.lower(): i for i, name in enumerate(calendar.month_name) if name}


def singular(word: str) -> str:
    return word[:-1] if len(word) > 3 and word.endswith("s") and not word.endswith("ss") else word


def written(magnitude: str, base: str) -> str | None:
    """A unit as it is written: MMBoe, bbl, Mcf; None where the base is not used with the magnitude."""
    name, used = BASES[base]
    if magnitude not in used:
        return None
    return magnitude.upper() + name if magnitude else {"bbl": "bbl"}.get(base, name)


def short_unit(word: str) -> tuple[str, str] | None:
    """(magnitude, base) of an abbreviation such as mboe or mmbbls."""
    word = singular(word)
    for base in BASES:
        if word.endswith(base) and written(word.removesuffix(base), base):
            return word.removesuffix(base), base
    return None


@dataclass(frozen=True)
class Label:
    text: str

    @cached_property
    def pieces(self) -> list[str]:
        """Words, numbers and marks, lower case."""
        return PIECE.findall(self.text.lower())

    @cached_property
    def words(self) -> list[str]:
        return [p for p in self.pieces if p.isalnum()]

    @cached_property
    def stems(self) -> list[str]:
        return [singular(w) for w in self.words]

    def says(self, *phrases: str) -> bool:
        """Whether it holds one of the phrases: words in a row, whatever their number."""
        return any(self.find(p) is not None for p in phrases)

    def find(self, phrase: str, start: int = 0) -> int | None:
        """The place behind the first occurrence of a phrase."""
        wanted = [singular(w) for w in phrase.split()]
        spots = range(start, len(self.stems) - len(wanted) + 1)
        return next((i + len(wanted) for i in spots if self.stems[i : i + len(wanted)] == wanted), None)

    def without_lead(self, *fillers: str) -> list[str]:
        """Its stems after leading numbers and filler words."""
        at = 0
        while at < len(self.stems) and (self.stems[at] in fillers or self.stems[at].isdigit()):
            at += 1
        return self.stems[at:]

    @cached_property
    def unit(self) -> str | None:
        """The unit that it names, abbreviated or spelled out, the first of several."""
        for i, word in enumerate(self.words):
            if found := short_unit(word):
                before = self.words[i - 1] if i else ""
                if not found[0] and before in MAGNITUDES and (joined := written(before, found[1])):
                    return joined
                return written(*found)
        return self._spelled()

    def _spelled(self) -> str | None:
        for magnitude, word in MAGNITUDES.items():
            if word not in self.stems:
                continue
            rest = self.stems[self.stems.index(word) + 1 :]
            rest = rest[1:] if rest[:1] == ["of"] else rest
            equivalent = "equivalent" in rest
            if rest[:2] in (["cubic", "feet"], ["cubic", "foot"], ["cubic", "ft"]):
                return written(magnitude, "cfe" if rest[2:3] == ["equivalent"] else "cf")
            if rest[:1] in (["barrel"], ["bbl"]) or (rest[:2] == ["oil", "equivalent"] and "barrel" in rest[:3]):
                return written(magnitude, "boe" if equivalent else "bbl")
        return None

    def bases(self) -> set[str]:
        """The bases of the abbreviated units that it has."""
        return {found[1] for w in self.words if (found := short_unit(w))}

    def dates(self) -> list[str]:
        """The days that it names as month, day and year, as ISO dates."""
        out = []
        parts = [p for p in self.pieces if p != ","]
        for month, day, year in zip(parts, parts[1:], parts[2:], strict=False):
            if month in MONTH and day.isdigit() and len(day) <= 2 and is_year(year):
                out.append(f"{int(year):04d}-{MONTH[month]:02d}-{int(day):02d}")
        return out

    def year(self) -> int | None:
        """The first year that it names."""
        return next((int(w) for w in self.words if is_year(w)), None)


@lru_cache(10_000)
def label(text: str) -> Label:
    return Label(text)


def is_year(word: str) -> bool:
    return word.isdigit() and len(word) == 4 and 1900 <= int(word) < 2100


def products(words: Iterable[str], liquids: tuple[str, ...]) -> list[tuple[int, str]]:
    """(place, product) of the words that name one. liquids: the words that stand for oil."""
    stems, out, i = [singular(w) for w in words], [], 0
    while i < len(stems):
        if stems[i] == "ngl":
            out.append((i, "ngl"))
        elif stems[i : i + 3] == ["natural", "gas", "liquid"]:
            out.append((i, "ngl"))
            i += 2
        elif stems[i] == "gas" or stems[i].startswith(("mcf", "bcf")) or stems[i : i + 2] == ["cubic", "feet"]:
            out.append((i, "gas"))
        elif stems[i] in liquids:
            out.append((i, "oil"))
        i += 1
    return out


def one_product(words: Iterable[str], liquids: tuple[str, ...]) -> str | None:
    """The product named; of several the one that is least often meant by the way: liquids of gas, gas, oil."""
    named = {p for _, p in products(words, liquids)}
    return next((p for p in ("ngl", "gas", "oil") if p in named), None)


def parenthesised(text: str) -> bool:
    return text.startswith("(") and text.endswith(")")


def plain_number(text: str) -> float | None:
    """A printed figure without its signs of money and thousands, negative in parentheses; None for anything else."""
    text = text.strip()
    core = "".join(c for c in text.strip("()") if c not in "$, \t")
    digits = core.removeprefix("-")
    if not digits or not digits.replace(".", "", 1).isdigit() or not digits.isascii() or digits[-1] == "." or digits[0] == ".":
        return None
    value = float(core)
    return -value if parenthesised(text) else value
