"""Text of documents: flattening, phrases, snippets."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# The phrases whose count speaks for a producer.
RESERVE_PHRASES = ("proved reserves", "proved developed", "proved undeveloped", "proved plus probable", "standardized measure", "reserve life", "forecast prices")


def flatten(html: Column) -> Column:
    """Tags become spaces, runs of white space one space."""
    return F.trim(F.regexp_replace(F.regexp_replace(html, "<[^>]+>", " "), r"\s+", " "))


def phrase_count(text: Column, phrase: str) -> Column:
    """Non-overlapping occurrences, in any case."""
    low = F.lower(text)
    return ((F.length(low) - F.length(F.replace(low, F.lit(phrase.lower())))) / len(phrase)).cast("long")


def phrases_count(text: Column, phrases: tuple[str, ...] = RESERVE_PHRASES) -> Column:
    return reduce(lambda a, b: a + b, [phrase_count(text, p) for p in phrases])


def snippet(text: Column, start: Column, end: Column, pad: int = 110) -> Column:
    """The text around [start, end) (0-based), with marks where it is cut."""
    first = F.greatest(F.lit(0), start - pad)
    last = F.least(F.length(text), end + pad)
    return F.concat(F.when(first > 0, "…").otherwise(""), F.substr(text, first + 1, last - first), F.when(last < F.length(text), "…").otherwise(""))


def line_of(text: Column, offset: Column) -> Column:
    """The 1-based line of a 0-based offset."""
    before = F.substr(text, F.lit(1), offset)
    return F.length(before) - F.length(F.replace(before, F.lit("\n"))) + 1


def searchable(value: Column) -> Column:
    """Whether a value has three significant digits at least, written to two places."""
    digits = F.regexp_replace(F.regexp_replace(F.format_string("%.2f", F.abs(value)), r"\.?0*$", ""), r"^0*\.?0*|\.", "")
    return F.length(digits) >= 3
