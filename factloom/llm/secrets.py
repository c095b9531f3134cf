"""Secret scan: base patterns plus a likelihood ratio of two character Markov models.

One model is trained on strings that are labelled random, the other on strings that are labelled ordinary: identifiers,
words, numbers, dates, paths, rules of punctuation. A run of key characters is reported where the sum of its log ratios
exceeds what the rarity of secrets asks for (the log of one over the prior) and an allowance a character, for strings
that are ordinary in ways which the samples lack. The allowance comes from labelled ordinary strings that the models
have not seen: at most a stated share of them passes. Runs have no least length other than by that sum, and dots join
them. Of a run that a base span covers in part, what is left on either side is a run.

All runs of a text are scored at once, in time linear in the text and its spans.

Cases: a null text counts as empty (no spans); texts of any length are taken whole; repeated rows each get their own
result; an empty table gives an empty table; other columns, whatever their names, are kept by a caller of `redacted` and
ignored by `scan`. Without ordinary samples, or without random ones, no run is reported.
"""

from __future__ import annotations

import base64
import hashlib
import math
import random
import re
from collections.abc import Iterable
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factloom.llm.common import settle

KINDS = ("assign", "access", "hex")
#: The span kind that the models add.
MARKOV = "markov"

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
KEYWORDS = ("password", "passwd", "secret", "token", "api_key", "apikey")
CHARS = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-."
_START, _NONE = len(CHARS), 255
#: The number of each ASCII character, and of all others at the end.
_CODE = np.full(129, _NONE, np.uint8)
_CODE[[ord(c) for c in CHARS]] = range(len(CHARS))
_DOT = CHARS.index(".")
#: What random strings are made of: hexadecimal digits, letters and digits, base 64 and its variant, one case each.
ALPHABETS = ("0123456789abcdef", CHARS[:62], CHARS[:62] + "+/", CHARS[:62] + "_-", CHARS[26:62], CHARS[:26] + CHARS[52:62], CHARS[:26], CHARS[26:52])


def vocabulary_words(path: str) -> list[str]:
    """Words of a public vocabulary of ranks: its pieces of lower-case letters that follow a space."""
    with open(path, "rb") as lines:
        pieces = (base64.b64decode(line.split()[0]) for line in lines if line.strip())
        return [p[1:].decode() for p in pieces if re.fullmatch(rb" [a-z]{3,}", p)]


def labelled_samples(words: list[str], n: int = 12_000, seed: int = 7) -> list[tuple[str, int]]:
    """The default labelled samples: n random strings (1) and n ordinary ones (0), made by rule from words and a seed."""
    rng, out = random.Random(seed), []
    number = lambda most: str(rng.randint(0, most))
    for i in range(n):
        out.append(("".join(rng.choices(ALPHABETS[i % len(ALPHABETS)], k=rng.randint(12, 64))), 1))
        w = rng.choices(words, k=rng.randint(1, 6))
        text = (
            "_".join(w), w[0] + "".join(x.title() for x in w[1:]), "-".join(w), "/".join(w), ".".join(w), "_".join(w).upper(), "".join(w), w[0], w[0].title(), w[0].upper(),
            f"{rng.randint(1900, 2099)}-{rng.randint(1, 12):02d}-{rng.randint(1, 28):02d}", number(10 ** rng.randint(1, 15)), ".".join(number(255) for _ in range(rng.randint(2, 4))),
            "-".join(number(9999) for _ in range(rng.randint(2, 4))), rng.choice("-=_+/.") * rng.randint(2, 80), f"{w[0]}{rng.choice('_-')}{number(9999)}.{rng.choice(words)[:3]}",
        )[i % 16]
        out.append((text, 0))
    return out


def _runs(code: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(numbers of the characters in runs, starts of the runs among them, places of their first and last character).

    code: the number of each character of a text, _NONE where it belongs to no run; a dot belongs to one between two
    other characters of it."""
    inside = code != _NONE
    dot = code == _DOT
    solid = inside & ~dot
    inside = solid | (dot & np.append(False, solid[:-1]) & np.append(solid[1:], False))
    place = np.flatnonzero(inside)
    if not len(place):
        return code[:0], place, place, place
    first = np.append(True, place[1:] != place[:-1] + 1)
    starts = np.flatnonzero(first)
    return code[place], starts, place[starts], place[np.append(starts[1:], len(place)) - 1]


class MarkovScanner:
    """The log ratio of each character after two others under two order-2 models; a run is reported where its sum exceeds
    `least` and `allowance` times its length."""

    def __init__(self, ratio: np.ndarray, least: float = math.inf, allowance: float = 0.0):
        self.ratio, self.least, self.allowance = ratio, least, allowance

    @classmethod
    def train(cls, samples: Iterable[tuple[str, int]], smoothing: float = 0.5, backoff: float = 8.0, prior: float = 1e-6, false_positive: float = 0.0005) -> MarkovScanner:
        """samples: (string, 1 if random else 0); prior: the share of runs that are secrets. Every third ordinary sample
        is kept out of the models and sets the allowance: the least for which at most `false_positive` of the kept runs
        pass, and not less than half the mean that all but a hundredth of the random samples reach."""
        samples = list(samples)
        ordinary = [x for x, y in samples if not y]
        kept, trained = ordinary[::3], [x for i, x in enumerate(ordinary) if i % 3]
        logs, random_ = [], [x for x, y in samples if y]
        for texts in (random_, trained):
            counts = np.zeros((_START + 1, _START + 1, _START))
            code, starts, *_ = _runs(_codes("\n".join(texts)))
            np.add.at(counts, (*_before(code, starts), code), 1)
            one = counts.sum(axis=(0, 1)) + smoothing
            two = counts.sum(axis=0)
            first = (two + backoff * one / one.sum()) / (two.sum(axis=1, keepdims=True) + backoff)
            logs.append(np.log((counts + backoff * first) / (counts.sum(axis=2, keepdims=True) + backoff)))
        found = cls(logs[0] - logs[1])
        if kept and random_:
            sums, sizes, *_ = found.evidence(_codes("\n".join(kept)))
            own, lengths, *_ = found.evidence(_codes("\n".join(random_)))
            found.least = -math.log(prior)
            allowed = np.quantile((sums - found.least) / sizes, 1 - false_positive, method="higher")
            found.allowance = max(0.0, float(allowed), float(np.quantile(own / lengths, 0.01)) / 2)
        return found

    def evidence(self, code: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(sum of the log ratios, number of characters, place of the first, place of the last) of each run."""
        own, starts, first, last = _runs(code)
        if not len(starts):
            return np.zeros(0), first, first, last
        return np.add.reduceat(self.ratio[(*_before(own, starts), own)], starts), last - first + 1, first, last

    def score(self, text: str) -> float:
        """The sum of the log ratios of a run of key characters; above 0 it looks random."""
        return float(self.evidence(_codes(text))[0].sum())

    def base_spans(self, text: str) -> list[tuple[int, int, str]]:
        """(start, end, kind) of the base patterns, sorted by start and kind as listed."""
        spans = []
        low = text.lower()
        if any(k in low for k in KEYWORDS):
            spans += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
        if "AKIA" in text:
            spans += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
        spans += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
        return sorted(spans, key=_order)

    def added_spans(self, text: str, base: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
        """Runs of key characters outside of the base spans that the models call random."""
        code = _codes(text)
        for start, end, _ in base:
            code[start:end] = _NONE
        sums, sizes, first, last = self.evidence(code)
        passed = np.flatnonzero(sums > self.least + self.allowance * sizes)
        return [(s, e + 1, MARKOV) for s, e in zip(first[passed].tolist(), last[passed].tolist(), strict=True)]

    def redact(self, text: str, mark: str = "[SECRET]") -> str:
        base = self.base_spans(text)
        out, at = [], 0
        for start, end, _ in sorted(base + self.added_spans(text, base)):
            if end <= at:
                continue
            if start >= at:
                out += [text[at:start], mark]
            at = end
        return "".join([*out, text[at:]])


def _codes(text: str) -> np.ndarray:
    return _CODE[np.minimum(np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32), 128)]


def _before(code: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The two characters before each, _START before a run."""
    one, two = np.append(code[:1], code[:-1]), np.append(code[:2], code[:-2])[: len(code)]
    one[starts] = two[starts] = _START
    second = starts + 1
    second = second[second < len(code)]
    two[second] = _START
    return two, one


def _order(span: tuple[int, int, str]) -> tuple:
    return span[0], (*KINDS, MARKOV).index(span[2]), span[1]


def joined(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for s, e, k in spans)


@lru_cache(2)
def default_scanner(vocabulary: str) -> MarkovScanner:
    """Trained on samples of a public vocabulary's words."""
    return MarkovScanner.train(labelled_samples(vocabulary_words(vocabulary)))


def scan(docs: DataFrame, scanner: MarkovScanner, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, counts by kind, digest of the base spans, and all spans as kind:start:end."""

    @F.pandas_udf("n_assign long, n_access long, n_hex long, n_markov long, base_sha256 string, spans string")
    def find(texts: pd.Series) -> pd.DataFrame:
        settle()
        rows = []
        for text in texts:
            base = scanner.base_spans(text := text or "")
            added = scanner.added_spans(text, base)
            kinds = [k for _, _, k in base]
            rows.append((*(kinds.count(k) for k in KINDS), len(added), hashlib.sha256(joined(base).encode()).hexdigest(), joined(sorted(base + added, key=_order))))
        return pd.DataFrame(rows, columns=["n_assign", "n_access", "n_hex", "n_markov", "base_sha256", "spans"])

    return docs.select(F.col(id_col), find(F.col(text_col)).alias("found")).select(id_col, "found.*")


def redacted(text: Column, scanner: MarkovScanner, mark: str = "[SECRET]") -> Column:
    """The text with every span replaced by the mark; null stays null."""

    @F.pandas_udf("string")
    def clean(texts: pd.Series) -> pd.Series:
        settle()
        return texts.map(lambda t: None if t is None else scanner.redact(t, mark))

    return clean(text)
