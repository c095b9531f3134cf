"""The questions that a front end asks, by name and parameters given as text: answers are kept while the store stays.

An answer is a list of rows as dictionaries, bounded by the plan that gives it. What is not there is `Missing`, and what
cannot be read as a parameter is `BadRequest`; a server turns them into its own codes.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame

from factloom.plans import counts, panel, quality, series
from factloom.plans.answers import Answers
from factloom.registry import BY_KEY
from factloom.sources.store import Store


class BadRequest(ValueError):
    """A parameter is absent, or is not what it should be."""


class Missing(LookupError):
    """There is no such thing."""


@dataclass(frozen=True)
class Question:
    """plan(store, parameters) -> rows; needed and optional parameters; whether the answer is kept; whether an answer
    without rows means that the thing asked for does not exist."""

    plan: Callable[[Store, dict[str, str]], DataFrame]
    needed: tuple[str, ...] = ()
    optional: tuple[str, ...] = ()
    kept: bool = True
    must_exist: bool = False


def _concept(p: dict[str, str]) -> str:
    if p["concept"] not in BY_KEY:
        raise BadRequest(f"unknown concept {p['concept']!r}")
    return p["concept"]


def _cik(p: dict[str, str]) -> str:
    digits = p["cik"].strip().upper().removeprefix("CIK")
    if not (digits.isascii() and digits.isdigit()):
        raise BadRequest(f"not a company number: {p['cik']!r}")
    return digits.zfill(10)


def _number(p: dict[str, str], name: str, default: int) -> int:
    text = p.get(name) or str(default)
    if not (text.isascii() and text.isdigit()):
        raise BadRequest(f"{name} is not a number: {text!r}")
    return int(text)


def _flag(p: dict[str, str], name: str, default: bool) -> bool:
    text = (p.get(name) or str(default)).lower()
    if text not in ("true", "false", "1", "0"):
        raise BadRequest(f"{name} is neither true nor false: {text!r}")
    return text in ("true", "1")


def _panel(s: Store, p: dict[str, str]) -> DataFrame:
    of = dict(product=p.get("product"), cohort=p.get("cohort"))
    return panel.panel_latest(s, _concept(p), **of) if p["period"] == "latest" else panel.panel(s, _concept(p), p["period"], **of)


def _trends(s: Store, p: dict[str, str]) -> DataFrame:
    return series.trends(s, _concept(p), normalized=_flag(p, "normalized", True), limit=_number(p, "limit", 12))


QUESTIONS: dict[str, Question] = {
    "summary": Question(lambda s, p: counts.summary(s, p.get("cohort")), optional=("cohort",)),
    "concepts": Question(lambda s, p: counts.concepts(s)),
    "periods": Question(lambda s, p: counts.periods(s, _concept(p) if p.get("concept") else None), optional=("concept",)),
    "panel": Question(_panel, ("concept", "period"), ("product", "cohort")),
    "panel-wide": Question(lambda s, p: panel.panel_wide(s, p.get("period"), p.get("product"), p.get("cohort")), optional=("period", "product", "cohort")),
    "cohorts": Question(lambda s, p: counts.cohorts(s)),
    "companies": Question(lambda s, p: counts.companies(s)),
    "company": Question(lambda s, p: series.company_series(s, _cik(p)), ("cik",), kept=False),
    "locator": Question(lambda s, p: quality.fact_locator(s, [p["id"]]), ("id",), kept=False, must_exist=True),
    "citation": Question(lambda s, p: quality.citation(s, [p["id"]]), ("id",), kept=False, must_exist=True),
    "trends": Question(_trends, ("concept",), ("normalized", "limit")),
    "kpis": Question(lambda s, p: counts.company_concepts(s, p.get("cohort")), optional=("cohort",)),
    "history": Question(lambda s, p: series.company_history(s, _cik(p), _concept(p), p.get("product")), ("cik", "concept"), ("product",), kept=False),
    "coverage": Question(lambda s, p: counts.coverage_matrix(s, p.get("cohort")), optional=("cohort",)),
    "discontinuities": Question(lambda s, p: quality.discontinuities(s)),
    "collisions": Question(lambda s, p: quality.collisions(s)),
    "reserve-issues": Question(lambda s, p: quality.reserve_issues(s)),
    "unreached": Question(lambda s, p: quality.unreached(s)),
}


class Service:
    """Answers over a store. version() changes when the store does; see `Answers` for how stale an answer may be."""

    def __init__(self, open_store: Callable[[], Store], version: Callable[[], Any], **kept: Any):
        self.open_store, self.answers = open_store, Answers(version, **kept)

    def plan(self, name: str, parameters: dict[str, str] | None = None) -> DataFrame:
        """The rows of a question, not yet run."""
        question, given = QUESTIONS.get(name), {k: v for k, v in (parameters or {}).items() if v not in (None, "")}
        if question is None:
            raise Missing(f"no question {name!r}")
        if lacking := [p for p in question.needed if p not in given]:
            raise BadRequest(f"{name} needs {', '.join(lacking)}")
        if unknown := sorted(set(given) - {*question.needed, *question.optional}):
            raise BadRequest(f"{name} knows no {', '.join(unknown)}")
        return question.plan(self.open_store(), given)

    def ask(self, name: str, **parameters: str) -> list[dict[str, Any]]:
        compute = lambda: [r.asDict(recursive=True) for r in self.plan(name, parameters).collect()]  # noqa: E731  a report of bounded size
        question = QUESTIONS.get(name)
        rows = self.answers.get((name, *sorted(parameters.items())), compute) if question and question.kept else compute()
        if question.must_exist and not rows:
            raise Missing(f"{name}: nothing for {parameters}")
        return rows
