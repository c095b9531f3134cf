"""The archive as the driver sees it: an interface, a cached form of it, pacing and retries.

A rate cap holds for all machines together, so only the driver fetches; executors read what was cached. There is no
network client here: whoever has a network passes one that answers `text`.
"""

from __future__ import annotations

import json
import re
import time
from collections.abc import Callable, Iterator
from pathlib import Path
from typing import Protocol

from factloom.sources.urls import PAGE, browse_url

#: Requests a second, below what the archive allows; tries of a request that fails; seconds before the first repeat.
RATE, TRIES, FIRST_WAIT = 8.0, 4, 0.5


class SourceError(Exception):
    """The archive could not be read."""


class NotFound(SourceError):
    """The archive has no such document."""


class Forbidden(SourceError):
    """The archive refuses the caller; asking again makes it worse."""


class Archive(Protocol):
    def text(self, url: str) -> str: ...


class Cached:
    """An archive behind a folder of the driver: what is there is read, what is not is fetched once and kept. Without an
    archive behind it, what is not there is not found."""

    def __init__(self, folder: str, behind: Archive | None = None):
        self.folder, self.behind = Path(folder), behind

    def place(self, url: str) -> Path:
        return self.folder / re.sub(r"[^A-Za-z0-9._-]+", "_", url.split("://", 1)[-1])

    def text(self, url: str, refresh: bool = False) -> str:
        place = self.place(url)
        if place.exists() and not refresh:
            return place.read_text(encoding="utf-8")
        if self.behind is None:
            raise NotFound(url)
        found = self.behind.text(url)
        place.parent.mkdir(parents=True, exist_ok=True)
        part = place.with_suffix(place.suffix + ".part")
        part.write_text(found, encoding="utf-8")
        part.replace(place)
        return found

    def json(self, url: str, refresh: bool = False):
        return json.loads(self.text(url, refresh))


class Paced:
    """An archive asked at most `rate` times a second, and again after a failure, twice as long each time. What is not
    found or forbidden is not asked for again. `agent` names the caller, without which the archive is not asked at all."""

    def __init__(self, behind: Archive, agent: str, rate: float = RATE, tries: int = TRIES, clock: Callable[[], float] = time.monotonic, sleep: Callable[[float], None] = time.sleep):
        if not agent.strip():
            raise ValueError("the archive asks callers to name themselves")
        self.behind, self.agent, self.gap, self.tries, self.clock, self.sleep, self.last = behind, agent, 1 / rate, tries, clock, sleep, float("-inf")

    def text(self, url: str) -> str:
        for attempt in range(self.tries):
            if (wait := self.last + self.gap - self.clock()) > 0:
                self.sleep(wait)
            self.last = self.clock()
            try:
                return self.behind.text(url)
            except (NotFound, Forbidden):
                raise
            except SourceError:
                if attempt + 1 == self.tries:
                    raise
                self.sleep(FIRST_WAIT * 2**attempt)
        raise SourceError(url)


def filers_of(archive: Archive, sic: str, forms: tuple[str, ...]) -> list[str]:
    """Numbers of the filers of an industry code with one of the forms, each once, in the order they are met. The list
    of a form ends with the first page without a new number, as the archive repeats its last page."""
    seen: dict[str, None] = {}
    for form in forms:
        for page in _pages(archive, sic, form):
            fresh = [c for c in page if c not in seen]
            if not fresh:
                break
            seen.update(dict.fromkeys(fresh))
    return list(seen)


def _pages(archive: Archive, sic: str, form: str) -> Iterator[list[str]]:
    start = 0
    while True:
        yield [m[1].zfill(10) for m in re.finditer(r"<cik>\s*(\d+)\s*</cik>", archive.text(browse_url(sic, form, start)), re.I)]
        start += PAGE
