"""Settings of an engine, checked once."""

from __future__ import annotations

import logging
import time
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from functools import wraps
from typing import TypeVar

from nomograph.plans.errors import RequestError
from nomograph.plans.requests import CEILING, check_language

log = logging.getLogger("nomograph")


TIMEOUT_MS = (1000, 55_000)


@dataclass(frozen=True)
class Settings:
    """What a corpus's eager entry points keep to. row_ceiling: rows of any page, 1 to 100. timeout_ms: of ad-hoc queries. language: of the thesaurus, where a request names none."""

    row_ceiling: int = CEILING
    timeout_ms: int = TIMEOUT_MS[1]
    language: str = "en"

    def __post_init__(self) -> None:
        if not 1 <= self.row_ceiling <= CEILING or not TIMEOUT_MS[0] <= self.timeout_ms <= TIMEOUT_MS[1]:
            raise RequestError("invalid_argument", "The settings are out of range.")
        check_language(self.language)


@contextmanager
def logged(call: str, **arguments: object) -> Iterator[dict[str, object]]:
    """One structured line for a call: its arguments, its time, and what the caller adds, its rows for instance."""
    found: dict[str, object] = {}
    began = time.perf_counter()
    try:
        yield found
    except RequestError as e:
        found["failed"] = e.reason
        raise
    finally:
        log.info("%s", {"call": call, "ms": round(1000 * (time.perf_counter() - began)), **arguments, **found})


Result = TypeVar("Result")


def entry_point(call: str) -> Callable[[Callable[..., Result]], Callable[..., Result]]:
    """Logs each call of an eager entry point, whose first argument is the corpus, and how many rows a result with rows has."""

    def around(f: Callable[..., Result]) -> Callable[..., Result]:
        @wraps(f)
        def logging_f(corpus, *args, **arguments):
            with logged(call, **{str(n): a for n, a in enumerate(args)}, **arguments) as line:
                result = f(corpus, *args, **arguments)
                page = result[0] if isinstance(result, tuple) and result else result
                if (rows := getattr(page, "rows", getattr(page, "bindings", None))) is not None:
                    line["rows"] = len(rows)
            return result

        return logging_f

    return around
