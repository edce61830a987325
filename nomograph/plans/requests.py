"""Requests as validated values, with their defaults."""

from __future__ import annotations

import datetime
import re
from dataclasses import asdict, dataclass

from nomograph.functions.dims import CASE_TYPES, COURTS, DOCUMENT_TYPES, RELATIONS
from nomograph.plans.errors import RequestError

#: Rows that a request returns at most, whatever its limit.
CEILING = 100
SNAPSHOT_CAP = 25
WINDOW, WINDOW_MAX = 25_000, 100_000


def _bad(message: str) -> RequestError:
    return RequestError("invalid_argument", message)


def given(value: str | None) -> str | None:
    """A text argument trimmed; blank counts as not given."""
    return (value or "").strip() or None


def check_date(value: str | None) -> str | None:
    value = given(value)
    if value is not None:
        try:
            if not re.fullmatch(r"\d{4}-\d{2}-\d{2}", value):
                raise ValueError
            datetime.date.fromisoformat(value)
        except ValueError:
            raise _bad(f"{value!r} is no date of the form yyyy-mm-dd.") from None
    return value


def check_iri(value: str | None) -> str | None:
    value = given(value)
    if value is not None and (not value.startswith("http") or re.search(r'[\s<>"]', value)):
        raise _bad(f"{value!r} is no usable IRI.")
    return value


def check_page(offset: int, limit: int, most: int) -> None:
    if offset < 0 or not 1 <= limit <= most:
        raise _bad(f"offset must be at least 0 and limit from 1 to {most}.")


def check_choice(value: str | None, choices) -> str | None:
    value = given(value)
    if value is not None and value not in choices:
        raise _bad(f"{value!r} is none of {', '.join(choices)}.")
    return value


def check_language(value: str, size: str = "2,3") -> str:
    if not re.fullmatch(rf"[A-Za-z]{{{size}}}", value.strip()):
        raise _bad(f"{value!r} is no language code.")
    return value.strip()


def exactly_one(**identifiers: str | None) -> tuple[str, str]:
    """The name and value of the one identifier that is given."""
    found = [(k, v) for k, v in ((k, given(v)) for k, v in identifiers.items()) if v is not None]
    if len(found) != 1:
        raise RequestError("invalid_identifier_args", f"{len(found)} of {', '.join(identifiers)} are given.")
    return found[0]


class _Echo:
    def echo(self) -> dict[str, object]:
        """The filters in effect, defaults included."""
        return {k: v for k, v in asdict(self).items() if v is not None}  # type: ignore[call-overload]


@dataclass
class SearchRequest(_Echo):
    keyword: str | None = None
    document_type: str | None = None
    include_consolidated: bool = False
    date_from: str | None = None
    date_to: str | None = None
    concept: str | None = None
    author: str | None = None
    in_force: bool | None = None
    offset: int = 0
    limit: int = 20

    def __post_init__(self) -> None:
        self.keyword, self.author = given(self.keyword), given(self.author)
        self.document_type = check_choice(self.document_type, DOCUMENT_TYPES)
        self.date_from, self.date_to = check_date(self.date_from), check_date(self.date_to)
        self.concept = check_iri(self.concept)
        check_page(self.offset, self.limit, CEILING)
        if not any((self.keyword, self.document_type, self.date_from, self.date_to, self.concept, self.author, self.in_force)):
            raise RequestError("no_filters", "The search has no filter that narrows it.")


@dataclass
class CaseRequest(_Echo):
    case_number: str | None = None
    keyword: str | None = None
    court: str | None = None
    case_type: str | None = None
    include_derivative: bool = False
    date_from: str | None = None
    date_to: str | None = None
    offset: int = 0
    limit: int = 20

    def __post_init__(self) -> None:
        self.case_number, self.keyword = given(self.case_number), given(self.keyword)
        self.court, self.case_type = check_choice(self.court, COURTS), check_choice(self.case_type, CASE_TYPES)
        self.date_from, self.date_to = check_date(self.date_from), check_date(self.date_to)
        check_page(self.offset, self.limit, CEILING)


@dataclass
class RelationRequest(_Echo):
    celex: str | None = None
    work_uri: str | None = None
    types: tuple[str, ...] = tuple(RELATIONS)
    offset: int = 0
    limit: int = CEILING

    def __post_init__(self) -> None:
        exactly_one(celex=self.celex, work_uri=self.work_uri)
        self.celex, self.work_uri = given(self.celex), check_iri(self.work_uri)
        for t in self.types:
            check_choice(t, RELATIONS)
        self.types = tuple(dict.fromkeys(self.types)) or tuple(RELATIONS)
        check_page(self.offset, self.limit, CEILING)


@dataclass
class SubjectRequest(_Echo):
    keyword: str = ""
    language: str = "en"
    offset: int = 0
    limit: int = 20

    def __post_init__(self) -> None:
        self.keyword, self.language = self.keyword.strip(), check_language(self.language).lower()
        if not self.keyword:
            raise _bad("The keyword is blank.")
        check_page(self.offset, self.limit, 50)


@dataclass
class DocumentRequest(_Echo):
    celex: str | None = None
    eli: str | None = None
    work_uri: str | None = None
    resolve: str = "as_requested"
    language: str = "EN"
    format: str = "html"
    content_mode: str = "paged"
    offset: int = 0
    limit: int = WINDOW
    outline: bool = False
    select: dict[str, str] | None = None

    def __post_init__(self) -> None:
        exactly_one(celex=self.celex, eli=self.eli, work_uri=self.work_uri)
        self.celex, self.eli, self.work_uri = given(self.celex), given(self.eli), check_iri(self.work_uri)
        check_choice(self.resolve, ("as_requested", "current_consolidated"))
        check_choice(self.format, ("html", "xml", "markdown"))
        check_choice(self.content_mode, ("paged", "full", "metadata_only"))
        self.language = check_language(self.language or "EN").upper()
        check_page(self.offset, self.limit, WINDOW_MAX)
