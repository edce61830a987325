"""Typed failures. Operators are lazy and total; only the eager entry points raise these."""

from __future__ import annotations

#: reason -> what to try next; the same text in failures and in documentation.
RECOVERY = {
    "no_filters": "Give at least one filter: a keyword, type, date, subject, author or in-force status.",
    "no_results": "Widen the dates, drop a filter or try another spelling.",
    "invalid_identifier_args": "Give exactly one identifier.",
    "ambiguous_identifier": "Name the identifier's type.",
    "not_found": "Check the identifier, or search for the document.",
    "no_relations": "Ask for other relation types.",
    "no_concepts": "Try a broader keyword or another language.",
    "not_read_only": "Only queries are allowed: one SELECT, VALUES or WITH statement.",
    "query_error": "Correct the statement and run it again.",
    "query_timeout": "Narrow the query or allow more time.",
    "invalid_argument": "Correct the argument's form or range.",
    "challenge": "The stored body is an access challenge, not a document; load it again.",
}


class RequestError(Exception):
    """A request that can't be served, with a reason from RECOVERY."""

    def __init__(self, reason: str, message: str, **details: object):
        super().__init__(f"{message} {RECOVERY[reason]}")
        self.reason, self.recovery, self.details = reason, RECOVERY[reason], details
