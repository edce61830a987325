"""Pages, ceilings and what is said about rows that a page leaves out."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Row


def page(df: DataFrame, order: list, offset: int, limit: int) -> DataFrame:
    """Rows offset to offset + limit in a total order. Plans as a top-k in each partition, then one merge of these."""
    return df.orderBy(*order).offset(offset).limit(limit) if offset else df.orderBy(*order).limit(limit)


@dataclass
class Page:
    """An eager result: rows, how many, and whether the page is full, so that there may be more."""

    rows: list[Row]
    offset: int = 0
    truncated: bool = False
    cap: int | None = None
    echo: dict[str, object] = field(default_factory=dict)

    @property
    def total(self) -> int:
        return len(self.rows)

    @property
    def shown(self) -> int:
        return len(self.rows)


def fetch(df: DataFrame, offset: int, limit: int, ceiling: int, echo: dict[str, object] | None = None) -> Page:
    """A page's rows; its number of rows is bounded by the ceiling."""
    cap = min(limit, ceiling)
    rows = df.limit(cap).collect()
    return Page(rows, offset, len(rows) >= cap, cap, echo or {})
