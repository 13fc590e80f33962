"""Composable filters of the searches."""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

from marketloom.semantics import contains, overlaps

DATE_ONLY = re.compile(r"^\d{4}-\d{2}-\d{2}$")


@dataclass(frozen=True)
class SearchFilter:
    """Conditions on an article; unset ones do not restrict. A date alone as `until` includes the whole day unless it is exclusive."""

    tickers: tuple[str, ...] = field(default=())
    segment: str | None = None
    domain: str | None = None
    since: str | None = None
    until: str | None = None
    until_exclusive: bool = False
    exclude_id: int | None = None

    def column(self, prefix: str = "") -> Column:
        c = lambda name: F.col(prefix + name)
        out = F.lit(True)
        if self.tickers:
            out = out & overlaps(c("tickers"), [t.upper() for t in self.tickers])
        if self.segment is not None:
            out = out & (F.coalesce(c("primary_segment") == self.segment, F.lit(False)) | contains(c("more_segments"), self.segment))
        if self.domain is not None:
            out = out & (c("source_domain") == self.domain.lower())
        if self.since is not None:
            out = out & (c("published_utc") >= F.to_timestamp(F.lit(self.since)))
        if self.until is not None:
            end = F.to_timestamp(F.lit(self.until))
            if self.until_exclusive:
                out = out & (c("published_utc") < end)
            elif DATE_ONLY.match(self.until):
                out = out & (c("published_utc") < end + F.expr("interval 1 day"))
            else:
                out = out & (c("published_utc") <= end)
        if self.exclude_id is not None:
            out = out & (c("id") != self.exclude_id)
        return out


def scoped(scope: str | None, value: str | None) -> SearchFilter:
    """The filter of a statement's scope: one ticker, one segment, or the whole sector."""
    kind = (scope or "sector").strip().lower()
    makers = {"sector": lambda _: SearchFilter(), "ticker": lambda v: SearchFilter(tickers=(v,)), "segment": lambda v: SearchFilter(segment=v)}
    if kind not in makers or kind != "sector" and not value:
        raise ValueError(f"a scope of {kind!r} with the value {value!r} says nothing")
    return makers[kind](value)
