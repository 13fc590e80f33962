"""Null handling, ordering and time rules that every plan shares."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MARKET_ZONE = "America/New_York"


def overlaps(array: Column, values: list[str] | Column) -> Column:
    """Whether the array shares an element with the values; false, never null, where either is null."""
    other = values if isinstance(values, Column) else F.array(*map(F.lit, values))
    return F.coalesce(F.arrays_overlap(F.array_compact(array), F.array_compact(other)), F.lit(False))


def contains(array: Column, value: Column | str) -> Column:
    """Whether the array holds the value; false where the array is null."""
    return F.coalesce(F.array_contains(F.array_compact(array), value if isinstance(value, Column) else F.lit(value)), F.lit(False))


def stripped(c: Column) -> Column:
    """Without white space at its ends, no-break spaces included."""
    return F.regexp_replace(c, r"^[\s\u00a0]+|[\s\u00a0]+$", "")


def blank_to_null(c: Column) -> Column:
    trimmed = stripped(c)
    return F.when(trimmed != "", trimmed)


def collapsed(c: Column) -> Column:
    """Every run of white space one blank, none outside."""
    return F.trim(F.regexp_replace(c, r"[\s\u00a0]+", " "))


def array_or_null(c: Column) -> Column:
    """Null in place of an empty array."""
    return F.when(F.size(c) > 0, c)


def differs(a: Column, b: Column) -> Column:
    """SQL's IS DISTINCT FROM."""
    return ~a.eqNullSafe(b)


def market_time(ts: Column) -> Column:
    """An instant as wall-clock time of the exchange (session time zone UTC)."""
    return F.from_utc_timestamp(ts, MARKET_ZONE)


def market_date(ts: Column) -> Column:
    return F.to_date(market_time(ts))


def session_of(ts: Column) -> Column:
    """premarket [4:00, 9:30), regular [9:30, 16:00), after_hours [16:00, 20:00), else closed; by the exchange's clock."""
    local = market_time(ts)
    minute = F.hour(local) * 60 + F.minute(local)
    return F.when(minute.between(240, 569), "premarket").when(minute.between(570, 959), "regular").when(minute.between(960, 1199), "after_hours").when(minute.isNotNull(), "closed")


def feed_time(text: Column) -> Column:
    """The instant a feed's text names, in any of its spellings, or null."""
    plain = F.regexp_replace(stripped(text), "Z$", "+00:00")
    return F.coalesce(F.try_to_timestamp(plain, F.lit("yyyy-MM-dd'T'HH:mm:ssXXX")), F.try_to_timestamp(plain, F.lit("yyyy-MM-dd HH:mm:ss")), F.try_to_timestamp(plain, F.lit("yyyy-MM-dd")))


def backoff_seconds(attempts: Column, base: int = 30, most: int = 3600) -> Column:
    """Exponential delay before the next attempt."""
    return F.least(F.lit(float(base)) * F.pow(F.lit(2.0), attempts), F.lit(float(most))).cast("long")


def months_before(ts: Column, months: int) -> Column:
    """The same time of day `months` calendar months earlier, the day clamped to the month's length."""
    return ts - F.make_interval(months=F.lit(months))


def bucketed(value: Column, edges: list[float], labels: list[str]) -> Column:
    """labels[i] for values under edges[i], the last label for the others; null stays null."""
    out = F.when(value < edges[0], labels[0])
    for edge, label in zip(edges[1:], labels[1:]):
        out = out.when(value < edge, label)
    return out.when(value.isNotNull(), labels[len(edges)])
