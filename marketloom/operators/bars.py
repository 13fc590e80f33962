"""Roll-ups of time-stamped prices."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def first_per_time(bars: DataFrame, by: str, time: str, order: str) -> DataFrame:
    """One bar per key and time: the first by `order`; an aggregation with map-side combination instead of a sort."""
    rest = [c for c in bars.columns if c not in (by, time)]
    return bars.groupBy(by, time).agg(F.min_by(F.struct(*rest), F.col(order)).alias("_b")).select(by, time, "_b.*")


def daily_ranges(bars: DataFrame, *, by: str, time: str, day: Column, low: str, high: str, open_: str, close: str) -> DataFrame:
    """(by, day, low, low_time, high, high_time, open, close): partial aggregation first, so a hot key costs little in the shuffle.

    Times of low and high are the first ones; open and close are those of the first and last bar.
    """
    t = F.col(time)
    return bars.groupBy(by, day.alias("day")).agg(
        F.min(low).alias("low"), F.min_by(t, F.struct(F.col(low), t)).alias("low_time"),
        F.max(high).alias("high"), F.min_by(t, F.struct(-F.col(high), t)).alias("high_time"),
        F.min_by(open_, t).alias("open"), F.max_by(close, t).alias("close"),
    )


def percent(part: Column, whole: Column) -> Column:
    """100 * part / whole; null unless the whole is positive."""
    return F.when(whole > 0, part / whole * 100)


def with_moves(ranges: DataFrame) -> DataFrame:
    """Range and net move in percent, and the direction: up when the low came no later than the high."""
    return ranges.withColumns({
        "range_pct": percent(F.col("high") - F.col("low"), F.col("low")), "net_pct": percent(F.col("close") - F.col("open"), F.col("open")),
        "direction": F.when(F.col("low_time") <= F.col("high_time"), "up").otherwise("down"),
    })
