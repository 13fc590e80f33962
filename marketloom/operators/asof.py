"""As-of joins.

Both sides are unioned and sorted once by (key, time): one shuffle on the key and one window, whatever the sizes, where a range join would
compare every pair of a key. With `slice_seconds` a key is cut into slices of time, each a window partition of its own, so that a hot
key is many tasks; what the slices before hand on is one row per slice, joined back. Rows without a key or a time match nothing and are spread over tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

SPREAD = 256  # partitions of the rows without a key or a time


def _united(left: DataFrame, right: DataFrame, by: str, left_time: str, right_time: str, prefix: str) -> DataFrame:
    """Both sides as (_k, _t, _p, _l, _r, _side): the key, the time, a part for rows that match nothing, either row, and 0 for left."""
    packed = F.struct(*[F.col(c).alias(prefix + c) for c in right.columns if c != by])
    r_type, l_type = right.select(packed.alias("x")).schema["x"].dataType, left.select(F.struct(*left.columns).alias("x")).schema["x"].dataType
    part = F.when(F.col("_k").isNull() | F.col("_t").isNull(), F.pmod(F.monotonically_increasing_id(), F.lit(SPREAD))).otherwise(0)
    a = left.select(F.col(by).alias("_k"), F.col(left_time).alias("_t"), F.struct(*left.columns).alias("_l"), F.lit(None).cast(r_type).alias("_r"), F.lit(0).alias("_side")).withColumn("_p", part)
    b = right.select(F.col(by).alias("_k"), F.col(right_time).alias("_t"), F.lit(None).cast(l_type).alias("_l"), packed.alias("_r"), F.lit(1).alias("_side")).filter(F.col("_k").isNotNull() & F.col("_t").isNotNull())
    return a.unionByName(b.withColumn("_p", F.lit(0).cast("bigint")))


def _order(back: bool, strict: bool) -> list[Column]:
    """Equal times: right rows come first when they may match, last when they may not; of right rows of one time the smallest comes last and so counts.

    Descending time with the running last value is a forward join without an unbounded following frame.
    """
    side = F.col("_side").desc() if not strict else F.col("_side").asc()
    return [F.col("_t").asc_nulls_first() if back else F.col("_t").desc_nulls_last(), side, F.col("_r").desc_nulls_last()]


def _matched(both: DataFrame, out: str, back: bool, strict: bool, slice_seconds: float | None) -> DataFrame:
    """`both` with the matching right row as column `out`."""
    last = F.last("_r", ignorenulls=True)
    if slice_seconds is None:
        return both.withColumn(out, last.over(Window.partitionBy("_k", "_p").orderBy(*_order(back, strict)).rowsBetween(Window.unboundedPreceding, 0)))
    kind = both.schema["_t"].dataType
    number = F.col("_t") if isinstance(kind, T.NumericType) else F.unix_micros(F.col("_t").cast("timestamp")) / 1e6
    keys = ["_k", "_p", "_slice"]
    sliced = both.withColumn("_slice", F.floor(number / F.lit(float(slice_seconds))))
    order = Window.partitionBy(*keys).orderBy(*_order(back, strict))
    inside = sliced.withColumn(out, last.over(order.rowsBetween(Window.unboundedPreceding, 0))).withColumn("_end", last.over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    ends = inside.groupBy(*keys).agg(F.first("_end").alias("_end"))
    before = Window.partitionBy("_k", "_p").orderBy(F.col("_slice").asc() if back else F.col("_slice").desc()).rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select(*[F.col(c).alias(f"_c{c}") for c in keys], F.last("_end", ignorenulls=True).over(before).alias("_c"))
    same = F.col("_k").eqNullSafe(F.col("_c_k")) & (F.col("_p") == F.col("_c_p")) & F.col("_slice").eqNullSafe(F.col("_c_slice"))
    return inside.join(carried, same, "left").withColumn(out, F.coalesce(out, "_c")).drop("_end", "_slice", "_c", "_c_k", "_c_p", "_c_slice")


def asof_join(left: DataFrame, right: DataFrame, *, by: str, left_time: str, right_time: str, direction: str = "backward", strict: bool = False, tolerance_seconds: float | None = None, prefix: str = "r_", slice_seconds: float | None = None) -> DataFrame:
    """`left` with the columns of the nearest `right` row of the same key at or before (backward) or at or after (forward) its time.

    Right columns get the prefix. `strict` leaves out equal times. Rows without a match, a key or a time keep nulls. Among right
    rows of one time the one with the smallest remaining columns counts. Slices change the plan, never the result.
    """
    both = _united(left, right, by, left_time, right_time, prefix)
    matched = _matched(both, "_m", direction == "backward", strict, slice_seconds).filter(F.col("_side") == 0)
    good = F.col("_k").isNotNull() & F.col("_t").isNotNull()
    if tolerance_seconds is not None:
        gap = F.abs(F.unix_micros(F.col("_t").cast("timestamp")) - F.unix_micros(F.col(f"_m.{prefix}{right_time}").cast("timestamp")))
        good = good & (gap <= F.lit(int(tolerance_seconds * 1e6)))
    return matched.select("_l.*", *[F.when(good, F.col(f"_m.{prefix}{c}")).alias(prefix + c) for c in right.columns if c != by])


def nearest_join(left: DataFrame, right: DataFrame, *, by: str, left_time: str, right_time: str, prefix: str = "r_", slice_seconds: float | None = None) -> DataFrame:
    """`left` with the nearest `right` row in either direction; the earlier one where both are as far. One union and one shuffle serve both directions."""
    both = _matched(_united(left, right, by, left_time, right_time, prefix), "_b", True, False, slice_seconds)
    both = _matched(both, "_f", False, False, slice_seconds).filter(F.col("_side") == 0)
    micros = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    ahead, behind = micros(f"_f.{prefix}{right_time}") - micros("_t"), micros("_t") - micros(f"_b.{prefix}{right_time}")
    pick = F.when(behind.isNotNull() & (ahead.isNull() | (behind <= ahead)), F.col("_b")).otherwise(F.col("_f"))
    picked = both.withColumn("_m", F.when(F.col("_k").isNotNull() & F.col("_t").isNotNull(), pick))
    return picked.select("_l.*", *[F.col(f"_m.{prefix}{c}").alias(prefix + c) for c in right.columns if c != by])


def next_day(days: DataFrame, by: str, day: str) -> DataFrame:
    """(by, day, next_day): each trading day with the one after it."""
    return days.select(by, day).distinct().withColumn("next_day", F.lead(day).over(Window.partitionBy(by).orderBy(day)))


def covers(time: Column, start: Column, seconds: int) -> Column:
    """Whether a bar that begins at `start` covers the time."""
    return (time >= start) & (time < start + F.make_dt_interval(secs=F.lit(seconds)))
