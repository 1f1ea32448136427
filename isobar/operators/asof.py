"""Joins with the nearest reading in time, within a tolerance.

Both series are put into one order, and the last reading is carried along it, forwards and backwards. A series that is longer
than a task should hold is cut into ranges (`ordered.with_slices`); what a range carries into the next ones is one row per range.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from isobar.operators.ordered import TARGET_ROWS, with_slices

DIRECTIONS = ("backward", "forward", "nearest")


def _carried(both: DataFrame, series: Sequence[str], target_rows: int, forward: bool) -> DataFrame:
    """Adds `_before`, the last reading up to a row, and with `forward` `_after`, the first one behind it."""
    sliced = with_slices(both, series, "_ts", ["_left", "_reading"], target_rows=target_rows)
    rows = both if sliced is None else sliced
    inside = Window.partitionBy(*(series if sliced is None else ["_slice"]))
    ahead = inside.orderBy("_ts", "_left", "_reading").rowsBetween(Window.unboundedPreceding, 0)
    back = inside.orderBy(F.desc("_ts"), F.desc("_left"), F.desc("_reading")).rowsBetween(Window.unboundedPreceding, 0)
    found = {"_before": F.last("_reading", ignorenulls=True).over(ahead)}
    if forward:
        found["_after"] = F.last("_reading", ignorenulls=True).over(back)
    rows = rows.withColumns(found)
    if sliced is None:
        return rows
    along = Window.partitionBy(*[F.col(f"_slice.{s}") for s in series]).orderBy(F.col("_slice._part"))
    ends = sliced.groupBy("_slice").agg(F.max("_reading").alias("_newest"), F.min("_reading").alias("_oldest"))
    ends = ends.select(
        "_slice",
        F.last("_newest", ignorenulls=True).over(along.rowsBetween(Window.unboundedPreceding, -1)).alias("_from_before"),
        F.first("_oldest", ignorenulls=True).over(along.rowsBetween(1, Window.unboundedFollowing)).alias("_from_after"),
    )
    rows = rows.join(ends, "_slice", "left").withColumn("_before", F.coalesce("_before", "_from_before"))
    if forward:
        rows = rows.withColumn("_after", F.coalesce("_after", "_from_after"))
    return rows.drop("_slice", "_from_before", "_from_after")


def _within(reading: Column, ts: Column, tolerance: str | None) -> Column:
    if tolerance is None:
        return reading
    apart = F.abs(F.unix_micros(reading["ts"]) - F.unix_micros(ts))
    limit = F.expr(f"unix_micros(TIMESTAMP '1970-01-01 00:00:00Z' + INTERVAL {tolerance})")
    return F.when(apart <= limit, reading)


def asof_join(
    left: DataFrame,
    right: DataFrame,
    series: Sequence[str],
    values: Sequence[str],
    ts: str = "ts",
    direction: str = "nearest",
    tolerance: str | None = None,
    prefix: str = "",
    target_rows: int = TARGET_ROWS,
) -> DataFrame:
    """Each row of `left` with the time and values of one reading of `right` of its series: the last one at or before its time
    (`backward`), the first at or after it (`forward`), or the closer of the two, the earlier one if both are as close.

    Without a reading, or beyond the tolerance, time and values are null. Null is a series like any other. Rows of `left`
    without a time find nothing; readings without a time are not found. Of readings of one time the largest values count
    at or before a row, the smallest after it.
    """
    if direction not in DIRECTIONS:
        raise ValueError(f"unknown direction {direction!r}; use one of {DIRECTIONS}")
    time = F.col(ts).cast("timestamp")
    reading = F.struct(time.alias("ts"), *values)
    rest = [c for c in left.columns if c not in series]
    rows = left.select(*series, F.struct(*[F.col(f"`{c}`") for c in rest]).alias("_row"), time.alias("_ts"), F.lit(1).alias("_left"))
    readings = right.filter(F.col(ts).isNotNull()).select(*series, time.alias("_ts"), F.lit(0).alias("_left"), reading.alias("_reading"))
    both = rows.unionByName(readings, allowMissingColumns=True)
    joined = _carried(both, series, target_rows, direction != "backward").filter("_left = 1")
    before = F.col("_before")
    # Readings of a row's own time come before it in the order, so only the way back finds them.
    own = before["ts"] == F.col("_ts")
    if direction == "backward":
        found = before
    else:
        after = F.col("_after")
        if direction == "forward":
            found = F.when(own, before).otherwise(after)
        else:
            gap = lambda r: F.abs(F.unix_micros(r["ts"]) - F.unix_micros("_ts"))
            closer = after.isNotNull() & (before.isNull() | (gap(after) < gap(before)))
            found = F.when(closer, after).otherwise(before)
    found = _within(F.when(F.col("_ts").isNotNull(), found), F.col("_ts"), tolerance)
    joined = joined.withColumn("_found", found)
    return joined.select(
        *series, "_row.*", F.col("_found.ts").alias(f"{prefix}{ts}_of_reading"), *[F.col(f"_found.{v}").alias(f"{prefix}{v}") for v in values]
    )
