"""Latest rows, keyed upserts, insert-if-absent and time joins of the serving tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from isobar.functions.times import near_slot
from isobar.operators.ordered import newest
from isobar.schemas import SERVING_METRICS


def sort_by_time(df: DataFrame, *columns: str, descending: bool = False) -> DataFrame:
    return df.orderBy(*[F.desc(c) if descending else F.asc(c) for c in columns])


def latest_row(df: DataFrame, *order: str) -> DataFrame:
    """The newest row: a top-1 per task, then one comparison."""
    return top_newest(df, 1, *order)


def top_newest(df: DataFrame, n: int, *order: str) -> DataFrame:
    return df.orderBy(*[F.desc(c) for c in order]).limit(n)


def latest_per_key(df: DataFrame, keys: Sequence[str], *order: str) -> DataFrame:
    return newest(df, 1, keys, order)


def latest_today_else_latest(df: DataFrame, ts: str, as_of: Column, *tiebreak: str) -> DataFrame:
    """The newest row up to `as_of` on its day, or the newest of all up to it when the day has none."""
    today = F.col(ts) >= F.date_trunc("day", as_of)
    return df.filter(F.col(ts) <= as_of).orderBy(today.desc(), F.desc(ts), *[F.desc(c) for c in tiebreak]).limit(1)


def first_write_wins(df: DataFrame, key: str, *order: str) -> DataFrame:
    """The first row of every key; copies are cut to one per task before the shuffle."""
    window = Window.partitionBy(key).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).filter("_rank = 1").drop("_rank")


def insert_if_absent(incoming: DataFrame, existing: DataFrame, key: str, *order: str) -> DataFrame:
    """Rows to add: the first of each key that the stored table does not hold."""
    return first_write_wins(incoming, key, *order).join(existing.select(key), key, "left_anti")


def upsert_latest(
    existing: DataFrame, incoming: DataFrame, keys: Sequence[str], version: Sequence[str]
) -> DataFrame:
    """Stored and incoming rows merged to one per key: the highest version, incoming on a tie."""
    both = existing.withColumn("_new", F.lit(0)).unionByName(incoming.withColumn("_new", F.lit(1)))
    return newest(both, 1, keys, [*version, "_new"]).drop("_new")


def serving_series(
    table: DataFrame, metric: str, grain: str, keys: Sequence[str] = (), on_slot_only: bool = False
) -> DataFrame:
    """`(keys, timestamp, value)` of one metric. Sort and tail it as needed.

    The summary table has no precipitation or icon; their hourly series are the rows of the quarter
    table near the full hour, which is what `on_slot_only` selects.
    """
    columns = SERVING_METRICS[grain]
    if metric not in columns:
        raise ValueError(f"no {metric!r} in the {grain} table")
    rows = table.filter(near_slot("timestamp", "hourly")) if on_slot_only else table
    return rows.select(*keys, "timestamp", F.col(columns[metric]).alias("value"))


def join_on_time(
    left: DataFrame, right: DataFrame, ts: str = "timestamp", keys: Sequence[str] = ()
) -> DataFrame:
    """Rows of both frames at the same time (and key)."""
    return left.join(right, [*keys, ts], "inner")


def lookup(facts: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """Adds the columns of a dimension with one row per key; unknown keys get nulls.

    Spark broadcasts the dimension if its own size estimate allows it.
    """
    return facts.join(dimension, key, "left")
