"""Backfills and incremental updates of the two serving tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from isobar.functions.times import (
    CREATED_FORM,
    hour_of,
    near_slot,
    parse_mixed_time,
    parse_reading_time,
    quarter_hour_of,
)
from isobar.operators.aggregate import group_means
from isobar.operators.project import (
    drop_present,
    pick,
    strip_prefix,
    summary_from_aggregate,
    weather_data_rows,
    weather_summary_rows,
    where_equal,
    without_rows,
)
from isobar.operators.quality import distinct_rows
from isobar.operators.reshape import flatten_by_leaf
from isobar.operators.serving import latest_today_else_latest
from isobar.schemas import PLACE_COLUMNS, WEATHER_DATA_DEFAULTS
from isobar.streaming.stores import upsert_folder

# Columns of stored aggregates that are no measures.
AGGREGATE_EXTRAS = ("_id", "_rev", "avg_date", "fields", "created_at", "reduce", "language")
READING_EXTRAS = (
    "_id", "_rev", "created_at", "tz_id", "last_updated", "last_updated_epoch", "localtime_epoch",
)
DATA_KEYS = ("name", "lat", "lon", "timestamp")
SUMMARY_KEYS = ("location_name", "latitude", "longitude", "timestamp")


def summary_backfill(
    aggregates: DataFrame,
    rejects: DataFrame | None = None,
    latitude: float | None = None,
    ts: str = "timestamp",
) -> DataFrame:
    """Stored hourly aggregates as summary rows: one per place and hour, newest first."""
    good = aggregates if rejects is None else without_rows(aggregates, rejects, ["_id"])
    plain = distinct_rows(drop_present(good, *AGGREGATE_EXTRAS))
    timed = plain.withColumn(ts, F.try_to_timestamp(F.col(ts).cast("string")))
    means = strip_prefix(group_means(timed, [*PLACE_COLUMNS, ts]))
    kept = means if latitude is None else where_equal(means, "latitude", latitude)
    # Places break ties, so that an hour that many share is no single range of the sort.
    return kept.orderBy(F.desc(ts), *PLACE_COLUMNS)


def data_backfill(
    documents: DataFrame, rejects: DataFrame | None = None, zone: str | None = None, tolerance: int = 2
) -> DataFrame:
    """free-weather documents near a quarter hour as serving rows, newest first.

    Rows whose local time does not parse are left out.
    """
    flat = flatten_by_leaf(documents)
    good = flat if rejects is None else without_rows(flat, rejects, ["_id"])
    timed = good.withColumn("_ts", parse_reading_time("localtime", zone)).filter(
        F.col("_ts").isNotNull() & near_slot("_ts", "quarter", tolerance)
    )
    plain = distinct_rows(drop_present(timed, *READING_EXTRAS)).drop("localtime")
    rows = plain.withColumn("timestamp", quarter_hour_of("_ts")).drop("_ts")
    names = list(WEATHER_DATA_DEFAULTS)
    return pick(rows, [*names[:6], "timestamp", *names[6:]]).orderBy(F.desc("timestamp"), *DATA_KEYS[:3])


def newest_reading(documents: DataFrame, as_of: Column) -> DataFrame:
    """The newest document of today, else the newest, with its leaves as columns."""
    flat = flatten_by_leaf(documents)
    timed = flat.withColumn("_created", F.try_to_timestamp("created_at", F.lit(CREATED_FORM)))
    return latest_today_else_latest(timed, "_created", as_of, "_id").drop("_created")


def _serving_time(flat: DataFrame, grain: str, as_of: Column, zone: str | None, parity: bool) -> Column:
    if parity:
        return F.date_trunc("minute", as_of)
    read_at = parse_mixed_time("last_updated", zone)
    return hour_of(read_at) if grain == "hour" else quarter_hour_of(read_at)


def increment_rows(
    documents: DataFrame, grain: str, as_of: Column, zone: str | None = None, parity: bool = False
) -> DataFrame:
    """Serving row of the newest reading.

    Its time is the reading's own, cut to the grain, or under `parity` the minute of the run.
    """
    if grain not in ("hour", "quarter"):
        raise ValueError("grain is 'hour' or 'quarter'")
    flat = newest_reading(documents, as_of)
    ts = _serving_time(flat, grain, as_of, zone, parity)
    rows = weather_data_rows if grain == "quarter" else weather_summary_rows
    return rows(flat, ts)


def update_serving(
    documents: DataFrame, folder: str, grain: str, as_of: Column, zone: str | None = None, parity: bool = False
) -> None:
    """Upserts the newest reading into the serving folder of the grain."""
    keys = DATA_KEYS if grain == "quarter" else SUMMARY_KEYS
    upsert_folder(increment_rows(documents, grain, as_of, zone, parity), folder, keys, [])


def update_summary(aggregate: DataFrame, folder: str, keys: Sequence[str] = SUMMARY_KEYS) -> None:
    """Upserts cross-provider hourly means into the summary folder."""
    upsert_folder(summary_from_aggregate(aggregate), folder, keys, [])
