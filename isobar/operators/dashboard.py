"""Frames behind the dashboard: history with forecast per metric, and timeline cards."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from isobar.functions.times import hour_of, label, nearest_hour, quarter_hour_of
from isobar.operators.forecast import forecast
from isobar.operators.ordered import newest

# Grain -> (history rows, forecast steps, step).
DASHBOARD_GRAINS = {"hour": (8, 12, "H"), "quarter": (16, 16, "15min")}
METRIC_HEADERS = {
    "temperature": "Temperature",
    "humidity": "Humidity",
    "feels_like": "Feels_Like",
    "precipitation": "Precipitation",
}


def _slot_start(grain: str) -> Column:
    return hour_of("timestamp") if grain == "hour" else quarter_hour_of("timestamp")


def stack_metrics(
    table: DataFrame, columns: Mapping[str, str], keys: Sequence[str], ts: str = "timestamp"
) -> DataFrame:
    """`(keys, metric, timestamp, value)` of several columns in one pass; nulls are left out."""
    cells = [
        F.struct(F.lit(metric).alias("metric"), F.col(c).cast("double").alias("value"))
        for metric, c in columns.items()
    ]
    return table.select(
        *keys, F.col(ts).alias("timestamp"), F.inline(F.array(*cells))
    ).filter(F.col("value").isNotNull())


def history_and_forecast(
    series: DataFrame,
    grain: str,
    keys: Sequence[str] = (),
    parity: bool = False,
) -> DataFrame:
    """`(keys, metric, timestamp, value, kind)`: the tail of every series and its next steps.

    Readings of one time are averaged first. The step follows the grain; under `parity` it is hourly
    for both.
    """
    if grain not in DASHBOARD_GRAINS:
        raise ValueError(f"grain is one of {sorted(DASHBOARD_GRAINS)}")
    history, periods, freq = DASHBOARD_GRAINS[grain]
    ids = [*keys, "metric"]
    single = series.groupBy(*ids, "timestamp").agg(F.avg("value").alias("value"))
    tail = newest(single, history, ids, ["timestamp"]).withColumn("kind", F.lit("history"))
    ahead = (
        forecast(
            single.withColumnsRenamed({"timestamp": "ds", "value": "y"}),
            periods,
            "H" if parity else freq,
            series=ids,
        )
        .withColumnsRenamed({"ds": "timestamp", "yhat": "value"})
        .withColumn("kind", F.lit("forecast"))
    )
    return tail.select(*ids, F.col("timestamp").cast("timestamp"), "value", "kind").unionByName(ahead)


def dashboard_frame(
    series: DataFrame, grain: str, keys: Sequence[str] = (), parity: bool = False
) -> DataFrame:
    """One row per slot with a column per metric, joined on the slot and not by position."""
    rows = history_and_forecast(series, grain, keys, parity)
    slots = rows.withColumn("slot", _slot_start(grain))
    wide = (
        slots.groupBy(*keys, "slot")
        .pivot("metric", list(METRIC_HEADERS))
        .agg(F.avg("value"))
        .withColumnsRenamed(METRIC_HEADERS)
    )
    return wide.select(*keys, "slot", label("slot").alias("Hour"), *METRIC_HEADERS.values())


def data_cards(
    temperature: DataFrame,
    precipitation: DataFrame,
    icon: DataFrame,
    slicing: int,
    mode: str = "quarter",
    keys: Sequence[str] = (),
) -> DataFrame:
    """The last `slicing` slots that have a temperature, a precipitation and an icon.

    Each input is `(keys, timestamp, value)`. Slots are nearest hours or quarter hours.
    """
    if mode not in ("quarter", "hour"):
        raise ValueError("mode is 'quarter' or 'hour'")
    start = nearest_hour("timestamp") if mode == "hour" else quarter_hour_of("timestamp")

    # One grouping of all three: a slot counts if each has a row in it.
    parts = [
        df.select(*keys, "timestamp", F.struct(F.col("value").alias("v")).alias(name))
        for df, name in ((temperature, "_t"), (precipitation, "_p"), (icon, "_i"))
    ]
    together = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    there = [F.bool_or(F.col(c).isNotNull()).alias(f"{c}_there") for c in ("_t", "_p", "_i")]
    cards = (
        together.groupBy(*keys, start.alias("timestamp"))
        .agg(
            F.avg("_t.v").alias("Temperature"),
            F.avg("_p.v").alias("Precipitation"),
            F.max_by("_i.v", F.when(F.col("_i").isNotNull(), F.col("timestamp"))).alias("Icon"),
            *there,
        )
        .filter("_t_there AND _p_there AND _i_there")
        .drop("_t_there", "_p_there", "_i_there")
    )
    return newest(cards, slicing, keys, ["timestamp"]).select(
        *keys, "timestamp", label("timestamp").alias("Hour"), "Temperature", "Precipitation", "Icon"
    )


def card_text(cards: DataFrame) -> DataFrame:
    """Numbers as text with two decimals, rounded by their exact value."""
    return cards.withColumns(
        {
            c: F.call_function("format_number", F.col(c), F.lit("0.00"))
            for c in ("Temperature", "Precipitation")
        }
    )


def feels_like_gap(latest: DataFrame) -> DataFrame:
    """Feels-like minus temperature of a latest-row projection."""
    return latest.withColumn("feels_like_gap", F.round(F.col("feelslike_c") - F.col("temp_c"), 2))
