"""Temperature history of a city out of a wide table, joined with a newer source."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isobar.functions.ids import concat_id
from isobar.functions.times import append_seconds, shift_zone, t_text
from isobar.operators.aggregate import kelvin_to_celsius
from isobar.operators.ordered import skip_oldest
from isobar.operators.project import cast_column
from isobar.operators.quality import backfill_one, complete_rows

FORM = "yyyy-MM-dd HH:mm:ss"


def city_celsius(wide: DataFrame, city: str, **slicing) -> DataFrame:
    """`(datetime, temperature)` of one city: gaps filled by one step, Celsius, target zone."""
    one = wide.select(
        F.try_to_timestamp("datetime", F.lit(FORM)).alias("ts"), F.col(f"`{city}`").alias("temperature")
    )
    filled = backfill_one(one, "temperature", [], "ts", **slicing)
    local = filled.select(
        t_text(shift_zone("ts")).alias("datetime"),
        kelvin_to_celsius("temperature").alias("temperature"),
    )
    return complete_rows(local)


def newer_celsius(rows: DataFrame, skip: int = 15) -> DataFrame:
    """The newer source without its first hours, which the older one covers."""
    return cast_column(skip_oldest(rows, skip, [], ["datetime"]), "temperature", "double").select(
        "datetime", "temperature"
    )


def city_history(wide: DataFrame, city: str, newer: DataFrame, skip: int = 15, **slicing) -> DataFrame:
    """Both sources as documents: `_id`, `datetime` with seconds and offset, `temperature`."""
    both = city_celsius(wide, city, **slicing).unionByName(newer_celsius(newer, skip))
    stamped = both.withColumn("datetime", append_seconds("datetime", ":00-07"))
    return stamped.select(
        concat_id("datetime", "temperature").alias("_id"), "datetime", "temperature"
    )
