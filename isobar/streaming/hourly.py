"""The hourly aggregate over all providers as watermarked streams, one per provider."""

from __future__ import annotations

import threading
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from isobar.functions.times import parse_reading_time
from isobar.operators.aggregate import fix_kelvin_by_day, group_means
from isobar.operators.project import standardize_names, with_location
from isobar.operators.reshape import SOURCE_COLUMNS, flatten_by_leaf, provider_documents
from isobar.schemas import COMMON_MEASURES, PLACE_COLUMNS, TOPICS
from isobar.streaming.stores import (
    read_folder,
    replace_partitions,
    rows_per_day,
    spread_by_day,
    state_partitions,
    upsert_folder,
)
from isobar.streaming.windows import windowed_means

HOUR_KEYS = ("provider", *PLACE_COLUMNS, "timestamp")
# The queries of one driver publish in turn: none reads hours that another is replacing, and the last has
# seen the hours of all.
_PUBLISHING = threading.Lock()


def stream_observations(records: DataFrame, topic: str, zone: str | None = None) -> DataFrame:
    """Readings of one provider in the columns that all share; what it lacks is null.

    In a batch the common columns depend on which providers are there. A stream cannot change its
    columns, so they are declared.
    """
    documents = provider_documents(records, topic, F.col("timestamp"))
    flat = flatten_by_leaf(documents.drop(*SOURCE_COLUMNS))
    located = with_location(standardize_names(flat, keep=("_id", "name")))
    return located.select(
        F.lit(topic).alias("provider"),
        "_id",
        *PLACE_COLUMNS,
        parse_reading_time("date", zone).alias("timestamp"),
        *[F.col(c).cast("double").alias(c) for c in COMMON_MEASURES],
    )


def provider_windows(
    records: DataFrame, topic: str, zone: str | None = None, delay: str = "2 hours"
) -> DataFrame:
    """Hourly means per place of one provider's readings, each counted once per id.

    The watermark is the provider's own: one that is hours behind loses nothing to the others.
    """
    readings = stream_observations(records, topic, zone).withWatermark("timestamp", delay)
    once = readings.dropDuplicatesWithinWatermark(["provider", "_id"])
    return windowed_means(
        once, "timestamp", ["provider", *PLACE_COLUMNS], COMMON_MEASURES, delay=None
    )


def publish_hours(batch: DataFrame, topic: str, folder: str) -> None:
    """Merges a batch of one provider's hours, then renews the cross-provider means of its days."""
    schema = batch.schema.add("event_date", "date")
    with _PUBLISHING:
        days = upsert_folder(batch, f"{folder}/hours/{topic}", HOUR_KEYS, ["n"])
        if not days:
            return
        parts = [read_folder(batch.sparkSession, f"{folder}/hours/{t}", schema, "event_date", days) for t in TOPICS]
        stored = reduce(DataFrame.unionByName, parts)
        celsius = fix_kelvin_by_day(stored, "provider", "event_date", "n")
        means = group_means(
            celsius, [*PLACE_COLUMNS, "timestamp", "event_date"], COMMON_MEASURES, prefix="avg_"
        )
        counts = rows_per_day(stored, "event_date")
        spread = spread_by_day(means, "event_date", counts, [*PLACE_COLUMNS, "timestamp"])
        replace_partitions(spread, f"{folder}/summary", "event_date")


def start_hourly_aggregate(
    read: Callable[[str], DataFrame],
    folder: str,
    checkpoints: str,
    zone: str | None = None,
    delay: str = "2 hours",
    **trigger,
) -> list[StreamingQuery]:
    """Keeps `hours` and `summary` below the folder current; one query per topic, as in ingest.

    `read` gives the stream of one topic.
    """

    def start(topic: str) -> StreamingQuery:
        windows = provider_windows(read(topic), topic, zone, delay)
        with state_partitions(windows.sparkSession):
            return (
                windows.writeStream.queryName(f"hourly-{topic}")
                .outputMode("update")
                .option("checkpointLocation", f"{checkpoints}/{topic}")
                .foreachBatch(lambda df, _: publish_hours(df, topic, folder))
                .trigger(**(trigger or {"availableNow": True}))
                .start()
            )

    return [start(topic) for topic in TOPICS]
