"""Tumbling hourly means over a stream, and the keyed sink that takes their updates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from isobar.streaming.stores import state_partitions, upsert_folder


def windowed_means(
    readings: DataFrame,
    ts: str,
    keys: Sequence[str],
    values: Sequence[str],
    width: str = "1 hour",
    delay: str | None = "2 hours",
) -> DataFrame:
    """Mean per key and window. Rows later than the delay are dropped once their window has closed."""
    watched = readings if delay is None else readings.withWatermark(ts, delay)
    return (
        watched.groupBy(*keys, F.window(ts, width).alias("_w"))
        .agg(*[F.avg(v).alias(v) for v in values], F.count(F.lit(1)).alias("n"))
        .select(*keys, F.col("_w.start").alias("timestamp"), *values, "n")
    )


def start_upserts(
    means: DataFrame, folder: str, checkpoint: str, keys: Sequence[str], version: Sequence[str], **trigger
) -> StreamingQuery:
    """Runs in update mode: each batch's changed rows replace the stored ones of the same key."""
    with state_partitions(means.sparkSession):
        return (
            means.writeStream.outputMode("update")
            .option("checkpointLocation", checkpoint)
            .foreachBatch(lambda df, _: upsert_folder(df, folder, keys, version))
            .trigger(**(trigger or {"availableNow": True}))
            .start()
        )


def start_append(means: DataFrame, folder: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Runs in append mode: only windows the watermark has closed are written, once."""
    with state_partitions(means.sparkSession):
        return (
            means.writeStream.outputMode("append")
            .format("parquet")
            .option("path", folder)
            .option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True}))
            .start()
        )
