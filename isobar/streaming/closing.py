"""Hourly means that close by timer, and a side table of the rows that come after.

A watermarked aggregation drops what is too late without a trace. Here each key and hour has a state of its own: it sums up while
the hour is open, an event-time timer closes it when the watermark passes its end, and later rows are put aside one by one. So
every row that came in is in a closed hour, in an open one, or in the side table.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

from isobar.streaming.stores import read_folder, state_partitions

HOUR_MS = 3_600_000
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def keyed_state(spark: SparkSession):
    """Queries that are started inside keep their state in RocksDB, which state of several variables needs, one store per core."""
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name, None)
    spark.conf.set(name, ROCKSDB)
    try:
        with state_partitions(spark):
            yield
    finally:
        spark.conf.set(name, before) if before else spark.conf.unset(name)


def _counts(values: Sequence[str]) -> list[str]:
    return [f"{v}_n" for v in values]


def _totals(values: Sequence[str]) -> list[str]:
    return [f"{v}_sum" for v in values]


class HourCloser(StatefulProcessor):
    """State of one key and hour: rows, and per value how many are known and their sum."""

    def __init__(self, keys: int, values: Sequence[str]):
        self.keys = keys
        self.values = list(values)

    def init(self, handle) -> None:
        self.handle = handle
        columns = ["n LONG", *[f"{c} LONG" for c in _counts(self.values)], *[f"{c} DOUBLE" for c in _totals(self.values)]]
        self.sums = handle.getValueState("sums", ", ".join(columns))

    def _end(self, key: tuple) -> int:
        return (int(key[-1]) + 1) * HOUR_MS

    def _row(self, key: tuple, kind: str, micros, sums: Sequence) -> list:
        return [*key, kind, micros, *sums]

    def _frame(self, rows: list[list]) -> pd.DataFrame:
        names = [*[f"k{i}" for i in range(self.keys)], "hour", "kind", "micros", "n", *_counts(self.values), *_totals(self.values)]
        return pd.DataFrame(rows, columns=names)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        late = self._end(key) <= timerValues.getCurrentWatermarkInMs()
        n, counts, totals = 0, [0] * len(self.values), [0.0] * len(self.values)
        for pdf in rows:
            if late:
                known = pdf[self.values].notna()
                parts = zip(pdf["micros"], known.values.tolist(), pdf[self.values].fillna(0.0).values.tolist(), strict=True)
                yield self._frame([self._row(key, "late", t, [1, *map(int, k), *x]) for t, k, x in parts])
                continue
            n += len(pdf)
            counts = [a + int(b) for a, b in zip(counts, pdf[self.values].count(), strict=True)]
            totals = [a + float(b) for a, b in zip(totals, pdf[self.values].sum(), strict=True)]
        if late:
            return
        before = self.sums.get()
        if before is None:
            self.handle.registerTimer(self._end(key))
            before = [0] * (1 + 2 * len(self.values))
        self.sums.update(tuple(type(b)(a) + b for a, b in zip(before, [n, *counts, *totals], strict=True)))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        sums = self.sums.get()
        self.sums.clear()
        yield self._frame([self._row(key, "closed", None, [int(sums[0]), *sums[1:]])])

    def close(self) -> None:
        pass


def _shape(keys: Sequence[T.StructField], values: Sequence[str]) -> T.StructType:
    shape = T.StructType([T.StructField(f"k{i}", k.dataType) for i, k in enumerate(keys)])
    shape.add("hour", "long").add("kind", "string").add("micros", "long").add("n", "long")
    for c in _counts(values):
        shape.add(c, "long")
    for c in _totals(values):
        shape.add(c, "double")
    return shape


def closing_hours(readings: DataFrame, ts: str, keys: Sequence[str], values: Sequence[str], delay: str = "2 hours") -> DataFrame:
    """Stream of closed hours and late rows: keys, timestamp (of the hour), kind, ts (of a late row), n, and a count and a sum per
    value. `kind` is `closed` or `late`.

    Rows without a time have no hour and are left out. A key is a place and an hour, so a busy place is as many keys as hours.
    """
    fields = [readings.schema[k] for k in keys]
    watched = readings.filter(F.col(ts).isNotNull()).withWatermark(ts, delay)
    # As a number the time is no event time any more, so rows behind the watermark are not dropped before they are seen.
    micros = F.unix_micros(F.col(ts).cast("timestamp"))
    rows = watched.select(
        *[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)],
        F.floor(micros / (1000 * HOUR_MS)).cast("long").alias("hour"),
        micros.alias("micros"),
        *[F.col(v).cast("double").alias(v) for v in values],
    )
    names = [f"k{i}" for i in range(len(keys))]
    found = rows.groupBy(*names, "hour").transformWithStateInPandas(
        HourCloser(len(keys), values), _shape(fields, values), "Append", "EventTime"
    )
    return found.select(
        *[F.col(n).alias(k) for n, k in zip(names, keys, strict=True)],
        F.timestamp_seconds(F.col("hour") * 3600).alias("timestamp"),
        "kind",
        F.timestamp_micros("micros").alias("ts"),
        "n",
        *_counts(values),
        *_totals(values),
    )


def start_closing_hours(
    readings: DataFrame, ts: str, keys: Sequence[str], values: Sequence[str], folder: str, checkpoint: str, delay: str = "2 hours", **trigger
) -> StreamingQuery:
    """Writes closed hours and late rows below the folder, by kind and batch; a batch that is run again replaces its own files."""

    def save(batch: DataFrame, batch_id: int) -> None:
        own = batch.withColumn("batch", F.lit(batch_id))
        own.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("kind", "batch").parquet(folder)

    with keyed_state(readings.sparkSession):
        return (
            observed_hours(closing_hours(readings, ts, keys, values, delay))
            .writeStream.option("checkpointLocation", checkpoint)
            .foreachBatch(save)
            .trigger(**(trigger or {"availableNow": True}))
            .start()
        )


def observed_hours(hours: DataFrame) -> DataFrame:
    """Counts late rows, and the rows of closed hours, as they pass; `rates.RateListener` writes them."""
    kind = F.col("kind")
    closed = F.coalesce(F.sum(F.when(kind == "closed", F.col("n"))), F.lit(0))
    return hours.observe("rates", F.count_if(kind == "late").alias("late"), closed.alias("closed"))


def saved_rows(spark: SparkSession, folder: str, keys: Sequence[T.StructField], values: Sequence[str], kind: str) -> DataFrame:
    """Closed hours or late rows that were written; no rows when there are none."""
    schema = T.StructType([*keys, T.StructField("timestamp", T.TimestampType())]).add("ts", "timestamp").add("n", "long")
    for c in _counts(values):
        schema.add(c, "long")
    for c in _totals(values):
        schema.add(c, "double")
    return read_folder(spark, folder, schema.add("kind", "string").add("batch", "long")).filter(F.col("kind") == kind)


def open_hours(spark: SparkSession, checkpoint: str, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """What the state of a stopped query holds: hours that no timer has closed yet."""
    state = spark.read.format("statestore").option("path", checkpoint).option("stateVarName", "sums").load()
    return state.select(
        *[F.col(f"key.k{i}").alias(k) for i, k in enumerate(keys)],
        F.timestamp_seconds(F.col("key.hour") * 3600).alias("timestamp"),
        *[F.col(f"value.{c}").alias(c) for c in ("n", *_counts(values), *_totals(values))],
    )


def means(hours: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Mean per key and hour of rows of sums, such as closed hours, or closed hours and late rows together."""

    def mean(v: str) -> Column:
        return F.try_divide(F.sum(f"{v}_sum"), F.sum(f"{v}_n")).alias(v)

    return hours.groupBy(*keys, "timestamp").agg(*[mean(v) for v in values], F.sum("n").alias("n"))
