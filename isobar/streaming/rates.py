"""What streams do, batch by batch: accepted, rejected and late rows, lag, and how long a batch took.

Counts are taken where the rows pass anyway (`observe`), so nothing is read for them. A listener writes one row per query and
batch; a batch that is reported again replaces its row.
"""

from __future__ import annotations

import json
import threading

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from isobar.sources.messages import is_good, parse_envelopes
from isobar.streaming.ingest import ingest_batch

#: Names of the numbers a query may observe; what it does not is null.
COUNTS = ("accepted", "rejected", "late", "closed")
SCHEMA = T.StructType([T.StructField("query", T.StringType()), T.StructField("run", T.StringType()), T.StructField("batch", T.LongType())])
for _name in ("reported", "watermark"):
    SCHEMA.add(_name, T.StringType())
for _name in ("input_rows", *COUNTS, "batch_ms"):
    SCHEMA.add(_name, T.LongType())
for _name in ("rows_per_second", "lag_seconds"):
    SCHEMA.add(_name, T.DoubleType())


def observed_messages(parsed: DataFrame) -> DataFrame:
    """Counts good and bad records as they pass; lag is told from the newest record's time."""
    return parsed.observe(
        "rates",
        F.count_if(is_good(parsed)).alias("accepted"),
        F.count_if(~is_good(parsed)).alias("rejected"),
        F.max(F.unix_micros(F.col("timestamp"))).alias("newest"),
    )


class RateListener(StreamingQueryListener):
    """Writes a row per batch of the session's queries to a folder; only queries that observe `rates` are written.

    Batches are reported in turn by one thread of the driver. A row that cannot be written is kept in `failed` and does not
    stop the query.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder
        self.failed: list[tuple[dict, Exception]] = []
        self._ended: dict[str, threading.Event] = {}

    def _ending(self, run: str) -> threading.Event:
        return self._ended.setdefault(run, threading.Event())

    def onQueryStarted(self, event) -> None:
        self._ending(str(event.runId))

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        seen = progress.observedMetrics.get("rates")
        if seen is None:
            return
        counts = seen.asDict()
        newest = counts.get("newest")
        state = json.loads(progress.json)
        reported = F.lit(state["timestamp"])
        row = {
            "query": progress.name or str(progress.id),
            "run": str(progress.runId),
            "batch": progress.batchId,
            "reported": state["timestamp"],
            "watermark": (state.get("eventTime") or {}).get("watermark"),
            "input_rows": progress.numInputRows,
            **{c: counts.get(c) for c in COUNTS},
            "batch_ms": (state.get("durationMs") or {}).get("triggerExecution"),
            "rows_per_second": state.get("processedRowsPerSecond"),
            "lag_seconds": None,
        }
        try:
            rows = self.spark.createDataFrame([row], SCHEMA)
            if newest is not None:
                rows = rows.withColumn("lag_seconds", F.unix_micros(reported.cast("timestamp")) / 1e6 - F.lit(newest) / 1e6)
            folder = f"{self.folder}/query={row['query']}/batch={row['batch']}"
            rows.drop("query", "batch").coalesce(1).write.mode("overwrite").json(folder)
        except Exception as error:  # noqa: BLE001 - a report must not stop a query
            self.failed.append((row, error))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._ending(str(event.runId)).set()

    def wait(self, query: StreamingQuery, seconds: float = 60.0) -> bool:
        """Waits until all batches of a query that has ended are written."""
        return self._ending(str(query.runId)).wait(seconds)


def read_rates(spark: SparkSession, folder: str) -> DataFrame:
    """One row per query and batch."""
    return spark.read.schema(SCHEMA).json(folder)


def start_measured_ingest(
    records: DataFrame, topic: str, store: str, checkpoints: str, created_at: Column | None = None, **trigger
) -> StreamingQuery:
    """`ingest.start_ingest` with its records counted as they are parsed, once for both."""
    parsed = observed_messages(parse_envelopes(records.filter(F.col("topic") == topic), topic))
    return (
        parsed.writeStream.queryName(f"ingest-{topic}")
        .option("checkpointLocation", f"{checkpoints}/{topic}")
        .foreachBatch(lambda df, batch_id: ingest_batch(df, batch_id, topic, store, created_at))
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
