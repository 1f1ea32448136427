"""Continuous ingest of provider messages into document stores, one query per provider."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.errors import StreamingQueryException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from isobar.operators.reshape import RESHAPERS
from isobar.schemas import TOPICS
from isobar.sources.messages import good_records, parse_envelopes, parsed_once, rejected_records
from isobar.streaming.packing import read_store
from isobar.streaming.stores import run_of, save_new_documents


def distinct_within(documents: DataFrame, delay: str = "2 hours", ts: str = "id_time") -> DataFrame:
    """Drops copies of an id that arrive within the watermark: state is bounded by the delay."""
    return documents.withWatermark(ts, delay).dropDuplicatesWithinWatermark(["_id"])


def ingest_batch(
    records: DataFrame,
    batch_id: int,
    topic: str,
    store: str,
    created_at: Column | None = None,
    run: str | None = None,
) -> None:
    """One micro-batch: good records to the topic's documents, the others to its quarantine.

    `run` names whose batch it is; in a stream that is the query, whose id its checkpoint keeps. Records
    may have been parsed already.
    """
    run = run or run_of(records)
    parsed = parsed_once(records if "envelope" in records.columns else parse_envelopes(records, topic)).persist()
    try:
        documents = RESHAPERS[topic](good_records(parsed), created_at)
        save_new_documents(documents, batch_id, f"{store}/{topic}", run, read_store)
        rejected_records(parsed).write.mode("overwrite").parquet(
            f"{store}/_quarantine/{topic}/run={run}/batch={batch_id}"
        )
    finally:
        parsed.unpersist()


def start_ingest(
    records: DataFrame,
    topic: str,
    store: str,
    checkpoints: str,
    created_at: Column | None = None,
    **trigger,
) -> StreamingQuery:
    """Starts the query of one topic. `availableNow=True` drains what is there and stops."""
    return (
        records.filter(F.col("topic") == topic)
        .writeStream.queryName(f"ingest-{topic}")
        .option("checkpointLocation", f"{checkpoints}/{topic}")
        .foreachBatch(lambda df, batch_id: ingest_batch(df, batch_id, topic, store, created_at))
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def start_all(
    read: Callable[[str], DataFrame], store: str, checkpoints: str, created_at: Column | None = None, **trigger
) -> list[StreamingQuery]:
    """One independent query per topic, each with its own subscription and checkpoint.

    `read` gives the stream of one topic, such as `lambda t: stream_kafka(spark, servers, [t])`, so that
    no topic is read more than once.
    """
    return [start_ingest(read(t), t, store, checkpoints, created_at, **trigger) for t in TOPICS]


def keep_running(start: Callable[[str], StreamingQuery], topics=TOPICS, wait: float = 10.0, restarts: int | None = None) -> None:
    """Runs a query per topic until all have ended, and starts one that failed again after `wait` seconds.

    A query goes on from its checkpoint. `restarts` limits how often each may be started again; the last
    failure is raised then.
    """
    running, left = {t: start(t) for t in topics}, dict.fromkeys(topics, restarts)
    while running:
        for topic, query in list(running.items()):
            try:
                if query.awaitTermination(1):
                    del running[topic]
            except StreamingQueryException:
                if left[topic] == 0:
                    raise
                left[topic] = None if left[topic] is None else left[topic] - 1
                time.sleep(wait)
                running[topic] = start(topic)
