"""Streams over the events table, drained to the end."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isobar.functions.times import JAKARTA
from isobar.operators.reshape import provider_documents
from isobar.queries.documents import SQL_AGGREGATE
from isobar.queries.feed import SQL_DOCS, SQL_ID, message_log, spread_log
from isobar.queries.registry import events, ntz, query, r6, r8, table
from isobar.schemas import COMMON_MEASURES, TOPICS
from isobar.session import shared_folder
from isobar.streaming.closing import means, open_hours, saved_rows, start_closing_hours
from isobar.streaming.first_write import start_first_write
from isobar.streaming.hourly import start_hourly_aggregate
from isobar.streaming.ingest import distinct_within, ingest_batch, start_all
from isobar.streaming.packing import drop_packed, pack_days, read_store
from isobar.streaming.rates import RateListener, read_rates, start_measured_ingest
from isobar.streaming.stores import document_schema, read_documents, state_partitions, upsert_folder
from isobar.streaming.versions import VersionedTable
from isobar.streaming.windows import start_upserts, windowed_means


def thirds(df: DataFrame, ts: str, parts: int = 3) -> list[DataFrame]:
    """The rows by time, in parts of equal width; the last one holds the end."""
    low, high = df.agg(F.min(ts), F.max(ts)).first()
    if low is None:
        return [df]
    edges = [low + k * (high - low) / parts for k in range(1, parts)]
    tests = [F.lit(True), *[F.col(ts) >= F.lit(e) for e in edges]]
    before = [*[F.col(ts) < F.lit(e) for e in edges], F.lit(True)]
    return [df.filter(a & b) for a, b in zip(tests, before, strict=True)]


def drain_in_turn(parts: Sequence[DataFrame], folder: str, start: Callable[[], list], *by: str) -> None:
    """Lands one part after the other, with all tasks, and lets the queries drain each before the next one comes.

    The queries go on from their checkpoints, so every part is a batch that comes later than the one before.
    """
    for part in parts:
        part.write.mode("append").partitionBy(*by).parquet(folder)
        _drain(*start())


def landed(spark, schema, path: str) -> DataFrame:
    return spark.readStream.schema(schema).parquet(path)


def by_topic(spark, log: DataFrame, folder: str):
    """Gives the stream of one topic of a log that is landed by topic."""

    def read(topic: str) -> DataFrame:
        rows = landed(spark, log.drop("topic").schema, f"{folder}/topic={topic}")
        return rows.withColumn("topic", F.lit(topic)).select(*log.columns)

    return read


def _drain(*queries) -> None:
    for q in queries:
        q.awaitTermination()


@query(
    "windowed_mean_stream",
    """SELECT event_type, date_trunc('hour', ts) AS timestamp, round(avg(value), 8) AS value, count(*) AS n
    FROM events GROUP BY ALL""",
)
def windowed_mean_stream(spark, sf):
    """Hourly means of a stream that is drained in three parts, kept current in a keyed folder by update mode."""
    folder = shared_folder(spark, "windows")
    rows = events(spark, sf).select("event_type", "ts", "value")

    def start():
        means = windowed_means(landed(spark, rows.schema, f"{folder}/in"), "ts", ["event_type"], ["value"])
        return [start_upserts(means, f"{folder}/table", f"{folder}/checkpoint", ["event_type", "timestamp"], ["n"])]

    drain_in_turn(thirds(rows, "ts"), f"{folder}/in", start)
    return spark.read.parquet(f"{folder}/table").select(
        "event_type", ntz("timestamp").alias("timestamp"), r8("value").alias("value"), "n"
    )


_SQL_STORED = f"SELECT topic, {SQL_ID} AS _id, event_id AS \"offset\" FROM {SQL_DOCS}"


def _stored(spark, sf, folder) -> DataFrame:
    parts = []
    for topic in TOPICS:
        schema = document_schema(provider_documents(message_log(spark, sf), topic))
        docs = read_documents(spark, f"{folder}/{topic}", schema)
        parts.append(docs.select(F.lit(topic).alias("topic"), "_id", "offset"))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("stream_ingest", _SQL_STORED)
def stream_ingest(spark, sf):
    """Three ingest queries over one log; first write per id wins."""
    folder = shared_folder(spark, "ingest")
    log = message_log(spark, sf)
    log.write.partitionBy("topic").parquet(f"{folder}/log")
    _drain(*start_all(by_topic(spark, log, f"{folder}/log"), folder, f"{folder}/checkpoints", F.col("timestamp")))
    return _stored(spark, sf, folder)


@query("replayed_ingest", _SQL_STORED)
def replayed_ingest(spark, sf):
    """The same log ingested twice, one batch of it again as after a failure: nothing is added."""
    folder = shared_folder(spark, "replay")
    log = spread_log(spark, sf)
    for batch_id, topics in ((0, TOPICS), (1, TOPICS), (0, TOPICS[1:2])):
        for topic in topics:
            ingest_batch(log, batch_id, topic, folder, F.col("timestamp"))
    return _stored(spark, sf, folder)


@query("restarted_ingest", _SQL_STORED)
def restarted_ingest(spark, sf):
    """A log ingested in two batches, then by a query with a new checkpoint, in other batches and without
    its first part, which the log no longer holds: what was stored stays."""
    folder = shared_folder(spark, "restart")
    log = spread_log(spark, sf)
    last = log.agg(F.max("offset")).first()[0]
    offset = F.col("offset")
    half, gone = last // 2, last // 4
    for topic in TOPICS:
        ingest_batch(log.filter(offset <= half), 0, topic, folder, F.col("timestamp"), "first")
        ingest_batch(log.filter(offset > half), 1, topic, folder, F.col("timestamp"), "first")
        for batch, (low, high) in enumerate(((gone, half + gone), (half + gone, last))):
            part = log.filter((offset > low) & (offset <= high))
            ingest_batch(part, batch, topic, folder, F.col("timestamp"), "second")
    return _stored(spark, sf, folder)


@query("ids_in_state", _SQL_STORED)
def ids_in_state(spark, sf):
    """First write wins without reading the store: a log in two parts, then all of it again but its first quarter by a query with a
    new checkpoint, whose state starts from the stored ids."""
    folder = shared_folder(spark, "first")
    log = message_log(spark, sf)
    last = log.agg(F.max("offset")).first()[0]
    offset = F.col("offset")

    def start(source: str, checkpoint: str, known: bool):
        read = by_topic(spark, log, f"{folder}/{source}")

        def ids(topic: str):
            schema = document_schema(provider_documents(log, topic))
            return read_documents(spark, f"{folder}/{topic}", schema).select("_id", "id_time")

        return [
            start_first_write(read(t), t, folder, f"{folder}/{checkpoint}", ids(t) if known else None, created_at=F.col("timestamp"))
            for t in TOPICS
        ]

    drain_in_turn([log.filter(offset <= last // 2), log.filter(offset > last // 2)], f"{folder}/log", lambda: start("log", "c1", False), "topic")
    drain_in_turn([log.filter(offset > last // 4)], f"{folder}/again", lambda: start("again", "c2", True), "topic")
    return _stored(spark, sf, folder)


@query(
    "distinct_within_watermark",
    f"SELECT {SQL_ID} AS _id FROM {SQL_DOCS} WHERE topic = 'open-weather'",
)
def distinct_within_watermark(spark, sf):
    """Copies dropped by bounded state alone, in a stream."""
    folder = shared_folder(spark, "distinct")
    log = message_log(spark, sf).filter("topic = 'open-weather'")

    def start():
        docs = provider_documents(by_topic(spark, log, f"{folder}/log")("open-weather"), "open-weather", F.col("timestamp"))
        ids = distinct_within(docs, "2 hours").select("_id").writeStream.format("parquet").option("path", f"{folder}/ids")
        with state_partitions(spark):
            return [ids.option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start()]

    drain_in_turn(thirds(log, "timestamp"), f"{folder}/log", start, "topic")
    return spark.read.parquet(f"{folder}/ids")


@query("hourly_aggregate_stream", SQL_AGGREGATE)
def hourly_aggregate_stream(spark, sf):
    """The hourly aggregate over providers, from a drained stream of messages."""
    folder = shared_folder(spark, "hourly")
    log = message_log(spark, sf)
    read = by_topic(spark, log, f"{folder}/log")
    drain_in_turn(
        thirds(log, "timestamp"), f"{folder}/log", lambda: start_hourly_aggregate(read, folder, f"{folder}/checkpoint", JAKARTA), "topic"
    )
    summary = spark.read.parquet(f"{folder}/summary").drop("event_date")
    return summary.withColumns(
        {"timestamp": ntz("timestamp"), **{f"avg_{c}": r6(f"avg_{c}") for c in COMMON_MEASURES}}
    )


@query(
    "upsert_folder",
    """SELECT user_id, date_trunc('hour', ts) AS timestamp, arg_max(value, ts) AS value
    FROM events GROUP BY ALL""",
)
def upsert_folder_latest(spark, sf):
    """The latest reading per place and hour, merged into a folder in two batches."""
    folder = shared_folder(spark, "upserts")
    rows = table(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    keyed = rows.select("user_id", F.date_trunc("hour", "ts").alias("timestamp"), "ts", "value", "event_type")
    early = F.col("event_type").isin("click", "view")
    upsert_folder(keyed.filter(~early).drop("event_type"), folder, ["user_id", "timestamp"], ["ts"])
    upsert_folder(keyed.filter(early).drop("event_type"), folder, ["user_id", "timestamp"], ["ts"])
    return spark.read.parquet(folder).select("user_id", ntz("timestamp").alias("timestamp"), "value")


@query(
    "late_rows_kept",
    """WITH e AS (SELECT event_type, value, event_id % 10 = 0 AS behind, ts, date_trunc('hour', ts) AS timestamp FROM events),
    w AS (SELECT max(ts) FILTER (NOT behind) - INTERVAL 1 HOUR AS passed, max(ts) - INTERVAL 1 HOUR AS last FROM e),
    k AS (SELECT event_type, timestamp, value, CASE WHEN behind AND timestamp + INTERVAL 1 HOUR <= passed THEN 'late'
        WHEN timestamp + INTERVAL 1 HOUR <= last THEN 'closed' ELSE 'open' END AS kind FROM e, w)
    SELECT kind, event_type, timestamp, round(avg(value), 8) AS value, count(*) AS n FROM k GROUP BY ALL""",
)
def late_rows_kept(spark, sf):
    """A stream of three parts, the last of which holds a tenth of all times: what is in closed hours, late, or still open."""
    folder = shared_folder(spark, "closing")
    rows = events(spark, sf).select("event_id", "event_type", "ts", "value")
    behind = F.col("event_id") % 10 == 0
    middle = F.lit("2024-01-16").cast("timestamp")
    parts = [rows.filter(~behind & (F.col("ts") < middle)), rows.filter(~behind & (F.col("ts") >= middle)), rows.filter(behind)]
    keys, values = ["event_type"], ["value"]

    def start():
        source = landed(spark, rows.schema, f"{folder}/in")
        return [start_closing_hours(source, "ts", keys, values, f"{folder}/out", f"{folder}/checkpoint", "1 hour")]

    drain_in_turn(parts, f"{folder}/in", start)
    fields = [rows.schema[k] for k in keys]
    kinds = {k: saved_rows(spark, f"{folder}/out", fields, values, k) for k in ("closed", "late")}
    kinds["open"] = open_hours(spark, f"{folder}/checkpoint", keys, values)
    found = [means(df, keys, values).withColumn("kind", F.lit(k)) for k, df in kinds.items()]
    out = found[0].unionByName(found[1]).unionByName(found[2])
    return out.withColumns({"timestamp": ntz("timestamp"), "value": r8("value")})


@query(
    "published_upserts",
    """SELECT 1 AS list, user_id, date_trunc('hour', ts) AS timestamp, arg_max(value, ts) AS value
    FROM events WHERE event_type NOT IN ('click', 'view') GROUP BY ALL
    UNION ALL SELECT 2, user_id, date_trunc('hour', ts), arg_max(value, ts) FROM events GROUP BY ALL""",
)
def published_upserts(spark, sf):
    """The latest reading per place and hour, published twice: a reader of the first list and one of the second."""
    rows = events(spark, sf).select("user_id", F.date_trunc("hour", "ts").alias("timestamp"), "ts", "value", "event_type")
    early = F.col("event_type").isin("click", "view")
    keyed = rows.drop("event_type")
    target = VersionedTable(spark, shared_folder(spark, "published"), keyed.schema)
    target.upsert(rows.filter(~early).drop("event_type"), ["user_id", "timestamp"], ["ts"])
    first = target.read()
    target.upsert(rows.filter(early).drop("event_type"), ["user_id", "timestamp"], ["ts"])
    both = first.withColumn("list", F.lit(1)).unionByName(target.read().withColumn("list", F.lit(2)))
    return both.select("list", "user_id", ntz("timestamp").alias("timestamp"), "value")


@query("packed_ingest", _SQL_STORED)
def packed_ingest(spark, sf):
    """A store whose first days are packed between two batches, and a replay of all that was ingested before."""
    folder = shared_folder(spark, "packed")
    log = spread_log(spark, sf)
    half = log.agg(F.max("offset")).first()[0] // 2
    parts = []
    for topic in TOPICS:
        store, schema = f"{folder}/{topic}", document_schema(provider_documents(log, topic))
        ingest_batch(log.filter(F.col("offset") <= half), 0, topic, folder, F.col("timestamp"), "first")
        days = sorted(r[0] for r in read_store(spark, store, schema).select("id_date").distinct().collect())
        pack_days(spark, store, schema, days[:-1])
        drop_packed(spark, store, schema)
        ingest_batch(log, 0, topic, folder, F.col("timestamp"), "second")
        docs = read_store(spark, store, schema)
        parts.append(docs.select(F.lit(topic).alias("topic"), "_id", "offset"))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query(
    "stream_rates",
    """SELECT 'ingest-' || CASE WHEN event_type IN ('click', 'view') THEN 'free-weather'
        WHEN event_type IN ('purchase', 'signup') THEN 'open-weather' ELSE 'open-meteo' END AS query,
        count(*)::BIGINT AS input_rows, count(*) FILTER (event_id % 7 <> 0) AS accepted, count(*) FILTER (event_id % 7 = 0) AS rejected
    FROM events GROUP BY ALL""",
)
def stream_rates(spark, sf):
    """What ingest reports of a log in which every seventh message is cut short, summed over its batches."""
    folder = shared_folder(spark, "rates")
    log = message_log(spark, sf)
    cut = F.expr("binary(substring(string(value), 1, 20))")
    log = log.withColumn("value", F.when(F.col("offset") % 7 == 0, cut).otherwise(F.col("value")))
    listener = RateListener(spark, f"{folder}/rates")
    read = by_topic(spark, log, f"{folder}/log")
    spark.streams.addListener(listener)
    try:

        def start():
            queries = [start_measured_ingest(read(t), t, folder, f"{folder}/checkpoints", F.col("timestamp")) for t in TOPICS]
            started.extend(queries)
            return queries

        started: list = []
        drain_in_turn([log.filter("offset % 2 = 0"), log.filter("offset % 2 = 1")], f"{folder}/log", start, "topic")
        if not all(listener.wait(q) for q in started):
            raise TimeoutError("the batches of a query were not reported")
    finally:
        spark.streams.removeListener(listener)
    rates = read_rates(spark, f"{folder}/rates")
    return rates.groupBy("query").agg(*[F.sum(c).alias(c) for c in ("input_rows", "accepted", "rejected")])
