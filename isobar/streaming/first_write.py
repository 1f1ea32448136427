"""First write wins with the known ids in keyed state: no batch reads the store.

`ingest.start_ingest` asks the store which ids of a batch's days it holds. Here the ids are state instead, kept in buckets: a part
of all ids that are made from times of one hour. State is filled once, in the first batch of a new checkpoint, from the ids that are
stored then; afterwards a batch costs its own records and the ids of the hours they are from, however large the store is. A call
into the state costs far more than an id in it, so there is no state per id. A time to live bounds the state: an id that was seen
longer ago is taken for new.

What goes through the state is the raw record, so documents are not turned into Python objects; the winners are shaped after it.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

from isobar.operators.reshape import RESHAPERS, message_id, message_id_time
from isobar.sources.messages import good_records, is_good, parse_envelopes, parsed_once, rejected_records
from isobar.streaming.closing import keyed_state
from isobar.streaming.stores import replace_partitions, rows_per_day, run_of, spread_by_day

_ROW = "id STRING, value BINARY, topic STRING, partition INT, offset LONG, micros LONG"
# Records without an id pass under a name of their own and leave no state.
_PASSING = "rejected:"
# Buckets of one hour: so many tasks can share the records of a busy one.
SHARES = 8


def _place(record: Row) -> tuple:
    """Order of records by partition and offset, null last."""
    return tuple((x is None, x or 0) for x in (record["partition"], record["offset"]))


class FirstWrite(StatefulProcessor):
    """Lets the first record of an id through, the lowest partition and offset of those that come together.

    A key is a bucket of ids; its state is the list of those seen, which one call reads and one call extends.
    """

    def __init__(self, ttl_ms: int | None = None):
        self.ttl_ms = ttl_ms

    def init(self, handle) -> None:
        self.handle = handle
        self.seen = handle.getListState("seen", "id STRING, micros LONG")

    def _ends(self, ids: Iterable[tuple]) -> int | None:
        """When the first of the ids is forgotten."""
        return min((int(micros) // 1000 + self.ttl_ms for _, micros in ids), default=None)

    def _remember(self, known: list[tuple], new: list[tuple]) -> None:
        self.seen.appendList(new)
        if self.ttl_ms is not None:
            # The timer of a bucket is that of its first id; it sets the next one.
            before, end = self._ends(known), self._ends(new)
            if before is None or end < before:
                self.handle.registerTimer(end)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        first: dict[str, Row] = {}
        for row in rows:
            best = first.get(row["id"])
            if best is None or _place(row) < _place(best):
                first[row["id"]] = row
        if not key[0].startswith(_PASSING):
            known = list(self.seen.get())
            for name, _ in known:
                first.pop(name, None)
            if first:
                self._remember(known, [(name, row["micros"]) for name, row in first.items()])
        for row in first.values():
            yield Row(**{c: row[c] for c in ("id", "value", "topic", "partition", "offset", "micros")})

    def handleInitialState(self, key, initialState, timerValues) -> None:
        self._remember([], [(x["id"], x["micros"]) for x in initialState["ids"]])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        now = timerValues.getCurrentWatermarkInMs()
        left = [(name, micros) for name, micros in self.seen.get() if self._ends([(name, micros)]) > now]
        if left:
            self.seen.put(left)
            self.handle.registerTimer(self._ends(left))
        else:
            self.seen.clear()
        return iter(())

    def close(self) -> None:
        pass


def _bucket(time: Column, name: Column) -> Column:
    """The hour that an id is made from, in `SHARES` parts."""
    hour = F.coalesce(F.floor(F.unix_micros(time) / 3_600_000_000).cast("long"), F.lit(-1))
    return F.concat_ws(":", hour.cast("string"), F.pmod(F.xxhash64(name), F.lit(SHARES)).cast("string"))


def first_records(records: DataFrame, topic: str, known: DataFrame | None = None, ttl: str | None = None) -> DataFrame:
    """The stream of a topic's records whose id comes for the first time, and of its records without one.

    `known` has the columns `_id` and `id_time` of documents: ids that count as seen when the checkpoint is new; with a `ttl`, an
    interval of days, hours or less, their time to live runs from `id_time`.
    """
    spark = records.sparkSession
    if ttl is not None:
        records = records.withWatermark("timestamp", "0 seconds")
    parsed = parse_envelopes(records, topic)
    passing = F.concat(F.lit(_PASSING), F.col("partition"), F.lit(":"), F.col("offset"))
    good, name = is_good(parsed), message_id(topic)
    named = parsed.select(
        F.when(good, _bucket(message_id_time(topic), name))
        .otherwise(F.concat(F.lit(_PASSING), F.pmod(F.xxhash64("partition", "offset"), F.lit(256))))
        .alias("bucket"),
        F.when(good, name).otherwise(passing).alias("id"),
        "value",
        "topic",
        "partition",
        "offset",
        F.unix_micros(F.col("timestamp")).alias("micros"),
    )
    start, span = None, None
    if known is not None:
        time = F.lit(0).cast("long") if ttl is None else F.coalesce(F.max(F.unix_micros("id_time")), F.lit(0))
        ids = known.filter("_id IS NOT NULL").groupBy(_bucket(F.col("id_time"), F.col("_id")).alias("bucket"), F.col("_id").alias("id"))
        start = ids.agg(time.alias("micros")).groupBy("bucket").agg(F.collect_list(F.struct("id", "micros")).alias("ids")).groupBy("bucket")
    if ttl is not None:
        span = int(spark.range(1).select(F.expr(f"INTERVAL {ttl}").alias("d")).first()["d"].total_seconds() * 1000)
    # As rows: data frames of a few records take longer to make than to handle.
    found = named.groupBy("bucket").transformWithState(FirstWrite(span), _ROW, "Append", "None" if ttl is None else "EventTime", start)
    return found.select(F.lit(None).cast("binary").alias("key"), "value", "topic", "partition", "offset", F.timestamp_micros("micros").alias("timestamp"))


def save_first(batch: DataFrame, batch_id: int, topic: str, store: str, created_at: Column | None = None, run: str | None = None) -> None:
    """Writes a batch of first records: documents to the topic's store, the others to its quarantine.

    A batch owns a partition of each date, so running it again replaces its own rows only.
    """
    run = run or run_of(batch)
    parsed = parsed_once(parse_envelopes(batch, topic)).persist()
    try:
        dated = RESHAPERS[topic](good_records(parsed), created_at).withColumn("id_date", F.to_date("id_time"))
        counts = rows_per_day(dated, "id_date")
        if counts:
            owned = spread_by_day(dated, "id_date", counts, ["_id"]).withColumns({"run": F.lit(run), "batch": F.lit(batch_id)})
            replace_partitions(owned, f"{store}/{topic}", "id_date", "run", "batch")
        rejected_records(parsed).write.mode("overwrite").parquet(f"{store}/_quarantine/{topic}/run={run}/batch={batch_id}")
    finally:
        parsed.unpersist()


def start_first_write(
    records: DataFrame,
    topic: str,
    store: str,
    checkpoints: str,
    known: DataFrame | None = None,
    ttl: str | None = None,
    created_at: Column | None = None,
    **trigger,
) -> StreamingQuery:
    """Starts the query of one topic; the store has the layout of `ingest.start_ingest`."""
    with keyed_state(records.sparkSession):
        return (
            first_records(records.filter(F.col("topic") == topic), topic, known, ttl)
            .writeStream.queryName(f"first-write-{topic}")
            .option("checkpointLocation", f"{checkpoints}/{topic}")
            .foreachBatch(lambda df, batch_id: save_first(df, batch_id, topic, store, created_at))
            .trigger(**(trigger or {"availableNow": True}))
            .start()
        )
