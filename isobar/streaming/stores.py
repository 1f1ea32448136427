"""Parquet folders that streams write: first-write-wins documents and keyed serving tables."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from isobar.operators.serving import first_write_wins, upsert_latest
from isobar.session import shared_root

# Folder name of rows without a day.
NO_DAY = "__HIVE_DEFAULT_PARTITION__"
# Parts of a day by the seconds its ids are from, and rows of one part from which on its ids may have many copies.
PARTS = 64
CROWD = 10_000


@contextmanager
def state_partitions(spark: SparkSession) -> Iterator[None]:
    """Queries that are started inside shuffle into one partition per core, or the session's number if that is less.

    Every partition of a stateful operator is a store of its own, which each batch opens and commits, however few rows it has, and
    streams with state do not merge small partitions. More partitions than cores add only to that. A checkpoint keeps its number.
    """
    name = "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    spark.conf.set(name, str(min(int(before), max(spark.sparkContext.defaultParallelism, 1))))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def read_folder(
    spark: SparkSession,
    folder: str,
    schema: T.StructType,
    day_column: str | None = None,
    days: Sequence[date] = (),
) -> DataFrame:
    """The folder's rows, or no rows when nothing has been written yet.

    With days only their partitions are listed and read, however many others there are.
    """
    path = folder
    if day_column is not None:
        names = [NO_DAY if day is None else str(day) for day in days]
        path = f"{folder}/{day_column}={{{','.join(names)}}}"
    try:
        return spark.read.schema(schema).option("basePath", folder).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        # Made by Spark itself: rows of the driver's Python, even none, start a worker on every core.
        return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields]).limit(0)


def document_schema(documents: DataFrame) -> T.StructType:
    """Stored form of a document frame: its columns plus the partition columns."""
    return T.StructType(
        [
            *documents.schema.fields,
            T.StructField("id_date", T.DateType()),
            T.StructField("run", T.StringType()),
            T.StructField("batch", T.LongType()),
        ]
    )


def read_documents(spark: SparkSession, folder: str, schema: T.StructType) -> DataFrame:
    return read_folder(spark, folder, schema)


def rows_per_day(df: DataFrame, column: str) -> dict[date, int]:
    """Rows of each date of a batch: one entry per calendar day."""
    return dict(df.groupBy(column).count().collect())


def spread_by_day(df: DataFrame, day: str, counts: dict[date, int], salt: Sequence[str]) -> DataFrame:
    """Shuffles rows so that few tasks write each day and no task has much more than its share.

    A day with more than a task's share of the rows is salted over as many tasks as it fills. Rows
    of a micro-batch mostly fall on one day, so the day alone would put them into one task.
    """
    tasks = shuffle_tasks(df.sparkSession)
    return df.repartitionById(tasks, task_of_day(day, counts, salt, tasks))


def shuffle_tasks(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def task_of_day(day: str, counts: dict[date, int], salt: Sequence[str], tasks: int) -> Column:
    """Number of the task that `spread_by_day` gives a row to.

    Days with more than a share of the rows have tasks in a row, one after the other, as hashes of day and salt would give some
    tasks several shares and others none; smaller days go by their hash.
    """
    total, before, full = sum(counts.values()), 0, {}
    # No more entries than tasks, as each is more than one share.
    for d, n in sorted((d, n) for d, n in counts.items() if d and tasks * n > total):
        full[d] = (tasks * before // total, math.ceil(tasks * n / total))
        before += n
    small = F.pmod(F.xxhash64(day), F.lit(tasks))
    if not full:
        return small.cast("int")
    of = F.create_map(*[x for d, (first, n) in full.items() for x in (F.lit(d), F.struct(F.lit(first).alias("first"), F.lit(n).alias("n")))])
    place = F.try_element_at(of, F.col(day))
    salted = F.pmod(place["first"] + F.pmod(F.xxhash64(*salt), place["n"]), F.lit(tasks))
    return F.coalesce(salted, small).cast("int")


def run_of(batch: DataFrame, default: str = "batch") -> str:
    """Id of the streaming query that made a micro-batch; it stays the same as long as its checkpoint does."""
    return batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or default


def rows_and_crowds(dated: DataFrame) -> tuple[dict[date, int], bool]:
    """Rows of each date, and whether copies crowd: seconds of few ids have many times their share of a day.

    One row per date and part of its seconds comes to the driver, at most `PARTS` for a date.
    """
    second = F.pmod(F.xxhash64(F.date_trunc("second", "id_time")), F.lit(PARTS))
    parts = dated.groupBy("id_date", second.alias("part")).count().collect()
    counts: dict[date, int] = {}
    for r in parts:
        counts[r["id_date"]] = counts.get(r["id_date"], 0) + r["count"]
    return counts, any(r["count"] > max(CROWD, 4 * counts[r["id_date"]] // PARTS) for r in parts)


def new_documents(dated: DataFrame, stored: DataFrame, counts: dict[date, int]) -> DataFrame:
    """The first document of each id that is not stored, laid out for writing by date; ids are told from each other within a date.

    Documents are shuffled once. Stored ids go with them to the task that writes the date's share, and come first there.
    """
    spark = dated.sparkSession
    tasks = shuffle_tasks(spark)
    held = stored.filter("_id IS NOT NULL").select("_id", "id_date", F.lit(True).alias("_held"))
    both = dated.withColumn("_held", F.lit(False)).unionByName(held, allowMissingColumns=True)
    laid = both.withColumn("_task", task_of_day("id_date", counts, ["_id"], tasks)).repartitionById(tasks, "_task")
    # The id first: a sort tells most rows apart by the first bytes of its first column.
    window = Window.partitionBy("_id", "id_date", "_task").orderBy(F.desc("_held"), "partition", "offset")
    first = laid.withColumn("_rank", F.row_number().over(window)).filter("_rank = 1 AND NOT _held")
    return first.drop("_rank", "_held", "_task")


def save_new_documents(documents: DataFrame, batch_id: int, folder: str, run: str = "batch", read=None) -> None:
    """Adds the documents whose id is not stored yet; the first of each id wins.

    An id is made from a time (`id_time`), so copies share its date and only the stored ids of the
    batch's dates are read. Every batch of a run owns a partition of each date and replaces it when it
    is run again, so a retry after a failure leaves no copies. Batch numbers start anew with a new
    checkpoint, and a backfill has its own, so `run` keeps theirs apart: one never replaces the other's.
    `read` gives what is stored, from session, folder, schema and days; by default the folder's rows.
    """
    spark = documents.sparkSession
    schema = document_schema(documents)
    dated = documents.withColumn("id_date", F.to_date("id_time"))
    counts, crowded = rows_and_crowds(dated)
    if not counts:
        return
    if crowded:
        # Copies are cut to one per task before the shuffle, so that an id with many is no task's load.
        dated = first_write_wins(dated, "_id", "partition", "offset")
    held = read(spark, folder, schema, list(counts)) if read else read_folder(spark, folder, schema, "id_date", list(counts))
    stored = held.filter((F.col("run") != run) | (F.col("batch") != batch_id))
    owned = new_documents(dated, stored, counts).withColumns({"run": F.lit(run), "batch": F.lit(batch_id)})
    replace_partitions(owned, folder, "id_date", "run", "batch")


def replace_partitions(df: DataFrame, folder: str, *columns: str) -> None:
    """Writes the partitions the rows fall into; others stay."""
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*columns).parquet(folder)


def upsert_folder(
    incoming: DataFrame,
    folder: str,
    keys: Sequence[str],
    version: Sequence[str],
    ts: str = "timestamp",
) -> list[date]:
    """Merges rows into a table partitioned by day, one row per key, the highest version kept.

    Only the days of the incoming rows are read and rewritten; they are returned. The merged rows
    are checkpointed before the old partitions are replaced, so nothing reads the files it
    overwrites; running the same batch again gives the same table. `ts` has to be one of the keys.
    """
    spark = incoming.sparkSession
    shared_root(spark)
    dated = incoming.withColumn("event_date", F.to_date(ts)).persist()
    try:
        days = list(rows_per_day(dated, "event_date"))
        if not days:
            return []
        stored = read_folder(spark, folder, dated.schema, "event_date", days)
        merged = upsert_latest(stored, dated, keys, version).checkpoint()
    finally:
        dated.unpersist()
    spread = spread_by_day(merged, "event_date", rows_per_day(merged, "event_date"), keys)
    replace_partitions(spread, folder, "event_date")
    return days
