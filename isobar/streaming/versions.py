"""Tables that change in one step: versions of days, and a list of the versions that count.

A change writes the days it touches as new folders, which nobody reads yet, and then one file that lists the version of every
day. That file is the change: a reader takes the newest complete list and the folders in it, so it sees the table before the
change or after it, and what it has started to read stays as it is. A change that fails before its list leaves the old table.
Of two changes on the same state one fails, because both want to write the same list.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable, Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from isobar.operators.serving import upsert_latest
from isobar.session import shared_root
from isobar.sources import storage
from isobar.streaming.stores import NO_DAY, rows_per_day, spread_by_day

# Lists that stay besides the newest one, and with them the versions a slow reader may still want.
KEPT_LISTS = 10


def filled_files(rows: DataFrame, day: str, counts: dict[date | None, int], salt: Sequence[str], rows_per_file: int) -> DataFrame:
    """Deals rows so that each day is written as about as many files as its rows need, and no more."""
    files = {d: math.ceil(n / rows_per_file) for d, n in counts.items()}
    many = [F.lit(x) for d, n in files.items() if d is not None and n > 1 for x in (d, n)]
    share = F.coalesce(F.try_element_at(F.create_map(*many), F.col(day)), F.lit(1)) if many else F.lit(1)
    return rows.repartition(max(sum(files.values()), 1), F.col(day), F.pmod(F.xxhash64(*salt), share))


class VersionedTable:
    """A table in a folder, by days; `columns` are those of its rows, the day among them or not."""

    def __init__(self, spark: SparkSession, folder: str, columns: T.StructType, day: str = "event_date"):
        self.spark = spark
        self.folder = folder.rstrip("/")
        self.day = day
        kept = [f for f in columns.fields if f.name not in (day, "version")]
        self.schema = T.StructType([*kept, T.StructField(day, T.DateType()), T.StructField("version", T.StringType())])

    def _list(self, number: int) -> str:
        return f"{self.folder}/lists/{number:012d}"

    def numbers(self) -> list[int]:
        """Numbers of the complete lists, the newest last."""
        lists = storage.names(self.spark, f"{self.folder}/lists")
        return [int(n) for n in lists if storage.exists(self.spark, f"{self.folder}/lists/{n}/_SUCCESS")]

    def versions(self, number: int | None = None) -> dict[date | None, str]:
        """Version of each day, in the newest list or the one given. One entry per day."""
        found = self.numbers() if number is None else [number]
        if not found:
            return {}
        rows = self.spark.read.schema("day DATE, version STRING").parquet(self._list(found[-1])).collect()
        return {r["day"]: r["version"] for r in rows}

    def _path(self, day: date | None, version: str, name: str = "data") -> str:
        return f"{self.folder}/{name}/{self.day}={NO_DAY if day is None else day}/version={version}"

    def read(
        self, days: Sequence[date | None] | None = None, number: int | None = None, name: str = "data", columns: T.StructType | None = None
    ) -> DataFrame:
        """The rows of the newest list, of all days or some. Later changes do not touch what was read.

        `name` and `columns` are those of a table beside the rows. A day whose last row went has a version without files.
        """
        schema = self.schema if columns is None else T.StructType([*columns.fields, *self.schema.fields[-2:]])
        paths = [self._path(d, v, name) for d, v in self.versions(number).items() if days is None or d in days]
        there = [p for p in paths if storage.exists(self.spark, p)]
        if not there:
            rows = self.spark.createDataFrame([], schema)
        else:
            rows = self.spark.read.schema(schema).option("basePath", f"{self.folder}/{name}").parquet(*there)
        return rows.drop("version")

    def show_as(self, view: str) -> None:
        """Makes or replaces the session's view of that name with the table as it is now."""
        self.read().createOrReplaceTempView(view)

    def publish(
        self,
        rows: DataFrame,
        days: Sequence[date | None],
        salt: Sequence[str],
        before: int | None = None,
        rows_per_file: int | None = None,
        beside: dict[str, DataFrame] | None = None,
    ) -> int:
        """Replaces the given days by `rows`, which hold all their rows, in one step; other days stay.

        `before` is the list that the rows were made from, the newest one if it is not given; the change fails when another
        list has come since. `rows_per_file` bounds the files of a day by its rows, else all tasks write. `beside` has smaller
        tables with the same days, which change in the same step. Gives the number of the new list.
        """
        numbers = self.numbers()
        last = numbers[-1] if numbers else 0
        if before is not None and before != last:
            raise RuntimeError(f"{self.folder} has changed from list {before} to {last}; make the rows again")
        versions = self.versions(last) if last else {}
        version = uuid.uuid4().hex
        counts = rows_per_day(rows, self.day)
        if unknown := set(counts) - set(days):
            raise ValueError(f"rows of days that are not to be replaced: {sorted(map(str, unknown))}")
        if rows_per_file is None:
            dealt = spread_by_day(rows, self.day, counts, salt)
        else:
            dealt = filled_files(rows, self.day, counts, salt, rows_per_file)
        parts = {"data": dealt, **{name: df.repartition(self.day) for name, df in (beside or {}).items()}}
        for name, part in parts.items():
            part.withColumn("version", F.lit(version)).write.mode("append").partitionBy(self.day, "version").parquet(f"{self.folder}/{name}")
        versions = {d: v for d, v in versions.items() if d not in days} | dict.fromkeys(days, version)
        # The first to claim the number goes on; one file is the list.
        if not storage.touch(self.spark, f"{self.folder}/claims/{last + 1:012d}"):
            raise RuntimeError(f"another change has claimed list {last + 1} of {self.folder}")
        listed = self.spark.createDataFrame(sorted(versions.items(), key=str), "day DATE, version STRING")
        listed.coalesce(1).write.parquet(self._list(last + 1))
        return last + 1

    def release_claim(self) -> None:
        """After a publisher died between its claim and its list: lets the next one claim the number again."""
        last = (self.numbers() or [0])[-1]
        storage.delete(self.spark, self._list(last + 1))
        storage.delete(self.spark, f"{self.folder}/claims/{last + 1:012d}")

    def clean(self, keep: int = KEPT_LISTS) -> int:
        """Deletes lists before the newest `keep` ones and the versions that only they name; gives how many versions went.

        Versions that no list names yet may be on their way, so only those of deleted lists go.
        """
        numbers = self.numbers()
        old, kept = numbers[:-keep], numbers[-keep:]
        wanted = {item for n in kept for item in self.versions(n).items()}
        gone = {item for n in old for item in self.versions(n).items()} - wanted
        parts = [n for n in storage.names(self.spark, self.folder) if n not in ("lists", "claims")]
        for day, version in gone:
            for name in parts:
                storage.delete(self.spark, self._path(day, version, name))
        for n in old:
            storage.delete(self.spark, self._list(n))
        return len(gone)

    def upsert(self, incoming: DataFrame, keys: Sequence[str], version: Sequence[str], ts: str = "timestamp") -> list[date | None]:
        """Merges rows, one per key, the highest version kept, and publishes the days they fall on; gives these days."""
        shared_root(self.spark)
        dated = incoming.withColumn(self.day, F.to_date(ts)).persist()
        try:
            days = list(rows_per_day(dated, self.day))
            if not days:
                return []
            numbers = self.numbers()
            stored = self.read(days, numbers[-1] if numbers else None)
            merged = upsert_latest(stored, dated.select(*stored.columns), keys, version).checkpoint()
        finally:
            dated.unpersist()
        self.publish(merged, days, keys, numbers[-1] if numbers else 0)
        return days


def start_published_upserts(
    means: DataFrame,
    table: Callable[[SparkSession], VersionedTable],
    checkpoint: str,
    keys: Sequence[str],
    version: Sequence[str],
    after: Callable[[VersionedTable], None] | None = None,
    **trigger,
) -> StreamingQuery:
    """As `windows.start_upserts`, but each batch is published in one step; `after` is called with the table then."""

    def save(batch: DataFrame, _: int) -> None:
        target = table(batch.sparkSession)
        if target.upsert(batch, keys, version) and after:
            after(target)

    return (
        means.writeStream.outputMode("update")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(save)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
