"""Packing of document stores: the many small folders of closed days become few files, while ingest goes on.

A pack holds the rows of a day with the run and batch they came from, and the list of the pack names those batches. A reader takes
the packs, and of the small folders only those that no pack names. So rows count once, before the small folders are deleted, while
they are, and after it, and a batch that runs again after its day was packed adds nothing.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from isobar.operators.serving import first_write_wins
from isobar.session import shared_root
from isobar.sources import storage
from isobar.streaming.stores import NO_DAY, read_folder
from isobar.streaming.versions import VersionedTable

ROWS_PER_FILE = 1_000_000
BATCHES = T.StructType([T.StructField("run", T.StringType()), T.StructField("batch", T.LongType())])


def packs(spark: SparkSession, folder: str, schema: T.StructType) -> VersionedTable:
    """The packs of a store; `schema` is that of its stored documents, with id_date, run and batch."""
    return VersionedTable(spark, f"{folder}/_packs", schema, "id_date")


def _packed_batches(table: VersionedTable, days: Sequence[date | None] | None) -> DataFrame:
    return table.read(days, name="batches", columns=BATCHES)


def read_store(spark: SparkSession, folder: str, schema: T.StructType, days: Sequence[date | None] | None = None) -> DataFrame:
    """All rows of a store, packed or not, of all days or some."""
    table = packs(spark, folder, schema)
    raw = read_folder(spark, folder, schema) if days is None else read_folder(spark, folder, schema, "id_date", days)
    if not table.numbers():
        return raw
    same = [F.col(f"r.{c}").eqNullSafe(F.col(f"n.{c}")) for c in ("id_date", "run", "batch")]
    rest = raw.alias("r").join(_packed_batches(table, days).alias("n"), same, "left_anti")
    return rest.unionByName(table.read(days).select(*raw.columns))


def pack_days(
    spark: SparkSession, folder: str, schema: T.StructType, days: Sequence[date | None], rows_per_file: int = ROWS_PER_FILE
) -> int:
    """Packs all rows of the given closed days, packed ones too; gives the number of the new list.

    Files are filled up to `rows_per_file` rows. Of rows with one id, stored twice by queries that ran at the same time, the
    first by partition and offset stays. Packing again changes nothing but the files.
    """
    shared_root(spark)
    table = packs(spark, folder, schema)
    last = (table.numbers() or [0])[-1]
    rows = read_store(spark, folder, schema, days).checkpoint()
    once = first_write_wins(rows, "_id", "partition", "offset")
    # Also batches of which no row is left.
    named = rows.select("id_date", *BATCHES.names).unionByName(_packed_batches(table, days)).distinct()
    return table.publish(once, list(days), ["_id"], last, rows_per_file, {"batches": named})


def drop_packed(spark: SparkSession, folder: str, schema: T.StructType, days: Sequence[date | None] | None = None) -> int:
    """Deletes the small folders that a pack names; gives how many went. It may run at any time, and again."""
    gone = 0
    for r in _packed_batches(packs(spark, folder, schema), days).toLocalIterator():
        path = f"{folder}/id_date={NO_DAY if r['id_date'] is None else r['id_date']}/run={r['run']}/batch={r['batch']}"
        if storage.exists(spark, path):
            storage.delete(spark, path)
            gone += 1
    return gone
