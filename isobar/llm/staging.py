"""Tables written to the folder all executors share, and joins with tables of a counted size."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isobar.session import shared_folder

# Largest number of rows sent to every task; a row here is a key and a few numbers.
BROADCAST_ROWS = 200_000


def staged(df: DataFrame, name: str = "stage") -> DataFrame:
    """Writes a frame once and reads it back: later steps neither repeat it nor depend on the executors that made it."""
    folder = shared_folder(df.sparkSession, name)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def small_or_not(made: DataFrame, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """A written frame, to be broadcast if it has few rows."""
    return F.broadcast(made) if made.count() <= broadcast_rows else made


def join_counted(
    rows: DataFrame, per_key: DataFrame, keys: Sequence[str], how: str = "left", broadcast_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """Joins with a frame of one row per key, which is written and counted first.

    Few keys are broadcast, so a key with most of the rows costs nothing; many keys are a shuffled join, in which Spark splits
    large partitions. Null is a key like any other.
    """
    names = {key: f"_key_{key}" for key in keys}
    made = staged(per_key.withColumnsRenamed(names), "keys")
    same = reduce(and_, [F.col(key).eqNullSafe(F.col(name)) for key, name in names.items()])
    small = made.count() <= broadcast_rows
    return rows.join(F.broadcast(made) if small else made, same, how).drop(*names.values())
