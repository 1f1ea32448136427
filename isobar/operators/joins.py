"""Joins of many rows with one row per key."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isobar.session import shared_root

# Largest number of rows sent to every task; a row here is a key and a few numbers.
BROADCAST_ROWS = 200_000


def join_per_key(
    rows: DataFrame,
    per_key: DataFrame,
    keys: Sequence[str],
    how: str = "left",
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Joins rows with an aggregate of them, without moving the rows when that can be helped.

    The aggregate is made once and counted. If it is small it is broadcast, so a key with most of
    the rows costs nothing. If not, it is a shuffled join, in which Spark splits large partitions.
    Null is a key like any other.
    """
    shared_root(rows.sparkSession)
    names = {key: f"_key_{key}" for key in keys}
    made = per_key.withColumnsRenamed(names).checkpoint()
    small = made.count() <= broadcast_rows
    same = reduce(and_, [F.col(key).eqNullSafe(F.col(name)) for key, name in names.items()])
    return rows.join(F.broadcast(made) if small else made, same, how).drop(*names.values())
