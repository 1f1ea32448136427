"""Order-dependent work on long series: slices that are handled alone and then stitched.

A window over a whole series puts that series into one task. When a series is long, the rows go to range
partitions of the whole order instead: series, time, tiebreaks and, last, a hash of the row, so that not
even rows of one and the same time have to share a task. Each range is a window partition of its own, and
only one small row per range goes through the window that runs along the series.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from isobar.operators.joins import join_per_key
from isobar.session import shared_root

TARGET_ROWS = 1_000_000


def with_slices(
    df: DataFrame,
    series: Sequence[str],
    ts: str,
    tiebreak: Sequence[str] = (),
    target_rows: int = TARGET_ROWS,
) -> DataFrame | None:
    """Adds `_slice`, a struct of the series columns and the range its row falls into.

    None when no series has more than `target_rows`: a plain window does then. Without series columns
    all rows are one series, which is always sliced. The sliced rows are kept as a checkpoint, so a range
    holds the same rows whenever it is read.
    """
    spark = df.sparkSession
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    if series:
        sizes = df.groupBy(*series).agg(F.count(F.lit(1)).alias("_n"))
        total, longest = sizes.agg(F.sum("_n"), F.max("_n")).first()
        if (longest or 0) <= target_rows:
            return None
    else:
        total = df.count()
    ranges = max(ranges, math.ceil(total / target_rows))
    shared_root(spark)
    # Maps have no hash; rows that differ in nothing else may lie in any order.
    hashed = [F.col(f"`{f.name}`") for f in df.schema.fields if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    mixed = df.withColumn("_mix", F.xxhash64(*hashed))
    dealt = mixed.repartitionByRange(ranges, *series, ts, *tiebreak, "_mix").drop("_mix")
    part = F.struct(*[F.col(s) for s in series], F.spark_partition_id().alias("_part"))
    return dealt.withColumn("_slice", part).checkpoint()


def _along(series: Sequence[str]):
    """Window over the slices of a series."""
    return Window.partitionBy(*[F.col(f"_slice.{s}") for s in series]).orderBy(F.col("_slice._part"))


def with_next(
    df: DataFrame,
    column: str,
    series: Sequence[str],
    ts: str,
    tiebreak: Sequence[str] = (),
    out: str = "_next",
    **slicing,
) -> DataFrame:
    """Adds the value the following row of the series has; null on the last row."""
    order = [F.col(c) for c in (ts, *tiebreak)]
    sliced = with_slices(df, series, ts, tiebreak, **slicing)
    if sliced is None:
        return df.withColumn(out, F.lead(column).over(Window.partitionBy(*series).orderBy(*order)))
    boxed = F.struct(F.col(column).alias("v"))
    heads = (
        sliced.groupBy("_slice")
        .agg(F.min_by(boxed, F.struct(*order)).alias("_head"))
        .select("_slice", F.lead("_head").over(_along(series)).alias("_after"))
    )
    return (
        sliced.withColumn("_inside", F.lead(boxed).over(Window.partitionBy("_slice").orderBy(*order)))
        .join(heads, "_slice", "left")
        .withColumn(out, F.coalesce("_inside", "_after")["v"])
        .drop("_slice", "_inside", "_after")
    )


def with_row_index(
    df: DataFrame,
    ts: str,
    tiebreak: Sequence[str] = (),
    series: Sequence[str] = (),
    out: str = "row_index",
    **slicing,
) -> DataFrame:
    """Adds the zero-based position in time order, over all rows or per series."""
    order = [F.col(c) for c in (ts, *tiebreak)]
    sliced = with_slices(df, series, ts, tiebreak, **slicing)
    if sliced is None:
        rank = F.row_number().over(Window.partitionBy(*series).orderBy(*order)) - 1
        return df.withColumn(out, rank.cast("long"))
    before = _along(series).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        sliced.groupBy("_slice")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select("_slice", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    )
    inside = Window.partitionBy("_slice").orderBy(*order)
    return (
        sliced.withColumn("_rank", F.row_number().over(inside))
        .join(offsets, "_slice", "left")
        .withColumn(out, F.col("_offset") + F.col("_rank") - 1)
        .drop("_slice", "_rank", "_offset")
    )


def newest(df: DataFrame, n: int, series: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Last `n` rows of each series. Spark keeps the top n per task before it shuffles."""
    if not series:
        return df.orderBy(*[F.desc(c) for c in order]).limit(n)
    window = Window.partitionBy(*series).orderBy(*[F.desc(c) for c in order])
    return df.withColumn("_rank", F.row_number().over(window)).filter(F.col("_rank") <= n).drop("_rank")


def oldest(df: DataFrame, n: int, series: Sequence[str], order: Sequence[str]) -> DataFrame:
    if not series:
        return df.orderBy(*order).limit(n)
    window = Window.partitionBy(*series).orderBy(*[F.col(c) for c in order])
    return df.withColumn("_rank", F.row_number().over(window)).filter(F.col("_rank") <= n).drop("_rank")


def _bound(edge: DataFrame, series: Sequence[str], order: Sequence[str], pick) -> DataFrame:
    return edge.groupBy(*series).agg(pick(F.struct(*order)).alias("_bound"))


def _with_bound(df: DataFrame, bound: DataFrame, series: Sequence[str]) -> DataFrame:
    if not series:
        return df.withColumn("_bound", bound.scalar())
    return join_per_key(df, bound, series)


def split_newest(
    df: DataFrame, n: int, series: Sequence[str], order: Sequence[str], out: str = "is_test"
) -> DataFrame:
    """Marks the last `n` rows of each series; the rest is the training part.

    The mark is a comparison with the n-th newest key, so the rest is never ranked or sorted.
    `order` has to be unique within a series.
    """
    bound = _bound(newest(df, n, series, order), series, order, F.min)
    return (
        _with_bound(df, bound, series)
        .withColumn(out, F.struct(*order) >= F.col("_bound"))
        .drop("_bound")
    )


def skip_oldest(df: DataFrame, n: int, series: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Everything after the first `n` rows of each series."""
    bound = _bound(oldest(df, n, series, order), series, order, F.max)
    return (
        _with_bound(df, bound, series)
        .filter(F.struct(*order) > F.col("_bound"))
        .drop("_bound")
    )


def drop_newest(df: DataFrame, n: int, series: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Everything but the last `n` rows of each series."""
    return split_newest(df, n, series, order, "_cut").filter(~F.col("_cut")).drop("_cut")
