"""Data-quality profile of a table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isobar.operators.quality import null_row_indices
from isobar.operators.serving import top_newest


def null_report(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per column: rows, nulls and their percentage, from one pass."""
    counts = df.agg(
        F.count(F.lit(1)).alias("_rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in columns]
    )
    lines = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.col("_rows").alias("n_rows"),
            F.col(c).alias("n_null"),
            (F.try_divide(F.col(c), F.col("_rows")) * 100).alias("pct_null"),
        )
        for c in columns
    ]
    return counts.select(F.inline(F.array(*lines)))


def quality_profile(
    df: DataFrame, columns: Sequence[str], ts: str, tiebreak: Sequence[str] = (), peek: int = 5
) -> dict[str, DataFrame]:
    """The null report, the positions of the nulls and the newest rows."""
    return {
        "nulls": null_report(df, columns),
        "positions": null_row_indices(df, columns, ts, tiebreak),
        "newest": top_newest(df, peek, ts, *tiebreak),
    }


def null_spans(
    df: DataFrame, columns: Sequence[str], ts: str, tiebreak: Sequence[str] = (), **slicing
) -> DataFrame:
    """Per column: number of nulls, and the first and last position of one."""
    return (
        null_row_indices(df, columns, ts, tiebreak, **slicing)
        .groupBy("column_name")
        .agg(
            F.count(F.lit(1)).alias("n_null"),
            F.min("row_index").alias("first_index"),
            F.max("row_index").alias("last_index"),
        )
    )
