"""Null profiles, summaries, duplicates, gap filling and z-scores."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from isobar.operators.joins import join_per_key
from isobar.operators.ordered import with_next, with_row_index
from isobar.operators.project import numeric_columns
from isobar.session import shared_root

QUANTILE_CELLS = 1_000


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row: number of nulls of each column, in one pass."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns or df.columns])


def null_shares(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row: percentage of nulls of each column."""
    return df.agg(
        *[(F.avg(F.col(c).isNull().cast("double")) * 100).alias(c) for c in columns or df.columns]
    )


def rows_with_null(df: DataFrame, columns: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """`keep` columns once per column that is null in the row, with the column's name."""
    gaps = F.array_compact(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in columns]))
    return df.select(*keep, F.explode(gaps).alias("column_name"))


def null_row_indices(
    df: DataFrame, columns: Sequence[str], ts: str, tiebreak: Sequence[str] = (), **slicing
) -> DataFrame:
    """Position in time order of every null, per column."""
    indexed = with_row_index(df, ts, tiebreak, **slicing)
    return rows_with_null(indexed, columns, ["row_index"]).select("column_name", "row_index")


def complete_rows(df: DataFrame) -> DataFrame:
    return df.na.drop()


def distinct_rows(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()


def schema_facts(df: DataFrame) -> DataFrame:
    """One row per column: type, rows and values that are not null."""
    kinds = dict(df.dtypes)
    counts = df.agg(
        F.count(F.lit(1)).alias("_rows"), *[F.count(F.col(f"`{c}`")).alias(c) for c in df.columns]
    )
    return counts.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(c).alias("column_name"),
                        F.lit(kinds[c]).alias("column_type"),
                        F.col("_rows").alias("n_rows"),
                        F.col(f"`{c}`").alias("n_values"),
                    )
                    for c in df.columns
                ]
            )
        )
    )


def _moments(df: DataFrame, columns: Sequence[str], sides: Sequence[float], accuracy: int) -> dict:
    """Per column: moments and approximate values at the given ranks. One aggregate row in all."""
    row = df.agg(
        *[
            F.struct(
                F.count(x).alias("n"),
                F.avg(x).alias("mean"),
                F.stddev_samp(x).alias("std"),
                F.min(x).alias("min"),
                F.max(x).alias("max"),
                F.percentile_approx(x, list(sides), accuracy).alias("sides"),
            ).alias(c)
            for c, x in ((c, F.col(c).cast("double")) for c in columns)
        ]
    ).first()
    return {c: row[c] for c in columns if row[c]["n"]}


def _sides(quantiles: Sequence[float], accuracy: int) -> list[float]:
    margin = 5.0 / accuracy
    return [max(q - margin, 0.0) for q in quantiles] + [min(q + margin, 1.0) for q in quantiles]


def exact_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    quantiles: Sequence[float] = (0.25, 0.5, 0.75),
    accuracy: int = 10_000,
) -> DataFrame:
    """`(column_name, q, value)`, linearly interpolated and exact at any size; null for a column without values.

    An approximate sketch gives a narrow bracket around each quantile. One pass counts the rows
    below it and finds the values next to it; another counts each value inside it. Only the values
    inside go on. Cut into cells (a fixed number), their running counts tell which cells hold the
    wanted ranks, and the values of those cells are put in order.
    """
    moments = _moments(df, columns, _sides(quantiles, accuracy), accuracy)
    empty = [(c, float(q), None) for c in columns if c not in moments for q in quantiles]
    found = _quantiles(df, moments, quantiles)
    return found.unionByName(df.sparkSession.createDataFrame(empty, found.schema)) if empty else found


def _quantiles(df: DataFrame, moments: dict, quantiles: Sequence[float]) -> DataFrame:
    spark = df.sparkSession
    shared_root(spark)
    # As many brackets as columns times quantiles.
    brackets = [
        (c, float(q), (m["n"] - 1) * q, m["sides"][i], m["sides"][len(quantiles) + i])
        for c, m in moments.items()
        for i, q in enumerate(quantiles)
    ]
    value = {c: F.col(c).cast("double") for c in moments}
    beside = df.agg(
        F.lit(0).alias("none"),
        *[
            F.struct(
                F.count_if(value[c] < lo).alias("below"),
                F.max(F.when(value[c] < lo, value[c])).alias("last_below"),
                F.min(F.when(value[c] > hi, value[c])).alias("first_above"),
            ).alias(f"b{i}")
            for i, (c, _, _, lo, hi) in enumerate(brackets)
        ],
    ).first()
    bracket_rows = spark.createDataFrame(
        [(*b, *beside[f"b{i}"]) for i, b in enumerate(brackets)],
        "column_name STRING, q DOUBLE, position DOUBLE, lo DOUBLE, hi DOUBLE, below LONG, "
        "last_below DOUBLE, first_above DOUBLE",
    )
    tests = [value[c].between(lo, hi) for c, _, _, lo, hi in brackets]
    hits = [
        F.when(test, F.struct(F.lit(c).alias("column_name"), F.lit(q).alias("q"), value[c].alias("x")))
        for test, (c, q, *_) in zip(tests, brackets)
    ]
    hit_rows = df.filter(reduce(or_, tests, F.lit(False)))
    hits = F.array_compact(F.array(*hits)) if hits else F.expr(
        "CAST(array() AS ARRAY<STRUCT<column_name: STRING, q: DOUBLE, x: DOUBLE>>)"
    )
    inside = F.try_divide(F.col("x") - F.col("lo"), F.col("hi") - F.col("lo"))
    counted = (
        hit_rows.select(F.inline(hits))
        .groupBy("column_name", "q", "x")
        .agg(F.count(F.lit(1)).alias("n"))
        .join(F.broadcast(bracket_rows), ["column_name", "q"])
        .withColumn("cell", F.coalesce(F.floor(inside * QUANTILE_CELLS), F.lit(0)).cast("int"))
        .checkpoint()
    )
    along_cells = Window.partitionBy("column_name", "q").orderBy("cell")
    low, high = F.floor("position"), F.ceil("position")
    cells = (
        counted.groupBy("column_name", "q", "cell", "position", "below")
        .agg(F.sum("n").alias("n"))
        .withColumn("upto", F.col("below") + F.sum("n").over(along_cells))
        .withColumn("before", F.col("upto") - F.col("n"))
        .filter((F.col("before") <= high) & (low < F.col("upto")))
        .select("column_name", "q", "cell", "before")
    )
    along_values = Window.partitionBy("column_name", "q", "cell").orderBy("x")
    # Two cells per bracket at most.
    ranked = (
        counted.join(F.broadcast(cells), ["column_name", "q", "cell"])
        .withColumn("upto", F.col("before") + F.sum("n").over(along_values))
        .withColumn("from", F.col("upto") - F.col("n"))
    )
    holds = lambda rank: (F.col("from") <= rank) & (rank < F.col("upto"))
    found = ranked.groupBy("column_name", "q").agg(
        F.min(F.when(holds(low), F.col("x"))).alias("_low"),
        F.min(F.when(holds(high), F.col("x"))).alias("_high"),
    )
    # Rounding can put a rank next to its bracket: the last value below or the first above.
    beside_or = lambda rank, name: F.when(rank < F.col("below"), F.col("last_below")).otherwise(
        F.coalesce(name, "first_above")
    )
    placed = bracket_rows.join(found, ["column_name", "q"], "left").withColumns(
        {"_low": beside_or(low, "_low"), "_high": beside_or(high, "_high")}
    )
    return placed.select(
        "column_name",
        "q",
        (F.col("_low") + (F.col("_high") - F.col("_low")) * (F.col("position") - low)).alias("value"),
    )


def describe(df: DataFrame, columns: Sequence[str] | None = None, accuracy: int = 10_000) -> DataFrame:
    """Count, mean, sample deviation, minimum, exact quartiles and maximum of each column."""
    quartiles = {0.25: "q1", 0.5: "median", 0.75: "q3"}
    names = list(columns or numeric_columns(df))
    moments = _moments(df, names, _sides(list(quartiles), accuracy), accuracy)
    wide = (
        _quantiles(df, moments, list(quartiles))
        .groupBy("column_name")
        .agg(*[F.max(F.when(F.col("q") == q, F.col("value"))).alias(name) for q, name in quartiles.items()])
    )
    names_of = ("n", "mean", "std", "min", "max")
    # A column without values has no moments but its count of 0.
    rows = [(c, *[moments[c][k] for k in names_of]) if c in moments else (c, 0, None, None, None, None) for c in names]
    facts = df.sparkSession.createDataFrame(
        rows, "column_name STRING, n LONG, mean DOUBLE, std DOUBLE, min DOUBLE, max DOUBLE"
    )
    return facts.join(wide, "column_name", "left").select(
        "column_name", "n", "mean", "std", "min", "q1", "median", "q3", "max"
    )


def backfill_one(
    df: DataFrame,
    column: str,
    series: Sequence[str],
    ts: str,
    tiebreak: Sequence[str] = (),
    **slicing,
) -> DataFrame:
    """Fills a null from the next row only, so the first of two nulls in a row stays."""
    return (
        with_next(df, column, series, ts, tiebreak, "_fill", **slicing)
        .withColumn(column, F.coalesce(F.col(column), F.col("_fill")))
        .drop("_fill")
    )


def _center_and_spread(value: Column | str) -> tuple[Column, Column]:
    return F.avg(value), F.stddev_pop(value)


def zscore(df: DataFrame, column: str, series: Sequence[str] = (), train: Column | None = None) -> DataFrame:
    """Adds `z`, and the `mean` and `std` it was made with, per series or over all rows.

    Only the rows of `train`, when given, make the statistics. A constant series has null scores.
    """
    value = F.col(column) if train is None else F.when(train, F.col(column))
    mean, std = _center_and_spread(value)
    if series:
        stats = df.groupBy(*series).agg(mean.alias("mean"), std.alias("std"))
        out = join_per_key(df, stats, series)
    else:
        stat = df.agg(F.struct(mean.alias("mean"), std.alias("std"))).scalar()
        out = df.withColumn("_s", stat).withColumns({"mean": F.col("_s.mean"), "std": F.col("_s.std")}).drop("_s")
    return out.withColumn("z", F.try_divide(F.col(column) - F.col("mean"), F.col("std")))


def zscore_inverse(df: DataFrame, z: str = "z", out: str = "value") -> DataFrame:
    return df.withColumn(out, F.col(z) * F.col("std") + F.col("mean"))
