"""Profiles that grow by day: mergeable facts and sketches per day and column, and merged profiles of any span.

A day's facts are made from that day's rows alone and kept. A profile of a span merges kept rows, one per day and column, and reads
no data again. Counts, bounds and moments are exact. Quantiles come from KLL sketches, distinct counts from HyperLogLog ones.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from isobar.streaming.stores import read_folder, replace_partitions

# Size of a quantile sketch: a rank is off by less than 1 % of the rows, with 99 % confidence, up to some merging.
KLL_SIZE = 400
RANK_ERROR = 0.01
# Bits of a distinct sketch: 2 ** 14 registers, a relative deviation of 0.8 %.
HLL_BITS = 14
DISTINCT_ERROR = 0.025

FACTS = T.StructType([T.StructField("column_name", T.StringType())])
for _name in ("n_rows", "n_values"):
    FACTS.add(_name, T.LongType())
for _name in ("mean", "m2", "min", "max"):
    FACTS.add(_name, T.DoubleType())
for _name in ("quantiles", "distinct"):
    FACTS.add(_name, T.BinaryType())


def _facts(name: str, kind: T.DataType) -> Column:
    """One day's facts of a column; numbers have moments, bounds and quantiles, other kinds have counts."""
    column = F.col(f"`{name}`")
    numeric = isinstance(kind, T.NumericType)
    x = column.cast("double") if numeric else F.lit(None).cast("double")
    x = F.when(~F.isnan(x), x)
    as_text = column.cast("string") if not isinstance(kind, T.BinaryType) else F.hex(column)
    n = F.count(x)
    return F.struct(
        F.lit(name).alias("column_name"),
        F.count(F.lit(1)).alias("n_rows"),
        F.count(column).alias("n_values"),
        F.avg(x).alias("mean"),
        F.coalesce(F.var_pop(x) * n, F.lit(0.0)).alias("m2"),
        F.min(x).alias("min"),
        F.max(x).alias("max"),
        (F.when(n > 0, F.kll_sketch_agg_double(x, F.lit(KLL_SIZE))) if numeric else F.lit(None).cast("binary")).alias("quantiles"),
        F.hll_sketch_agg(as_text, F.lit(HLL_BITS)).alias("distinct"),
    )


def daily_facts(df: DataFrame, day: Column, columns: Sequence[str] | None = None) -> DataFrame:
    """(day, facts..): one row per day and column, from one pass over the rows. Rows without a day form a day of their own."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    names = list(columns or (n for n, k in kinds.items() if isinstance(k, T.AtomicType)))
    grouped = df.groupBy(day.alias("day")).agg(F.array(*[_facts(n, kinds[n]) for n in names]).alias("facts"))
    return grouped.select("day", F.inline("facts"))


def keep_facts(df: DataFrame, day: Column, folder: str, days: Sequence[date], columns: Sequence[str] | None = None) -> None:
    """Makes the facts of the given days anew and replaces them in the folder.

    The rows are filtered by `day`: where that is a partition column, only the days' files are read.
    """
    some = df.filter(day.isin([d for d in days if d is not None]) | (day.isNull() if None in days else F.lit(False)))
    # A day has a row per column, and their number is small.
    replace_partitions(daily_facts(some, day, columns).repartition("day"), folder, "day")


def kept_facts(spark: SparkSession, folder: str, days: Sequence[date] | None = None) -> DataFrame:
    """The kept facts, of the given days only if they are given."""
    schema = T.StructType([*FACTS.fields, T.StructField("day", T.DateType())])
    return read_folder(spark, folder, schema) if days is None else read_folder(spark, folder, schema, "day", days)


def merged_profile(facts: DataFrame, quantiles: Sequence[float] = (0.25, 0.5, 0.75), by: Sequence[str] = ()) -> DataFrame:
    """One row per column (and `by`): counts, share of nulls, mean, sample deviation, bounds, and estimates.

    `q` holds the estimated quantiles in the order given, each within `RANK_ERROR` of its rank; `n_distinct` is estimated
    within `DISTINCT_ERROR`.
    """
    n = F.when(F.col("mean").isNotNull(), F.col("n_values")).otherwise(0)
    centre = F.max("mean")
    merged = facts.groupBy(*by, "column_name").agg(
        F.sum("n_rows").alias("n_rows"),
        F.sum("n_values").alias("n_values"),
        F.sum(n).alias("n"),
        centre.alias("c"),
        F.collect_list(F.struct(n.alias("n"), "mean", "m2")).alias("days"),
        F.min("min").alias("min"),
        F.max("max").alias("max"),
        F.kll_merge_agg_double("quantiles").alias("sketch"),
        F.hll_union_agg("distinct").alias("distinct"),
    )
    # Deviations are taken from one of the means, so large values lose no digits. A span has few days.
    apart = F.aggregate("days", F.lit(0.0), lambda a, d: a + F.coalesce(d["n"] * (d["mean"] - F.col("c")), F.lit(0.0)))
    spread = F.aggregate(
        "days", F.lit(0.0), lambda a, d: a + F.coalesce(d["m2"] + d["n"] * (d["mean"] - F.col("c")) * (d["mean"] - F.col("c")), F.lit(0.0))
    )
    moved = F.try_divide(F.col("apart"), F.col("n"))
    estimates = F.array(*[F.kll_sketch_get_quantile_double("sketch", F.lit(float(q))) for q in quantiles])
    return (
        merged.withColumns({"apart": apart, "spread": spread})
        .withColumn("std", F.sqrt(F.greatest(F.try_divide(F.col("spread") - F.col("n") * moved * moved, F.col("n") - 1), F.lit(0.0))))
        .select(
            *by,
            "column_name",
            "n_rows",
            "n_values",
            (100.0 * (F.col("n_rows") - F.col("n_values")) / F.col("n_rows")).alias("pct_null"),
            (F.col("c") + moved).alias("mean"),
            F.when(F.col("n") > 1, F.col("std")).alias("std"),
            "min",
            "max",
            F.when(F.col("n") > 0, estimates).alias("q"),
            F.hll_sketch_estimate("distinct").alias("n_distinct"),
        )
    )
