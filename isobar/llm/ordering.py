"""Global order of many rows without a single sorted task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from isobar.llm.staging import staged



def ranked(df: DataFrame, order: Sequence[Column], name: str = "rank") -> DataFrame:
    """Adds the place of each row in the given order, from 0.

    Rows go to range partitions, are counted there, and get the rows of the partitions before theirs on top. Add columns that
    break ties to the order, or equal rows share a partition.
    """
    spark = df.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = df.repartitionByRange(n, *order).withColumn("_part", F.spark_partition_id()).transform(staged)
    # One row per partition.
    parts = dealt.groupBy("_part").agg(F.count("*").alias("_n"))
    base = parts.withColumn("_base", F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).drop("_n")
    place = F.row_number().over(Window.partitionBy("_part").orderBy(*order)) - 1
    return (
        dealt.withColumn("_place", place)
        .join(F.broadcast(base), "_part")
        .withColumn(name, (F.col("_base") + F.col("_place")).cast("long"))
        .drop("_part", "_place", "_base")
    )
