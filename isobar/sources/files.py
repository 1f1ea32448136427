"""CSV, Parquet and table sinks and their readers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from isobar.functions.times import iso_text


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    return spark.read.option("header", True).schema(schema).csv(path)


def write_csv(df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "overwrite"):
    """Folder of CSV parts, each with the header; no row goes through the driver."""
    writer = df.write.mode(mode).option("header", True)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.csv(path)


def append_rows(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Bulk append to a Parquet folder."""
    writer = df.write.mode("append")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def append_jdbc(df: DataFrame, url: str, table: str, batch_size: int = 1000, **options: str) -> None:
    """Batched insert into a relational table, by every task over its own connection."""
    df.write.format("jdbc").mode("append").options(
        url=url, dbtable=table, batchsize=str(batch_size), **options
    ).save()


def read_jdbc(spark: SparkSession, url: str, table: str, **options: str) -> DataFrame:
    """Table scan; give partitionColumn, lowerBound, upperBound and numPartitions to spread it."""
    return spark.read.format("jdbc").options(url=url, dbtable=table, **options).load()


def replace_table(df: DataFrame, table: str) -> None:
    df.write.mode("overwrite").saveAsTable(table)


def read_table(spark: SparkSession, table: str) -> DataFrame:
    return spark.table(table)


def iso_timestamps(df: DataFrame) -> DataFrame:
    """Every timestamp column as ISO text, as stored aggregates keep them."""
    names = [
        f.name for f in df.schema.fields if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType))
    ]
    return df.withColumns({name: iso_text(F.col(f"`{name}`")) for name in names})


def write_aggregate(df: DataFrame, path: str) -> None:
    """Aggregate rows as documents with ISO times."""
    iso_timestamps(df).write.mode("append").json(path)
