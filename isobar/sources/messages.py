"""Kafka-shaped records: readers, the JSON envelope, and the split into good and rejected rows."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from isobar.schemas import ENVELOPES, KAFKA_RECORD, TOPICS


def kafka_options(servers: str, topics=TOPICS, **extra: str) -> dict[str, str]:
    """Subscription from the earliest offset. The stream checkpoint, not the broker, keeps offsets."""
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": ",".join(topics),
        "startingOffsets": "earliest",
        **extra,
    }


def read_kafka(spark: SparkSession, servers: str, topics=TOPICS, **extra: str) -> DataFrame:
    """Bounded read of everything the topics hold now."""
    return spark.read.format("kafka").options(**kafka_options(servers, topics, **extra)).load()


def stream_kafka(spark: SparkSession, servers: str, topics=TOPICS, **extra: str) -> DataFrame:
    return spark.readStream.format("kafka").options(**kafka_options(servers, topics, **extra)).load()


def read_landed(spark: SparkSession, path: str) -> DataFrame:
    """Records of the same shape landed as Parquet."""
    return spark.read.schema(KAFKA_RECORD).parquet(path)


def stream_landed(spark: SparkSession, path: str, **options: str) -> DataFrame:
    return spark.readStream.schema(KAFKA_RECORD).options(**options).parquet(path)


def widen(kind: T.DataType) -> T.DataType:
    """The type with every integer as a double, so that `1.0` is as good as `1` for an integer."""
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, widen(f.dataType)) for f in kind.fields])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(widen(kind.elementType))
    if isinstance(kind, (T.IntegerType, T.LongType)):
        return T.DoubleType()
    return kind


def parse_json(text: Column, schema: T.StructType) -> Column:
    """Struct of the schema plus `_corrupt_record`, which holds the text where it is bad JSON."""
    tolerant = widen(schema).add("_corrupt_record", T.StringType())
    exact = T.StructType(list(schema.fields)).add("_corrupt_record", T.StringType())
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}
    return F.from_json(text, tolerant, options).cast(exact)


def parse_envelopes(records: DataFrame, topic: str) -> DataFrame:
    """Records of one topic with their envelope parsed; no row is dropped.

    Exploding an array of one keeps later filters on the envelope above the parsing. Pushed below it
    they would parse the text once per test.
    """
    envelope = parse_json(F.col("value").cast("string"), ENVELOPES[topic])
    return records.filter(F.col("topic") == topic).select(
        "*", F.explode(F.array(envelope)).alias("envelope")
    )


# What a message needs for its id and its document; other missing fields become nulls.
REQUIRED = ("location", "current", "dt")


def is_good(parsed: DataFrame) -> Column:
    """Well-formed JSON that names its provider and holds the required parts of its payload."""
    payload = parsed.schema["envelope"].dataType["data"].dataType
    present = ["provider", *[f"data.{name}" for name in REQUIRED if name in payload.names]]
    tests = [F.col(f"envelope.{path}").isNotNull() for path in present]
    return F.coalesce(reduce(and_, tests, F.col("envelope._corrupt_record").isNull()), F.lit(False))


def good_records(parsed: DataFrame) -> DataFrame:
    return parsed.filter(is_good(parsed))


def rejected_records(parsed: DataFrame) -> DataFrame:
    """What `good_records` leaves out, as raw text for the quarantine sink."""
    return parsed.filter(~is_good(parsed)).select(
        "topic",
        "partition",
        "offset",
        "timestamp",
        F.col("value").cast("string").alias("value"),
    )


def parsed_once(parsed: DataFrame) -> DataFrame:
    """What a batch needs of its parsed records when it keeps them: envelopes of the good, raw values of the others.

    `good_records` and `rejected_records` of it are those of `parsed`; a message is held in one form and not in two.
    """
    good = is_good(parsed)
    return parsed.select(
        "topic",
        "partition",
        "offset",
        "timestamp",
        F.when(~good, F.col("value")).alias("value"),
        F.when(good, F.col("envelope")).alias("envelope"),
    )


def envelope_records(
    payloads: DataFrame,
    topic: str | Column,
    provider: str | Column,
    data: str = "data",
    latitude: str = "latitude",
    longitude: str = "longitude",
) -> DataFrame:
    """`(topic, value)` with the payload struct wrapped as JSON, ready for the Kafka sink."""
    as_value = lambda v: F.lit(v) if isinstance(v, str) else v
    body = F.struct(
        as_value(provider).alias("provider"),
        F.col(latitude).alias("latitude"),
        F.col(longitude).alias("longitude"),
        F.col(data).alias("data"),
    )
    return payloads.filter(F.col(data).isNotNull()).select(
        as_value(topic).alias("topic"), F.to_json(body).alias("value")
    )


def write_kafka(records: DataFrame, servers: str) -> None:
    records.write.format("kafka").option("kafka.bootstrap.servers", servers).save()


def stream_to_kafka(records: DataFrame, servers: str, checkpoint: str):
    return (
        records.writeStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("checkpointLocation", checkpoint)
    )
