"""Documents without a declared schema, made of the events table, and scans of JSON files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isobar.queries.registry import SQL_K, events, payload_k, query, r6
from isobar.session import shared_folder
from isobar.sources import documents, variants

#: Every event as a document with an object, a list of objects, an odd key, an empty list, and a list of one to ten numbers.
_TEXT = """concat('{{"type": "', event_type, '", "place": {{"user": ', user_id, ', "odd key": [', event_id % 2 = 0, ', null]}}, "readings": [',
    '{{"value": ', value, ', "props": ', props, '}}, {{"value": null}}], "none": [], "more": [', {numbers}, ']}}')"""


def nested_events(spark, sf) -> DataFrame:
    numbers = "array_join(transform(sequence(0, int(event_id % 10)), i -> string(i * user_id)), ',')"
    return events(spark, sf).select("event_id", F.expr(_TEXT.format(numbers=numbers)).alias("text"))


_SQL_NUMBERS = "array_to_string(list_transform(range(0, event_id % 10 + 1), lambda i: CAST(i * user_id AS VARCHAR)), ',')"
_SQL_NESTED = f"(SELECT event_id, CAST({_TEXT.format(numbers=_SQL_NUMBERS)} AS JSON) AS doc FROM events)"
_SQL_LEAVES = f"""(SELECT event_id, regexp_replace(fullkey, '\\."([^"]*)"', '[''\\1'']', 'g') AS path,
    CASE type WHEN 'VARCHAR' THEN 'string' WHEN 'NULL' THEN 'null' WHEN 'BOOLEAN' THEN 'boolean' WHEN 'ARRAY' THEN 'list' ELSE 'number' END
        AS kind,
    CASE WHEN type = 'ARRAY' THEN '[]' ELSE atom ->> '$' END AS value
    FROM {_SQL_NESTED}, json_tree(doc) WHERE type <> 'OBJECT' AND (type <> 'ARRAY' OR json_array_length(value) = 0))"""


@query(
    "documents_long",
    f"""SELECT event_id, path, kind, CASE WHEN kind = 'number' THEN round(CAST(value AS DOUBLE), 6) END AS number,
        CASE WHEN kind <> 'number' THEN value END AS value FROM {_SQL_LEAVES}""",
)
def documents_long(spark, sf):
    """Every leaf of every document, whatever its depth and the length of its lists."""
    parsed = variants.parse_variants(nested_events(spark, sf), "text")
    found = variants.leaves(parsed, ["event_id"])
    number = F.col("kind") == "number"
    return found.select(
        "event_id",
        "path",
        "kind",
        F.when(number, r6(F.col("value").cast("double"))).alias("number"),
        F.when(~number, F.col("value")).alias("value"),
    )


@query(
    "path_facts",
    f"""SELECT path, sum(n)::BIGINT AS n_leaves, count(*) AS n_documents, sum(known)::BIGINT AS n_values FROM (
        SELECT regexp_replace(path, '\\[[0-9]+\\]', '[*]', 'g') AS path, event_id, count(*) AS n, count(*) FILTER (kind <> 'null') AS known
        FROM {_SQL_LEAVES} GROUP BY 1, 2) GROUP BY path""",
)
def path_facts(spark, sf):
    """Which paths there are, and how often: the schema that the data has."""
    parsed = variants.parse_variants(nested_events(spark, sf), "text")
    return variants.path_facts(variants.leaves(parsed, ["event_id"]), ["event_id"]).drop("kinds")


@query(
    "typed_paths",
    f"""SELECT event_id, event_type AS type, round(CAST(value AS DOUBLE), 6) AS reading, {SQL_K} AS k,
        CASE WHEN event_id % 10 >= 3 THEN 3 * user_id END AS fourth, event_id % 2 = 0 AS even, NULL::BIGINT AS absent FROM events""",
)
def typed_paths(spark, sf):
    parsed = variants.parse_variants(nested_events(spark, sf), "text")
    fields = {
        "type": ("$.type", "string"),
        "reading": ("$.readings[0].value", "double"),
        "k": ("$.readings[0].props.k", "bigint"),
        "fourth": ("$.more[3]", "bigint"),
        "even": ("$.place['odd key'][0]", "boolean"),
        "absent": ("$.type.deeper", "bigint"),
    }
    return parsed.select("event_id", *variants.typed_columns(parsed, fields)).withColumn("reading", r6("reading"))


def _landed(spark, sf) -> str:
    folder = shared_folder(spark, "json")
    rows = events(spark, sf).select("event_id", "event_type", F.struct("value", payload_k().alias("k")).alias("reading"))
    rows.write.json(folder)
    return folder


_SQL_SCAN = f"SELECT event_id, event_type, round(value, 6) AS value, {SQL_K} AS k FROM events"


@query("json_scan_inferred", _SQL_SCAN)
def json_scan_inferred(spark, sf):
    """Events written as JSON lines and read with the schema Spark infers."""
    found = documents.read_documents(spark, _landed(spark, sf))
    return found.select("event_id", "event_type", r6("reading.value").alias("value"), F.col("reading.k").alias("k"))


@query("json_scan_declared", _SQL_SCAN)
def json_scan_declared(spark, sf):
    """The same with a declared schema, which saves the pass that infers it and keeps widened numbers."""
    from pyspark.sql.types import StructType

    schema = StructType.fromDDL("event_id BIGINT, event_type STRING, reading STRUCT<value: DOUBLE, k: BIGINT, gone: STRING>")
    found = documents.read_documents(spark, _landed(spark, sf), schema)
    return found.select("event_id", "event_type", r6("reading.value").alias("value"), F.col("reading.k").alias("k"))


@query("json_scan_variant", _SQL_SCAN)
def json_scan_variant(spark, sf):
    """The same as variants: no schema at all, and lines that are no JSON set aside."""
    good, _ = variants.split_bad(variants.read_variants(spark, _landed(spark, sf)))
    fields = {"event_id": ("$.event_id", "bigint"), "event_type": ("$.event_type", "string"), "value": ("$.reading.value", "double"), "k": ("$.reading.k", "bigint")}
    return good.select(*variants.typed_columns(good, fields)).withColumn("value", r6("value"))
