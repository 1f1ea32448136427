"""JSON documents without a declared schema: variants, and their leaves in long form.

A document is parsed once into a variant. `leaves` takes it apart level by level, one row per leaf, so a list of any length makes
rows and never columns. A path is written as the functions of variants read it, such as `$.a.list[3].b` or `$['odd key']`.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from isobar.session import shared_root

MOST_COLUMNS = 2000


def parse_variants(rows: DataFrame, text: str, out: str = "doc") -> DataFrame:
    """Adds the text as a variant; null where it is no JSON, also where it is null."""
    return rows.withColumn(out, F.try_parse_json(text))


def read_variants(spark: SparkSession, path: str) -> DataFrame:
    """(file, value, doc) of JSON lines; `doc` is null for a line that is no JSON. Empty lines are left out."""
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), "value")
    return parse_variants(lines.filter(F.trim("value") != ""), "value")


def split_bad(parsed: DataFrame, doc: str = "doc") -> tuple[DataFrame, DataFrame]:
    """Rows with a document, and rows without one for a quarantine."""
    return parsed.filter(F.col(doc).isNotNull()), parsed.filter(F.col(doc).isNull()).drop(doc)


def _step(key: Column, pos: Column) -> Column:
    """What one level adds to a path."""
    plain = key.rlike("^[A-Za-z_][A-Za-z0-9_]*$")
    quoted = F.concat(F.lit("['"), F.replace(key, F.lit("'"), F.lit("\\'")), F.lit("']"))
    named = F.when(plain, F.concat(F.lit("."), key)).otherwise(quoted)
    return F.when(key.isNotNull(), named).otherwise(F.concat(F.lit("["), pos.cast("string"), F.lit("]")))


def _kind(value: Column) -> Column:
    """Kind of a leaf: a plain kind, or that of an empty container."""
    name = F.schema_of_variant(value)
    return (
        F.when(name == "VOID", "null")
        .when(name == "STRING", "string")
        .when(name == "BOOLEAN", "boolean")
        .when(name.startswith("OBJECT"), "object")
        .when(name.startswith("ARRAY"), "list")
        .when(name.startswith("DECIMAL") | name.isin("BIGINT", "DOUBLE", "FLOAT"), "number")
        .otherwise(F.lower(name))
    )


def leaves(documents: DataFrame, ids: Sequence[str], doc: str = "doc") -> DataFrame:
    """(ids.., path, leaf, kind, value): one row per leaf, the value as text.

    `leaf` is the last key on the way, of list elements that of their list; null at the top. Empty objects and lists are leaves
    too. Rows without a document have none. Each level is kept before the next one is taken apart, so a document is read once
    per level and the plan does not grow with the depth.
    """
    shared_root(documents.sparkSession)
    tvf = documents.sparkSession.tvf
    level = documents.filter(F.col(doc).isNotNull()).select(
        *ids, F.lit("$").alias("_path"), F.lit(None).cast("string").alias("_leaf"), F.col(doc).alias("_value")
    )
    found = None
    while True:
        below = level.lateralJoin(tvf.variant_explode_outer(F.col("_value").outer()))
        # Without a place there is nothing inside: the row itself is a leaf.
        placed = F.col("pos").isNotNull()
        level = below.select(
            *ids,
            F.when(placed, F.concat("_path", _step(F.col("key"), F.col("pos")))).otherwise(F.col("_path")).alias("_path"),
            F.when(placed, F.coalesce("key", "_leaf")).otherwise(F.col("_leaf")).alias("_leaf"),
            F.when(placed, F.col("value")).otherwise(F.col("_value")).alias("_value"),
            (~placed).alias("_done"),
        ).checkpoint()
        done = level.filter("_done").drop("_done")
        found = done if found is None else found.unionAll(done)
        level = level.filter("NOT _done").drop("_done")
        if level.isEmpty():
            break
    text = F.when(F.col("kind").isin("object", "list"), F.to_json("_value")).otherwise(F.try_variant_get("_value", "$", "string"))
    return found.withColumn("kind", _kind(F.col("_value"))).select(
        *ids, F.col("_path").alias("path"), F.col("_leaf").alias("leaf"), "kind", text.alias("value")
    )


def path_facts(rows: DataFrame, ids: Sequence[str]) -> DataFrame:
    """Per path, places in lists as `[*]`: leaves, documents that have one, kinds, and leaves that are not null."""
    whole = rows.withColumn("path", F.regexp_replace("path", r"\[[0-9]+\]", "[*]"))
    per_document = whole.groupBy("path", *ids).agg(
        F.count("*").alias("n"), F.count_if(F.col("kind") != "null").alias("known"), F.collect_set("kind").alias("kinds")
    )
    return per_document.groupBy("path").agg(
        F.sum("n").alias("n_leaves"),
        F.count("*").alias("n_documents"),
        F.sum("known").alias("n_values"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("kinds")))).alias("kinds"),
    )


def typed_columns(documents: DataFrame, fields: Mapping[str, tuple[str, str]], doc: str = "doc") -> list[Column]:
    """Columns `name: (path, type)`; null where the path is absent or the value is of no such type."""
    return [F.try_variant_get(doc, path, kind).alias(name) for name, (path, kind) in fields.items()]


def _flat_name(path: Column, separator: str) -> Column:
    inner = F.regexp_replace(path, r"\['((?:[^'\\]|\\.)*)'\]", ".$1")
    inner = F.regexp_replace(inner, r"\[([0-9]+)\]", ".$1")
    return F.replace(F.regexp_replace(inner, r"^\$\.?", ""), F.lit("."), F.lit(separator))


def wide(rows: DataFrame, ids: Sequence[str], separator: str = "_", most_columns: int = MOST_COLUMNS) -> DataFrame:
    """Columns named by their path, `a_0_b`, with the text of the leaves; sorted by name.

    Fails above `most_columns` columns: long lists belong into the long form.
    """
    shared_root(rows.sparkSession)
    named = rows.withColumn("path", _flat_name(F.col("path"), separator)).checkpoint()
    names = [r[0] for r in named.select("path").distinct().limit(most_columns + 1).collect()]
    if len(names) > most_columns:
        raise ValueError(f"more than {most_columns} columns; keep the long form or raise most_columns")
    return named.groupBy(*ids).pivot("path", sorted(names)).agg(F.first("value"))
