"""Dotted paths into nested columns and JSON text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def has_path(schema: T.StructType, path: str) -> bool:
    kind: T.DataType = schema
    for key in path.split("."):
        if not isinstance(kind, T.StructType) or key not in kind.names:
            return False
        kind = kind[key].dataType
    return True


def path_or_null(schema: T.StructType, path: str) -> Column:
    """The value at a dotted path of the row; null where the schema has no such path."""
    if not has_path(schema, path):
        return F.lit(None).cast("string")
    return F.col(".".join(f"`{key}`" for key in path.split(".")))


def json_path(text: Column | str, path: str) -> Column:
    """The value at a dotted path of JSON text, as text; null on a missing path or bad JSON."""
    return F.get_json_object(F.col(text) if isinstance(text, str) else text, f"$.{path}")
