"""Folders of the shared store, by Spark's own file systems."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    place, files = _at(spark, path)
    return files.exists(place)


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names of what is in a folder; none where there is no folder."""
    place, files = _at(spark, folder)
    return sorted(f.getPath().getName() for f in files.listStatus(place)) if files.exists(place) else []


def delete(spark: SparkSession, path: str) -> None:
    """Deletes a file or a folder with all that is in it; nothing happens where there is none."""
    place, files = _at(spark, path)
    files.delete(place, True)


def touch(spark: SparkSession, path: str) -> bool:
    """Makes an empty file; False if it is there already. One of several callers wins."""
    place, files = _at(spark, path)
    try:
        files.create(place, False).close()
    except Exception as error:
        if "AlreadyExists" not in str(error) and "already exists" not in str(error):
            raise
        return False
    return True
