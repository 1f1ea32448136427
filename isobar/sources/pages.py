"""Pages of a table by key, without scanning it for each page.

The rows are laid out once in the order of the key, with their place in it, in files of a fixed number of rows. Which files a page
of a number needs follows by division. Which files come after a key is told by the keys at the files' ends, one row per file, kept
beside them. Inside a file the parquet footers skip the row groups of other pages.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from isobar.operators.ordered import with_row_index

ROWS_PER_FILE = 1_000_000
# Small row groups, so that a page reads little more than its rows.
GROUP_BYTES = 1 << 20


class Pages:
    """Pages of `size` rows of a folder that `write` has laid out."""

    def __init__(self, spark: SparkSession, folder: str, size: int):
        self.spark = spark
        self.folder = folder
        self.size = size
        facts = spark.read.parquet(f"{folder}/files").orderBy("part").collect()
        # One entry per file.
        self.files = [(r["part"], r["n"], r["last"]) for r in facts]
        self.rows = sum(n for _, n, _ in self.files)
        self.rows_per_file = max((n for _, n, _ in self.files), default=1)
        self.schema = spark.read.parquet(f"{folder}/files").schema["row"].dataType

    @staticmethod
    def write(documents: DataFrame, folder: str, key: str = "_id", rows_per_file: int = ROWS_PER_FILE) -> None:
        """Lays the rows out by key; rows without a key come first, rows of one key are in any order."""
        placed = with_row_index(documents, key, out="_row")
        parted = placed.withColumn("_part", F.floor(F.col("_row") / rows_per_file).cast("long"))
        tasks = max(1, -(-documents.count() // rows_per_file))
        files = parted.repartition(tasks, "_part").sortWithinPartitions("_part", "_row")
        files.write.option("parquet.block.size", GROUP_BYTES).partitionBy("_part").parquet(f"{folder}/data")
        written = documents.sparkSession.read.schema(parted.schema).parquet(f"{folder}/data")
        ends = written.groupBy(F.col("_part").alias("part")).agg(F.count("*").alias("n"), F.max(F.struct("_row", key))[key].alias("last"))
        empty = F.lit(None).cast(documents.schema)
        ends.withColumn("row", empty).coalesce(1).write.parquet(f"{folder}/files")

    def __len__(self) -> int:
        return -(-self.rows // self.size)

    def _read(self, parts: list[int]) -> DataFrame:
        if not parts:
            return self.spark.createDataFrame([], self.schema).withColumn("_row", F.lit(None).cast("long"))
        paths = [f"{self.folder}/data/_part={p}" for p in parts]
        schema = type(self.schema)([*self.schema.fields]).add("_row", "long")
        return self.spark.read.schema(schema).parquet(*paths)

    def page(self, number: int) -> DataFrame:
        """The rows of a page, counted from 0, in order. It reads the files that hold them, mostly one."""
        low, high = number * self.size, (number + 1) * self.size - 1
        parts = [p for p, n, _ in self.files if p * self.rows_per_file <= high and p * self.rows_per_file + n > low]
        return self._read(parts).filter(F.col("_row").between(low, high)).orderBy("_row").drop("_row")

    def after(self, last, key: str = "_id") -> DataFrame:
        """The next `size` rows whose key is above `last`, in order; from the start with None.

        Reads from the first file that ends above the key, and as many more as a page can need.
        """
        if last is None:
            return self.page(0)
        parts, spare = [], 0
        for p, n, end in self.files:
            if end is None or end <= last:
                continue
            parts.append(p)
            # The first file may hold rows up to the key; the others count in full.
            spare += n if len(parts) > 1 else 0
            if spare >= self.size:
                break
        rest = self._read(parts).filter(F.col(key) > F.lit(last))
        return rest.orderBy("_row").limit(self.size).drop("_row")

    def walk(self) -> Iterator[DataFrame]:
        for number in range(len(self)):
            yield self.page(number)
