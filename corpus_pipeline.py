"""A training corpus from raw documents: five stages, each over all that the one before it kept.

Toxic documents go; one document of each group of near duplicates stays; documents that hold test passages go; personal data
is masked; what is left is mixed to the target weights of its sources. All stages but the last return the columns that they
were given.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from isobar.llm import lsh_forest, mixing, pii, spaced_seeds, toxicity
from isobar.llm.staging import staged
from isobar.queries.registry import table

#: No SQL for the fitted models and drawn blocks; the stages are tested against brute force instead.
ORACLE_SQL = None
TOXIC = 0.7


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents whose chance to be toxic is below `TOXIC`."""
    model = toxicity.fit_toxicity(docs, table(spark, sf_dir, "labels"), train=~toxicity.contract_split())
    return docs.filter(toxicity.score_column(model, F.col("text")) < TOXIC)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of at least 0.8 similar word shingles."""
    return lsh_forest.one_per_group(docs)


def drop_test_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that overlap no test item."""
    return spaced_seeds.without_overlaps(docs, table(spark, sf_dir, "benchmark"))


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with personal data replaced by its kind, and their new lengths."""
    field = pii.fit_field(docs)
    both = docs.select("*", pii.masked_column(field, F.col("text")).alias("__masked"))
    changed = ~F.col("text").eqNullSafe(F.col("__masked"))
    new = {"text": F.col("__masked"), "n_chars": F.when(changed, F.char_length("__masked").cast("long")).otherwise(F.col("n_chars"))}
    return both.select(*[new.get(c, F.col(c)).alias(c) for c in docs.columns])


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How often and into which shards of the mix each document goes."""
    return mixing.mix(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near duplicates", drop_near_duplicates),
    ("benchmark decontamination", drop_test_passages),
    ("personal data", mask_personal_data),
    ("mixing", mix_sources),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; each stage before it is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
