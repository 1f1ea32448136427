"""Mixing sources to target weights by a splitting tree over blocks.

The documents of a source are dealt by hash into blocks of about `block_words` words; the order of the blocks is thereby a
random permutation. A source gives each of its blocks once for every whole time that its target holds its size, and of the
rest so many blocks in permuted order as fit; the last of these is cut inside, document by document. The blocks that the
sources give are exact quotas. A binary tree over the output shards splits the quotas: at each node the left half's share is
one multivariate hypergeometric draw, so every shard's total is fixed and every mixture of blocks is as likely as by shuffling
all of them. Shards then take disjoint runs of each source's permuted blocks, and are shuffled inside: each copy has a place of
its own there, a hash of the document, the draw and the shard that has nothing to do with the blocks.

Defined results: a null text has no words; null is a source of its own, after all others; documents without words are never
drawn; equal rows are drawn each for itself; tables without words have targets of 0; no document is drawn more often than
`limit` times. Other columns than those named are ignored. A node of the tree holds one number per source.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from isobar.llm.ordering import ranked
from isobar.llm.staging import join_counted, staged

WORD = r"[^\x20\x09-\x0D]+"
SPREAD = 1 << 38
LEVELS = 4
COARSE = 1024


def _numbered_sources(rows: DataFrame) -> DataFrame:
    """(source, source_size, number): numbers by code point, null last."""
    totals = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    return ranked(totals, [F.col("source").asc_nulls_last()], "number")


def with_targets(sources: DataFrame, weights: Sequence[float], share: float, limit: float) -> DataFrame:
    """Adds `target`: shares by weight, none above `limit` times the size, the excess shared again by weight.

    The level is raised until no source above its limit is left; each round is one small aggregate.
    """
    pattern = F.array(*[F.lit(float(w)) for w in weights])
    weighted = sources.withColumn("weight", F.element_at(pattern, (F.col("number") % len(weights) + 1).cast("int"))).transform(staged)
    cap, level = F.col("source_size") * float(limit), -1.0
    total = weighted.agg(F.sum("source_size")).first()[0] or 0
    while True:
        over = cap < F.col("weight") * level
        held, free = weighted.agg(F.sum(F.when(over, cap)), F.sum(F.when(~over, F.col("weight")))).first()
        raised = (total * share - (held or 0.0)) / free if free else level
        if raised <= level:
            break
        level = raised
    return weighted.withColumn("target", F.least(cap, F.col("weight") * max(level, 0.0)))


def _split(seed: int, total: int, shards: int):
    """Splits the quotas of a node down to at most 2^LEVELS nodes below it."""

    def before(shard: int) -> int:
        return shard * total // shards

    def split(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("number")
        number = pdf["number"].to_numpy()
        done, open_nodes = [], [(int(pdf["low"].iloc[0]), int(pdf["high"].iloc[0]), pdf["quota"].to_numpy(np.int64), 0)]
        while open_nodes:
            low, high, quota, depth = open_nodes.pop()
            if high - low == 1 or depth == LEVELS:
                some = quota > 0
                done.append(pd.DataFrame({"number": number[some], "low": low, "high": high, "quota": quota[some]}))
                continue
            mid = (low + high) // 2
            draw = np.random.Generator(np.random.Philox(key=[seed, (low << 32) + high]))
            left = draw.multivariate_hypergeometric(quota, before(mid) - before(low), method="marginals")
            open_nodes += [(low, mid, left, depth + 1), (mid, high, quota - left, depth + 1)]
        return pd.concat(done, ignore_index=True)

    return split


def split_quotas(quotas: DataFrame, shards: int, seed: int) -> DataFrame:
    """(number, shard, first, quota) from (number, quota): the blocks `first` to `first + quota` of a source go to the shard."""
    total = int(quotas.agg(F.sum("quota")).first()[0] or 0)
    nodes = quotas.filter("quota > 0").select("number", F.lit(0).cast("long").alias("low"), F.lit(shards).cast("long").alias("high"), "quota")
    width = shards
    while width > 1:
        nodes = (
            nodes.groupBy("low", "high")
            .applyInPandas(_split(seed, total, shards), "number long, low long, high long, quota long")
            .transform(staged)
        )
        width = -(-width // 2**LEVELS)
    along = Window.partitionBy("number").orderBy("shard")
    return nodes.select("number", F.col("low").alias("shard"), "quota").withColumn("first", F.sum("quota").over(along) - F.col("quota"))


def _fill(pdf: pd.DataFrame) -> pd.DataFrame:
    """Takes the documents of one block, in permuted order, that still fit into the room, and one more if that is nearer."""
    pdf = pdf.sort_values(["spot", "doc_id", "size"])
    room, taken = float(pdf["room"].iloc[0]), []
    for size in pdf["size"]:
        taken.append(size <= room)
        room -= size if size <= room else 0
    left = [(size, k) for k, size in enumerate(pdf["size"]) if not taken[k]]
    if left and min(left)[0] < 2 * room:
        taken[min(left)[1]] = True
    return pdf.assign(extra=taken)[["row", "extra"]]


def mix(
    documents: DataFrame,
    weights: Sequence[float] = (3.0, 1.0, 2.0),
    share: float = 1.5,
    limit: float = 2.0,
    block_words: int = 1 << 17,
    blocks_per_shard: int = 64,
    seed: int = 20240229,
    text: str = "text",
    source: str = "source",
    doc_id: str = "doc_id",
) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, taken, shards, places.

    `shards` has the output shard of each copy drawn, `places` its place there (see `shard_rows`); `spot` tells its block.
    """
    spark = documents.sparkSession
    rows = documents.select(
        F.col(doc_id).alias("doc_id"),
        F.col(source).alias("source"),
        F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        F.pmod(F.xxhash64(F.lit(seed), F.col(doc_id), F.col(source), F.col(text)), F.lit(SPREAD)).alias("spot"),
        F.monotonically_increasing_id().alias("row"),
    ).transform(staged)
    sources = with_targets(_numbered_sources(rows), weights, share, limit)
    size = F.greatest(F.col("source_size"), F.lit(1))
    sources = sources.withColumn("blocks", F.ceil(size / block_words).cast("long"))
    sources = sources.withColumn("times", F.floor(F.col("target") / size).cast("long"))
    sources = sources.withColumn("rest", F.col("target") - F.col("times") * F.col("source_size")).transform(staged)
    placed = join_counted(rows, sources.drop("weight"), ["source"]).withColumn(
        "block", F.floor(F.col("spot") * F.col("blocks") / F.lit(float(SPREAD))).cast("long")
    )

    # The block in which the rest of each source ends: sums by stretches of blocks, then by blocks of one stretch.
    blocks = (
        placed.groupBy("number", "block", "rest")
        .agg(F.sum("size").alias("words"))
        .withColumn("stretch", F.floor(F.col("block") / COARSE))
        .transform(staged)
    )
    along = Window.partitionBy("number").orderBy("stretch")
    stretches = blocks.groupBy("number", "stretch").agg(F.sum("words").alias("all"))
    stretches = stretches.withColumn("earlier", F.sum("all").over(along) - F.col("all")).drop("all")
    inside = Window.partitionBy("number", "stretch").orderBy("block")
    ends = (
        blocks.join(stretches, ["number", "stretch"])
        .withColumn("so_far", F.col("earlier") + F.sum("words").over(inside) - F.col("words"))
        .filter((F.col("so_far") <= F.col("rest")) & (F.col("rest") < F.col("so_far") + F.col("words")))
        .select("number", F.col("block").alias("last"), (F.col("rest") - F.col("so_far")).alias("room"))
    )
    ends = ends.transform(staged)
    placed = join_counted(placed.filter("size > 0"), ends, ["number"])
    at_end = placed.filter("block = last").select("row", "spot", "doc_id", "size", "room", "number")
    extra = at_end.groupBy("number").applyInPandas(_fill, "row long, extra boolean").filter("extra")
    placed = placed.join(extra, "row", "left")

    drawn = F.col("times") * F.col("blocks") + F.col("block")
    whole = F.expr("CASE WHEN times > 0 THEN transform(sequence(0L, times - 1), t -> t * blocks + block) ELSE array() END")
    more = F.when((F.col("block") < F.col("last")) | F.col("extra"), F.array(drawn)).otherwise(F.array().cast("array<bigint>"))
    copies = placed.select("row", "number", "doc_id", "spot", F.explode(F.concat(whole.cast("array<bigint>"), more)).alias("draw"))

    quotas = join_counted(sources.filter("source_size > 0"), ends, ["number"]).select(
        "number", (F.col("times") * F.col("blocks") + F.coalesce(F.col("last") + 1, F.lit(0))).alias("quota")
    )
    quotas = quotas.transform(staged)
    shards = max(1, -(-int(quotas.agg(F.sum("quota")).first()[0] or 0) // blocks_per_shard))
    runs = split_quotas(quotas, shards, seed).filter("quota > 0")
    dealt = runs.select("number", "shard", F.explode(F.sequence("first", F.col("first") + F.col("quota") - 1)).alias("draw"))
    taken = (
        copies.join(dealt, ["number", "draw"])
        .withColumn("place", F.xxhash64(F.lit(seed + 1), "doc_id", "spot", "draw", "shard"))
        .groupBy("row")
        .agg(F.count("*").alias("times_taken"), F.sort_array(F.collect_list(F.struct("shard", "place"))).alias("copies"))
    )
    result = join_counted(rows, sources.select("source", "source_size", "target"), ["source"]).join(taken, "row", "left")
    return result.select(
        "doc_id",
        "source",
        "size",
        "source_size",
        "target",
        (F.col("size") * F.coalesce("times_taken", F.lit(0))).cast("long").alias("taken"),
        F.coalesce("copies.shard", F.array().cast("array<bigint>")).alias("shards"),
        F.coalesce("copies.place", F.array().cast("array<bigint>")).alias("places"),
        "spot",
    )


def shard_rows(mixed: DataFrame, tasks: int | None = None) -> DataFrame:
    """(shard, place, doc_id, source) of every copy; each shard's copies lie together, in their shuffled order."""
    copies = mixed.select("doc_id", "source", F.inline(F.arrays_zip(F.col("shards").alias("shard"), F.col("places").alias("place"))))
    copies = copies.select("shard", "place", "doc_id", "source")
    dealt = copies.repartition("shard") if tasks is None else copies.repartition(tasks, "shard")
    return dealt.sortWithinPartitions("shard", "place", "doc_id")
