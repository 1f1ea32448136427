"""A trie of conversation prefixes: nodes, sharing and what sharing saves, with one exact grouping of possibly shared prefixes.

Every prefix of a conversation has a digest of 128 bits: two numbers, each the exclusive or of a hash per turn that depends on
the turn's depth, role and text. A count-min sketch over all prefixes screens them: where its estimate is one, the prefix is in
one conversation only, and its node is emitted from its own row, without a shuffle. The other prefixes are grouped by their
digest, which is exact; a sketch that is too full only proves fewer.

The sketch has `ROWS` rows of cells that count 0, 1 or many. Tasks send what they touched in slices of cells; slices are merged
in streams; what goes to every task is one bit per cell: whether it counts one. Its size follows the number of prefixes up to
`MOST_CELLS` cells a row, 2 MB.

Sums over subtrees need no walk: a node's smallest member is the same on its way down as long as it is smallest, so what a node
saves is credited to that conversation, and a node sums its members' credits. Depth does not add rounds.

Positions and digests of a conversation that is longer than `target_rows` turns are made in range slices and stitched.

Defined results: turns are in the order of `turn`, null first, equal ones by role and then by text; a null role or text is
empty; rows without an id belong to no conversation; repeated rows are turns of their own; columns other than the four named
are ignored; an empty table has no nodes, not even a root. Sums over one conversation's own shared nodes run in one task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from isobar.llm.staging import join_counted, staged
from isobar.llm.textarrays import mix
from isobar.operators.ordered import TARGET_ROWS, with_row_index, with_slices

ROWS = 3
MOST_CELLS = 1 << 24
SLICE_CELLS = 1 << 16
_U = np.uint64

# Turns in order.


def turns_in_order(conversations: DataFrame, conv_id: str, turn: str, role: str, text: str, target_rows: int) -> DataFrame:
    """(c, at, h1, h2, size): the place of each turn from 0, two hashes of role and text, and bytes of the text."""
    who, what = F.coalesce(F.col(role), F.lit("")), F.coalesce(F.col(text), F.lit(""))
    rows = conversations.select(
        F.col(conv_id).cast("long").alias("c"),
        F.col(turn).alias("turn"),
        who.alias("role"),
        what.alias("text"),
        F.xxhash64(F.lit(1), who, what).alias("h1"),
        F.xxhash64(F.lit(2), who, what).alias("h2"),
        F.octet_length(what).cast("long").alias("size"),
    ).filter("c IS NOT NULL")
    placed = with_row_index(rows, "turn", ["role", "text"], ["c"], out="at", target_rows=target_rows)
    return placed.select("c", "at", "h1", "h2", "size")


def chained(turns: DataFrame, target_rows: int = TARGET_ROWS) -> DataFrame:
    """Adds depth, the digest (p1, p2) of the prefix that ends here, the one before (q1, q2), and whether the turn is the last.

    `turns` has c, at, h1, h2 and size; `at` orders the turns of c and is unique there.
    """
    sliced = with_slices(turns, ["c"], "at", target_rows=target_rows)
    own = [F.xxhash64("depth", "h1").alias("a1"), F.xxhash64("depth", "h2").alias("a2")]
    if sliced is None:
        w = Window.partitionBy("c").orderBy("at")
        rows = turns.select("*", F.row_number().over(w).cast("long").alias("depth"), F.lead("at").over(w).isNull().alias("last"))
        run = w.rowsBetween(Window.unboundedPreceding, 0)
        rows = rows.select("*", *own).withColumns({p: F.bit_xor(a).over(run) for p, a in (("p1", "a1"), ("p2", "a2"))})
    else:
        inside = Window.partitionBy("_slice").orderBy("at")
        along = Window.partitionBy("_slice.c").orderBy("_slice._part")
        before = along.rowsBetween(Window.unboundedPreceding, -1)
        sizes = sliced.groupBy("_slice").agg(F.count("*").alias("n"))
        sizes = sizes.select(
            F.col("_slice").alias("s"),
            F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"),
            F.lead("n").over(along).isNull().alias("end"),
        )
        rows = sliced.join(sizes, F.col("_slice") == F.col("s")).drop("s")
        rows = rows.withColumn("depth", (F.col("offset") + F.row_number().over(inside)).cast("long"))
        rows = rows.withColumn("last", F.col("end") & F.lead("at").over(inside).isNull()).select("*", *own).drop("offset", "end")
        rows = staged(rows, "turns")
        totals = rows.groupBy("_slice").agg(F.bit_xor("a1").alias("t1"), F.bit_xor("a2").alias("t2"))
        carried = totals.select(
            F.col("_slice").alias("s"), *[F.coalesce(F.bit_xor(t).over(before), F.lit(0)).alias(c) for t, c in (("t1", "c1"), ("t2", "c2"))]
        )
        run = inside.rowsBetween(Window.unboundedPreceding, 0)
        rows = rows.join(carried, F.col("_slice") == F.col("s")).drop("s")
        rows = rows.withColumns({p: F.bit_xor(a).over(run).bitwiseXOR(F.col(c)) for p, a, c in (("p1", "a1", "c1"), ("p2", "a2", "c2"))})
    before = {q: F.col(p).bitwiseXOR(F.col(a)) for q, p, a in (("q1", "p1", "a1"), ("q2", "p2", "a2"))}
    return rows.withColumns(before).select("c", "depth", "p1", "p2", "q1", "q2", "size", "last")


def with_shared_heads(turns: DataFrame, group: int, heads: str, most: int) -> tuple[DataFrame, DataFrame]:
    """Conversations rebuilt on the first turns of another one, and (c, n) of all conversations with their new lengths.

    Conversation c takes the first `heads` turns (at most `most`; an SQL expression of c) of c - c % group, then its own after as
    many. Both sides of the join have one row per conversation.
    """
    first = turns.filter((F.col("c") % group == 0) & (F.col("at") < most))
    first = first.groupBy(F.col("c").alias("base")).agg(F.array_sort(F.collect_list(F.struct("at", "h1", "h2", "size"))).alias("first"))
    sizes = turns.groupBy("c").agg(F.count("*").alias("own"))
    joined = sizes.withColumn("base", F.col("c") - F.col("c") % group).join(first, "base", "left")
    joined = joined.select("c", "own", F.expr(heads).cast("int").alias("h"), F.coalesce("first", F.array()).alias("first"))
    joined = joined.withColumn("first", F.slice("first", 1, F.col("h")))
    joined = staged(joined, "heads")
    borrowed = joined.select("c", F.inline("first"))
    kept = turns.filter(F.col("at") >= F.expr(heads)).withColumn("at", F.col("at") + most)
    lengths = joined.select("c", (F.size("first") + F.greatest(F.col("own") - F.col("h"), F.lit(0))).alias("n"))
    return borrowed.unionByName(kept), lengths


# The sketch.


def _cells(p1: np.ndarray, p2: np.ndarray, cells: int) -> Iterator[np.ndarray]:
    """The cell of each digest in every row of the sketch."""
    a, b = p1.view(np.uint64), p2.view(np.uint64)
    for k in range(ROWS):
        yield (mix(a + _U(k + 1) * b) & _U(cells - 1)).astype(np.int64) + k * cells


def _digests(batch: pa.RecordBatch, one: str, two: str) -> tuple[np.ndarray, np.ndarray]:
    return batch.column(one).to_numpy(), batch.column(two).to_numpy()


def _packed(counts: np.ndarray) -> bytes:
    """Cells of a slice: the touched ones and their counts, or two bits each, whichever is shorter."""
    touched = np.flatnonzero(counts)
    if 2 * len(touched) + len(touched) // 8 + 1 < len(counts) // 4:
        return b"s" + touched.astype(np.uint16).tobytes() + np.packbits(counts[touched] > 1).tobytes()
    return b"d" + np.packbits(counts > 0).tobytes() + np.packbits(counts > 1).tobytes()


def _unpacked(raw: bytes, size: int) -> np.ndarray:
    counts = np.zeros(size, np.uint8)
    if raw[:1] == b"s":
        n = (len(raw) - 1) * 8 // 17
        many = np.unpackbits(np.frombuffer(raw, np.uint8, offset=1 + 2 * n), count=n)
        counts[np.frombuffer(raw, np.uint16, n, 1)] = 1 + many
    else:
        both = np.unpackbits(np.frombuffer(raw, np.uint8, offset=1)).reshape(2, size)
        counts += both[0] + both[1]
    return counts


def single_cells(prefixes: DataFrame, cells: int) -> np.ndarray:
    """One bit per cell of the sketch over (p1, p2): whether exactly one prefix fell into it."""
    size = min(SLICE_CELLS, cells)

    def touched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(ROWS * cells, np.uint8)
        for batch in batches:
            for at in _cells(*_digests(batch, "p1", "p2"), cells):
                at, n = np.unique(at, return_counts=True)
                counts[at] = np.minimum(counts[at] + n, 2)
        parts = counts.reshape(-1, size)
        for k in np.flatnonzero(parts.any(1)):
            yield pa.RecordBatch.from_pydict({"part": pa.array([k], pa.int32()), "cells": pa.array([_packed(parts[k])], pa.binary())})

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # At most the sketch itself, 2 bits a cell by then, however many tasks sent slices.
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                new = _unpacked(raw, size)
                held[k] = np.minimum(held[k] + new, 2) if k in held else new
        for k, counts in held.items():
            yield pa.RecordBatch.from_pydict({"part": pa.array([k], pa.int32()), "cells": pa.array([np.packbits(counts == 1).tobytes()], pa.binary())})

    shape = "part int, cells binary"
    found = prefixes.select("p1", "p2").mapInArrow(touched, shape).repartition("part").mapInArrow(merged, shape).toArrow()
    single = np.zeros((ROWS * cells // size, size // 8), np.uint8)
    for k, raw in zip(found["part"].to_pylist(), found["cells"].to_pylist(), strict=True):
        single[k] = np.frombuffer(raw, np.uint8)
    return single.ravel()


def proven_column(single: np.ndarray, cells: int, one: Column, two: Column) -> Column:
    """True where the sketch's estimate is one."""

    @F.arrow_udf("boolean")
    def proven(p1: pa.Array, p2: pa.Array) -> pa.Array:
        found = np.zeros(len(p1), bool)
        for at in _cells(p1.to_numpy(), p2.to_numpy(), cells):
            found |= (single[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 == 1
        return pa.array(found)

    return proven(one, two)


def screened(prefixes: DataFrame, most_cells: int) -> DataFrame:
    """Adds `proven` (the prefix is in one conversation only) and `above` (so is the prefix before)."""
    n = prefixes.count()
    cells = 1 << 13
    while cells < min(4 * n, most_cells):
        cells *= 2
    single = single_cells(prefixes, cells)
    columns = [proven_column(single, cells, F.col(a), F.col(b)) for a, b in (("p1", "p2"), ("q1", "q2"))]
    # The root is never proven: all conversations start there.
    return prefixes.select("*", columns[0].alias("proven"), columns[1].alias("above")).withColumn("above", F.col("above") & (F.col("depth") > 1))


# Hashes of lists of ids.


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Joins the ids of neighbouring rows of a node; rows come sorted."""
    for batch in batches:
        p1, p2, c = (batch.column(k).to_numpy() for k in range(3))
        if not len(c):
            continue
        begin = np.flatnonzero(np.concatenate(([True], (p1[1:] != p1[:-1]) | (p2[1:] != p2[:-1]))))
        texts = c.astype(str).tolist()
        ids = [",".join(texts[a:b]) for a, b in zip(begin, np.append(begin[1:], len(c)), strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array(p1[begin]), pa.array(p2[begin]), pa.array(c[begin]), pa.array(ids)], ["p1", "p2", "first", "ids"])


def _hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hashes the joined ids of each node; rows come sorted, and a node's hash goes on from batch to batch."""
    key, state = None, None

    def done() -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"p1": [key[0]], "p2": [key[1]], "sha": [state.hexdigest()]})

    for batch in batches:
        finished = []
        for p1, p2, ids in zip(*(batch.column(k).to_pylist() for k in (0, 1, 3)), strict=True):
            if (p1, p2) == key:
                state.update(b",")
            else:
                if key is not None:
                    finished.append(done())
                key, state = (p1, p2), hashlib.sha256()
            state.update(ids.encode())
        if finished:
            yield pa.Table.from_batches(finished).combine_chunks().to_batches()[0]
    if key is not None:
        yield done()


def ends_hashes(ends: DataFrame) -> DataFrame:
    """(p1, p2, sha): SHA-256 of the rising, comma-joined ids c of each node.

    Ids are sorted and joined in ranges of all rows first; then each node's joined ids stream through one task, which holds one
    batch and the state of a hash.
    """
    n = int(ends.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    joined = (
        ends.select("p1", "p2", "c")
        .repartitionByRange(n, "p1", "p2", "c")
        .sortWithinPartitions("p1", "p2", "c")
        .mapInArrow(_chunks, "p1 long, p2 long, first long, ids string")
    )
    return joined.repartition(n, "p1", "p2").sortWithinPartitions("p1", "p2", "first").mapInArrow(_hashes, "p1 long, p2 long, sha string")


# Nodes.


def trie_nodes(prefixes: DataFrame, lengths: DataFrame, most_cells: int = MOST_CELLS) -> DataFrame:
    """The nodes of the trie of `prefixes` (the columns of `chained`); `lengths` has (c, n) of every conversation, also turnless."""
    rows = staged(screened(prefixes, most_cells), "prefixes")
    alone, shared = rows.filter("proven"), rows.filter("NOT proven")
    nodes = staged(
        shared.groupBy("p1", "p2").agg(
            F.min("c").alias("conv_id"),
            F.count("*").alias("n_convs"),
            F.sum(F.col("last").cast("long")).alias("n_ends"),
            *[F.max(x).alias(x) for x in ("depth", "size", "q1", "q2", "above")],
        ),
        "nodes",
    )
    saves = (F.col("n_convs") - 1) * F.col("size")
    # What each conversation is credited with: savings of the nodes it is the smallest member of, and a leaf if it ends in one.
    credit = staged(
        nodes.select(F.col("conv_id").alias("c"), saves.alias("saved"), (F.col("n_ends") == F.col("n_convs")).cast("long").alias("leaf"))
        .unionAll(alone.filter("last").select("c", F.lit(0).cast("long"), F.lit(1).cast("long")))
        .groupBy("c")
        .agg(F.sum("saved").alias("saved"), F.max("leaf").alias("leaf"))
        .filter("saved > 0 OR leaf > 0"),
        "credit",
    )
    # A node has what its smallest member saves from here on, and all that its other members save.
    further = Window.partitionBy("conv_id").orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, 0)
    own = nodes.filter("n_convs > 1").select("p1", "p2", F.sum(saves).over(further).alias("own"), "conv_id")
    # Where the sketch did not prove that a node has one member, the member may be credited with savings above the node.
    own = own.unionAll(nodes.filter("n_convs = 1").select("p1", "p2", F.lit(0).cast("long"), "conv_id"))
    own = own.join(credit.select(F.col("c").alias("conv_id"), "saved"), "conv_id", "left")
    zero, one = F.lit(0).cast("long"), F.lit(1).cast("long")
    members = shared.select("c", "p1", "p2").join(credit, "c")
    tops = alone.filter("NOT above")
    children = nodes.filter("NOT above").select("q1", "q2").unionAll(tops.select("q1", "q2"))
    sums = (
        members.select("p1", "p2", F.col("saved").alias("v"), F.col("leaf").alias("l"), zero.alias("k"))
        .unionAll(own.select("p1", "p2", F.col("own") - F.coalesce("saved", zero), zero, zero))
        .unionAll(children.select(F.col("q1"), F.col("q2"), zero, zero, one))
        .groupBy("p1", "p2")
        .agg(F.sum("v").alias("saved_tokens"), F.sum("l").alias("n_leaves"), F.sum("k").alias("n_children"))
    )
    turnless = lengths.filter("n = 0").select(zero.alias("p1"), zero.alias("p2"), "c")
    hashes = staged(ends_hashes(shared.filter("last").select("p1", "p2", "c").unionAll(turnless)), "ends")
    # The root has all conversations; one row of sums.
    top = lengths.agg(F.min("c").alias("c"), F.count("*").alias("n")).first()
    credits = credit.agg(F.sum("saved"), F.sum("leaf")).first()
    root = top["c"]
    nothing = hashlib.sha256(b"").hexdigest()
    parents = nodes.filter("n_convs > 1").select(F.col("p1").alias("q1"), F.col("p2").alias("q2"), F.col("conv_id").alias("up"))
    full = nodes.join(sums, ["p1", "p2"], "left").join(hashes, ["p1", "p2"], "left")
    full = full.select(
        "conv_id", "depth", "q1", "q2", "above", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("sha", F.lit(nothing)).alias("ends_sha256")
    )
    tail = F.when(F.col("last"), F.sha2(F.col("c").cast("string"), 256)).otherwise(nothing)
    local = alone.select(
        F.col("c").alias("conv_id"),
        "depth",
        "q1",
        "q2",
        "above",
        one.alias("n_convs"),
        F.when(F.col("last"), 0).otherwise(1).cast("long").alias("n_children"),
        one.alias("n_leaves"),
        zero.alias("saved_tokens"),
        tail.alias("ends_sha256"),
    )
    # Only nodes below a possibly shared one look their parent up.
    both = full.unionByName(local.filter("NOT above"))
    found = join_counted(both.filter("NOT above AND depth > 1"), parents, ["q1", "q2"])
    out = found.withColumn("parent", F.coalesce("up", "conv_id")).drop("up")
    out = out.unionByName(both.filter("above AND depth > 1").withColumn("parent", F.col("conv_id")))
    out = out.unionByName(both.filter("depth = 1").withColumn("parent", F.lit(root).cast("long")))
    out = out.unionByName(local.filter("above").withColumn("parent", F.col("conv_id")))
    at_root = hashes.filter("p1 = 0 AND p2 = 0").first()
    first_level = children.filter("q1 = 0 AND q2 = 0").count()
    spark = prefixes.sparkSession
    head = [(root, 0, None, top["n"], first_level, max(credits[1] or 0, 1), credits[0] or 0, at_root["sha"] if at_root else nothing)]
    shape = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
    head = spark.createDataFrame(head if top["n"] else [], shape)
    return out.withColumnRenamed("parent", "parent_conv_id").select(*head.columns).unionByName(head)


def conversation_trie(
    conversations: DataFrame,
    group: int = 5,
    heads: str | None = None,
    most_heads: int = 8,
    conv_id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    target_rows: int = TARGET_ROWS,
    most_cells: int = MOST_CELLS,
) -> DataFrame:
    """Nodes of the trie of all conversations; with `heads`, of conversations rebuilt by `with_shared_heads`."""
    turns = staged(turns_in_order(conversations, conv_id, turn, role, text, target_rows), "turns")
    if heads is None:
        lengths = turns.groupBy("c").agg(F.count("*").alias("n"))
    else:
        turns, lengths = with_shared_heads(turns, group, heads, most_heads)
    prefixes = staged(chained(turns, target_rows), "prefixes")
    return trie_nodes(prefixes, staged(lengths, "lengths"), most_cells)
