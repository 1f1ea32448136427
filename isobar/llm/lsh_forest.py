"""N-gram Jaccard join by a MinHash LSH forest.

A document is its set of `words_per_gram`-word shingles. Documents with equal sets are one class and are compared once. The
signature of a class is dealt to `trees` trees of `depth` minimum hashes, its paths. The paths of all classes are sorted, tree by
tree, into ranges of the whole order; there each path is laid beside its neighbours, and those that share less than `shortest`
minima with both are in no node with another class and go at once. What is left are the shared nodes of the prefix tries.

The nodes are walked from depth `depth` upwards. A step takes the nodes one level higher, whose prefixes are a minimum shorter, and
compares only pairs that no earlier step and no earlier tree of this one has brought together. After each step the recall so far is
measured on the links found: a link of similarity s would have been met with a chance of 1 - (1 - s^d)^trees, so it stands for one
over that chance of links, found or not. The walk ends at the first depth at which links found over links stood for reaches
`recall` in every band of similarity that has links (a fourth of the range above the threshold) and over all links and one more,
at the threshold itself, so that a table with few links is walked further and not less far.

All pairs of a node are verified on the whole shingle sets. A node is cut into blocks; each pair of blocks is one group, which
multiplies the sets as a matrix and gives back a spanning forest of the links it found, a number of links per class and one per
narrow band, so what leaves it grows with its classes and not with their pairs. Nodes with the same members in several trees or
depths are compared once, and a link is counted where its ends first meet.

Blocks have about `block` classes and on average at most `BLOCK_GRAMS` shingles, unless one class has more; those of nodes of more
than `crowd` classes, as thousands of near copies make them, are wider as far as the shingles allow. The number of pairs compared
still grows with the square of a node's classes.

Where only groups are asked for, such nodes are thinned first: all their classes are compared with a few pivots. What is then
linked to the first pivot, over any links, is one group. Only classes outside it go on, with those inside that one of them may
still be linked to: by the triangle inequality of the Jaccard distance, two classes whose distances from a pivot differ by more
than the link distance have no link. So no group is lost, and a crowd of copies costs a few comparisons each. A node is thinned
again only while at most half of it is left, so the rounds grow with the logarithm of the largest node. What is left then is
compared in blocks, but for the blocks that hold classes of one group already found. Links are not counted then, and the recall is
measured on those that were compared.

Defined results: texts of fewer words than a shingle are one shingle; null and empty texts, and others without words, are
alike only if they are equal; rows with one id count each; a null id is no class id, unless all ids of a group are null; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from isobar.llm.components import components
from isobar.llm.staging import BROADCAST_ROWS, join_counted, staged
from isobar.llm.textarrays import NORMAL_WORDS, grams, mix, words

_MASK = np.uint64((1 << 48) - 1)
_SHIFT = np.uint64(48)
_EDGE = 1e-9
#: Most shingles of a block on average, unless a class has more.
BLOCK_GRAMS = 2_000_000
#: Bands of similarity above the threshold: in which links are counted, and in which recall is demanded.
NARROW, WIDE = 40, 4


def chance(similarity: float | np.ndarray, d: int, trees: int) -> float | np.ndarray:
    """Of two sets of that similarity to share a prefix of d minima in some tree."""
    return 1 - (1 - similarity**d) ** trees


def measured_recall(links: np.ndarray, similarity: float, d: int, trees: int) -> float:
    """The least share of links found, over all of them and over each of the `WIDE` bands that have some.

    `links` are their numbers in `NARROW` bands; all of them are one more, at the threshold itself.
    """
    low = similarity + (1 - similarity) / NARROW * np.arange(NARROW)
    met, stood_for = (x.reshape(WIDE, -1).sum(1) for x in (links, links / chance(low, d, trees)))
    whole = (met.sum() + 1) / (stood_for.sum() + 1 / chance(similarity, d, trees))
    return float(min([whole, *(met[met > 0] / stood_for[met > 0])]))


def text_key(text: Column) -> list[Column]:
    return [F.xxhash64(text).alias("t1"), F.xxhash64(F.lit(7), text).alias("t2")]


def gram_sets(texts: pa.Array, k: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first text, texts, text of each distinct shingle, its 48-bit hash), in order."""
    for w in words(texts, NORMAL_WORDS, wide=True):
        places, gram = grams(w, k)
        key = np.unique((w.doc[places].astype(np.uint64) << _SHIFT) | (gram >> np.uint64(16)))
        yield w.first, w.n, (key >> _SHIFT).astype(np.int64), key & _MASK


def _hashes(number: int) -> tuple[np.ndarray, np.ndarray]:
    draw = np.random.Generator(np.random.Philox(key=[41, 17]))
    return draw.integers(0, 1 << 32, number, np.uint32), draw.integers(0, 1 << 32, number, np.uint32) | np.uint32(1)


def _minima(gram: np.ndarray, begin: np.ndarray, number: int) -> np.ndarray:
    """Minimum hashes of the runs of shingles that start at `begin`."""
    xor, factor = _hashes(number)
    x = (_spread(gram) >> np.uint64(32)).astype(np.uint32)
    return np.stack([np.minimum.reduceat((x ^ xor[j]) * factor[j], begin) for j in range(number)], 1)


def _spread(gram: np.ndarray) -> np.ndarray:
    return mix(gram ^ np.uint64(0x5DEECE66D))


def _signatures(k: int, trees: int, depth: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = len(batch)
            count, s1, s2 = np.zeros(n, np.int64), np.zeros(n, np.uint64), np.zeros(n, np.uint64)
            signature = np.zeros((n, trees * depth), np.uint32)
            for first, _, doc, gram in gram_sets(batch.column("text"), k):
                if not len(doc):
                    continue
                begin = np.flatnonzero(np.concatenate(([True], doc[1:] != doc[:-1])))
                own = first + doc[begin]
                count[own] = np.diff(np.append(begin, len(doc)))
                s1[own] = np.add.reduceat(mix(gram), begin)
                s2[own] = np.add.reduceat(_spread(gram), begin)
                signature[own] = _minima(gram, begin, trees * depth)
            rows = pa.FixedSizeBinaryArray.from_buffers(pa.binary(4 * trees * depth), n, [None, pa.py_buffer(signature.tobytes())])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("t1"),
                    batch.column("t2"),
                    pa.array(count),
                    pa.array(s1.view(np.int64)),
                    pa.array(s2.view(np.int64)),
                    rows.cast(pa.binary()),
                ],
                ["doc_id", "t1", "t2", "n", "s1", "s2", "signature"],
            )

    return run


def _shared_paths(depth: int, shortest: int):
    """Of sorted paths, those that share a prefix of `shortest` minima with a neighbour; the ends of a range may have one beyond it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, before = [], depth
        for batch in batches:
            if not len(batch):
                continue
            rows = pa.Table.from_batches([*last, batch]).combine_chunks()
            tree = rows["tree"].to_numpy()
            path = np.frombuffer(b"".join(rows["path"].to_pylist()), np.uint32).reshape(-1, depth)
            same = np.logical_and.accumulate(path[1:] == path[:-1], 1).sum(1) * (tree[1:] == tree[:-1])
            lcp = np.concatenate(([before], same))
            keep = np.maximum(lcp[:-1], lcp[1:]) >= shortest
            yield from rows.slice(0, len(keep)).filter(pa.array(keep)).to_batches()
            last, before = rows.slice(len(keep)).combine_chunks().to_batches(), int(lcp[-1])
        yield from last

    return run


def _sets(k: int, trees: int, depth: int):
    """Packed shingles and signature of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, signatures = [], []
            for _, n, doc, gram in gram_sets(batch.column("text"), k):
                raw = np.ascontiguousarray(gram.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6])
                edge = np.searchsorted(doc, np.arange(n + 1))
                out += [raw[a:b].tobytes() for a, b in zip(edge[:-1], edge[1:], strict=True)]
                # Every text here has a shingle.
                signatures += [row.tobytes() for row in _minima(gram, edge[:-1], trees * depth)]
            columns = [batch.column("cid"), pa.array(out, pa.binary()), pa.array(signatures, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["cid", "grams", "signature"])

    return run


def _labels(signature: np.ndarray, d: int) -> np.ndarray:
    """One number per row and tree that stands for a prefix of d minima."""
    label = np.zeros(signature.shape[:2], np.uint64)
    for j in range(d):
        label = mix(label ^ signature[:, :, j].astype(np.uint64)) + np.uint64(j)
    return label


def _unpack(raw: bytes) -> np.ndarray:
    part = np.frombuffer(raw, np.uint8).reshape(-1, 6)
    return np.concatenate([part, np.zeros((len(part), 2), np.uint8)], 1).view("<u8").ravel()


def _compare(table: pa.Table) -> pa.Table:
    """Similarity of each set of a group with that of its first member."""
    table = table.sort_by("first")
    raw = table["grams"]
    base, out = _unpack(raw[0].as_py()), []
    for k in range(1, table.num_rows):
        own = _unpack(raw[k].as_py())
        common = len(np.intersect1d(base, own, assume_unique=True))
        out.append(common / (len(base) + len(own) - common))
    rest = table.slice(1)
    return pa.table({"a": rest["a"], "b": rest["b"], "similarity": pa.array(out, pa.float64())})


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b, similarity) of the pairs; the sets of one `a` meet in groups of at most about 256 partners."""
    dealt = pairs.select("a", "b", F.pmod(F.xxhash64("b"), F.ceil(F.col("of") / 256).cast("long")).alias("salt"))
    own = dealt.select("a", "salt").distinct().select("a", F.col("a").alias("b"), "salt")
    wanted = own.unionAll(dealt.select("a", "b", "salt")).join(sets.withColumnRenamed("cid", "b"), "b")
    wanted = wanted.withColumn("first", (F.col("a") != F.col("b")).cast("int"))
    return wanted.groupBy("a", "salt").applyInArrow(_compare, "a long, b long, similarity double")


def _common(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Numbers of common elements of the sets at `left` and those at `right`."""
    owner = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    _, element, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = times > 1
    column = (np.cumsum(shared) - 1)[element]
    owner, column = owner[shared[element]], column[shared[element]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    out = np.zeros((len(left), len(right)), np.float32)
    for first in range(0, int(shared.sum()), 4096):
        a, b = np.searchsorted(column, [first, first + 4096])
        part = np.zeros((len(sets), min(4096, int(shared.sum()) - first)), np.float32)
        part[owner[a:b], column[a:b] - first] = 1
        out += part[left] @ part[right].T
    return out


def _forest(hit: np.ndarray) -> list[tuple[int, int]]:
    """A spanning forest of the links of a symmetric matrix."""
    open_, edges = np.ones(len(hit), bool), []
    for root in range(len(hit)):
        if not open_[root]:
            continue
        open_[root], frontier = False, [root]
        while frontier:
            at = frontier.pop()
            found = np.flatnonzero(hit[at] & open_)
            open_[found] = False
            edges += [(at, int(x)) for x in found]
            frontier += found.tolist()
    return edges


def _met(signature: np.ndarray, left: np.ndarray, right: np.ndarray, tree: int, d: int) -> np.ndarray:
    """Which pairs share a longer prefix in any tree, or this one in an earlier tree, or are one class."""
    met = left[:, None] == right[None, :]
    labels = [_labels(signature[:, :tree], d)]
    if d < signature.shape[2]:
        labels.append(_labels(signature, d + 1))
    for label in labels:
        for t in range(label.shape[1]):
            met |= label[left, t][:, None] == label[right, t][None, :]
    return met


def _verify_blocks(similarity: float, trees: int, depth: int, d: int):
    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("cid")
        cid, tree = table["cid"].to_numpy(), int(table["tree"][0].as_py())
        i, j = table["i"][0].as_py(), table["j"][0].as_py()
        signature = np.frombuffer(b"".join(table["signature"].to_pylist()), np.uint32).reshape(-1, trees, depth)
        block = table["own"].to_numpy()
        left, right = np.flatnonzero(block == i), np.flatnonzero(block == j)
        new = ~_met(signature, left, right, tree, d)
        some, other = new.any(1), new.any(0)
        left, right, new = left[some], right[other], new[some][:, other]
        # Only classes with a pair that has not met are unpacked.
        used = np.union1d(left, right)
        cid, sets = cid[used], [_unpack(table["grams"][int(x)].as_py()) for x in used]
        left, right = np.searchsorted(used, left), np.searchsorted(used, right)
        size = np.array([len(x) for x in sets], np.int64)
        links, count, bands = np.zeros((len(used), len(used)), bool), np.zeros(len(used), np.int64), np.zeros(NARROW, np.int64)
        if len(used):
            common = _common(sets, left, right)
            alike = common / (size[left][:, None] + size[right][None, :] - common)
            hit = (alike >= similarity - _EDGE) & new
            links[np.ix_(left, right)] = hit
            links |= links.T
            count = links.sum(1)
            band = ((alike[hit] - similarity + _EDGE) / (1 - similarity) * NARROW).astype(int)
            # Inside one block each pair is there twice.
            bands = np.bincount(np.clip(band, 0, NARROW - 1), minlength=NARROW) // (2 if i == j else 1)
        edges = np.array(_forest(links), np.int64).reshape(-1, 2)
        linked, counted = np.flatnonzero(count), np.flatnonzero(bands)
        # The float of the matrix is not the quotient of the numbers; that is made again for the links told.
        a, b = np.sort(cid[edges], 1).T if len(edges) else (np.zeros(0, np.int64), np.zeros(0, np.int64))
        exact = [len(np.intersect1d(sets[x], sets[y], assume_unique=True)) for x, y in edges]
        quotient = [n / (size[x] + size[y] - n) for n, (x, y) in zip(exact, edges, strict=True)]
        none = [None] * len(linked)
        return pa.table(
            {
                "a": pa.array([*a.tolist(), *cid[linked].tolist(), *[None] * len(counted)], pa.int64()),
                "b": pa.array([*b.tolist(), *none, *counted.tolist()], pa.int64()),
                "similarity": pa.array([*quotient, *none, *[None] * len(counted)], pa.float64()),
                "n": pa.array([*[None] * len(a), *count[linked].tolist(), *bands[counted].tolist()], pa.int64()),
            }
        )

    return run


def _blocks(block: int, crowd: int) -> Column:
    """Number of blocks of a bucket of n classes and `volume` shingles."""
    classes = F.when(F.col("n") <= crowd, F.col("n") / block).otherwise(F.col("n") / crowd)
    return F.ceil(F.least("n", F.greatest(classes, F.col("volume") / BLOCK_GRAMS))).cast("long")


def _numbers(until: Column) -> Column:
    return F.sequence(F.lit(0).cast("long"), until - 1)


def _in_blocks(members: DataFrame) -> DataFrame:
    """From (bucket, tree, blocks, cid): the block of each, and all blocks, which it is compared with."""
    own = F.pmod(F.xxhash64("cid"), F.col("blocks"))
    return members.select("bucket", "tree", "cid", own.alias("own"), _numbers(F.col("blocks")).alias("others"))


def _in_group_blocks(members: DataFrame, roots: DataFrame, block: int, crowd: int) -> DataFrame:
    """As `_in_blocks`, from (bucket, tree, size, cid) and the groups known: one of at least `block` classes of a bucket has blocks of
    its own, which are not compared with each other."""
    rooted = members.join(roots, "cid", "left").withColumn("root", F.coalesce("root", "cid"))
    groups = rooted.groupBy("bucket", "root").agg(F.count("*").alias("n"), F.sum("size").alias("volume"))
    groups = staged(groups.withColumn("alone", F.when(F.col("n") >= block, F.col("root"))), "groups")
    parts = groups.groupBy("bucket", "alone").agg(F.sum("n").alias("n"), F.sum("volume").alias("volume"))
    parts = parts.select("bucket", F.col("alone").alias("part"), _blocks(block, crowd).alias("blocks"))
    whole = Window.partitionBy("bucket")
    until = F.sum("blocks").over(whole.orderBy(F.asc_nulls_first("part")).rowsBetween(Window.unboundedPreceding, 0))
    parts = parts.select("*", (until - F.col("blocks")).alias("first"), F.sum("blocks").over(whole).alias("all"))
    large = groups.filter("alone IS NOT NULL").select("bucket", "root", "alone")
    placed = join_counted(join_counted(rooted, large, ["bucket", "root"]).withColumnRenamed("alone", "part"), parts, ["bucket", "part"])
    begin, end = F.col("first"), F.col("first") + F.col("blocks")
    others = F.filter(_numbers(F.col("all")), lambda x: F.col("part").isNull() | (x < begin) | (x >= end))
    own = begin + F.pmod(F.xxhash64("cid"), F.col("blocks"))
    return placed.select("bucket", "tree", "cid", own.alias("own"), others.alias("others"))


def _verified_buckets(members: DataFrame, sets: DataFrame, verify) -> DataFrame:
    """From (bucket, tree, cid, own, others): (a, b, similarity, null) of links, (a, null, null, n) of numbers of links and (null, b,
    null, n) of those in a band."""
    other = members.withColumn("other", F.explode("others"))
    dealt = other.select("bucket", "tree", "cid", "own", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))
    return dealt.join(sets, "cid").groupBy("bucket", "i", "j").applyInArrow(verify, "a long, b long, similarity double, n long")


def _of(bucketed: DataFrame, buckets: DataFrame) -> DataFrame:
    """The members of some buckets, with the buckets' columns."""
    few = buckets.count() <= BROADCAST_ROWS
    return bucketed.join(F.broadcast(buckets) if few else buckets, "bucket")


def similar_classes(
    documents: DataFrame,
    similarity: float = 0.8,
    words_per_gram: int = 5,
    trees: int = 16,
    depth: int = 8,
    recall: float = 0.998,
    shortest: int = 4,
    block: int = 384,
    crowd: int = 2048,
    pivots: int = 8,
    text: str = "text",
    doc_id: str = "doc_id",
    counted: bool = True,
) -> tuple[DataFrame, DataFrame, DataFrame | None, tuple[int, float]]:
    """(documents, links, degrees, reached): documents as (doc_id, t1, t2, cid, class_size); links between classes as (a, b,
    similarity), enough of them to join all groups; degrees as (node, n_links), the number of all links of a class; the depth at
    which the walk ended, and the recall measured there. Without `counted` there are no degrees, and crowded buckets are thinned
    by pivots."""
    rows = documents.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    keyed = rows.select("doc_id", "text", *text_key(F.col("text")))
    shape = "doc_id long, t1 long, t2 long, n long, s1 long, s2 long, signature binary"
    slim = keyed.mapInArrow(_signatures(words_per_gram, trees, depth), shape)
    wordless = F.col("n") == 0
    slim = slim.withColumns({"s1": F.when(wordless, F.col("t1")).otherwise(F.col("s1")), "s2": F.when(wordless, F.col("t2")).otherwise(F.col("s2"))})
    slim = staged(slim, "signatures")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "t1", "t2")).alias("least")
    classes = slim.groupBy("n", "s1", "s2").agg(first, F.count("*").alias("class_size"), F.first("signature").alias("signature"))
    classes = staged(classes.withColumn("cid", F.monotonically_increasing_id()), "classes")

    tree = classes.filter("n > 0").select("cid", "n", "signature", F.explode(F.sequence(F.lit(0), F.lit(trees - 1))).alias("tree"))
    part = F.substring("signature", F.col("tree") * (4 * depth) + 1, F.lit(4 * depth))
    paths = tree.select("tree", part.alias("path"), "cid", F.col("n").alias("size"))
    paths = paths.repartitionByRange("tree", "path", "cid").sortWithinPartitions("tree", "path")
    trie = staged(paths.mapInArrow(_shared_paths(depth, shortest), "tree int, path binary, cid long, size long"), "trie")

    seen, sets, told, known = [], [], [], None
    bands, d, reached = np.zeros(NARROW), depth, 1.0
    for d in range(depth, shortest - 1, -1):
        whole = trie.select("cid", "tree", "size", F.xxhash64("tree", F.substring("path", 1, 4 * d)).alias("bucket"))
        sized = whole.groupBy("bucket", "tree").agg(
            F.count("*").alias("n"),
            F.sum("size").alias("volume"),
            F.bit_xor(F.xxhash64("cid")).alias("x1"),
            F.bit_xor(F.xxhash64(F.lit(3), "cid")).alias("x2"),
        )
        # Of nodes with the same members, those of the first tree of the deepest step.
        same = ["n", "volume", "x1", "x2"]
        sizes = sized.filter("n > 1").groupBy(*same).agg(F.min(F.struct("tree", "bucket")).alias("f"))
        if seen:
            sizes = sizes.join(_all(seen), same, "left_anti")
        sizes = staged(sizes.select(*same, "f.tree", "f.bucket", _blocks(block, crowd).alias("blocks")), "buckets")
        seen.append(sizes.select(*same))
        if not sizes.isEmpty():
            members = staged(_of(whole.drop("tree"), sizes.drop("volume", "x1", "x2")), "members")
            sets.append(_new_sets(keyed, classes, members, sets, _sets(words_per_gram, trees, depth)))
            held, dealt = _all(sets), _in_blocks(members)
            crowded = members.filter(F.col("n") > crowd)
            if not counted and not crowded.isEmpty():
                open_ = crowded.select("bucket", "tree", "size", "cid")
                thinned, known, roots = _thin(open_, held.select("cid", "grams"), similarity, crowd, pivots, known)
                dealt = _in_blocks(members.filter(F.col("n") <= crowd)).unionByName(_in_group_blocks(thinned, roots, block, crowd))
            verify = _verify_blocks(similarity, trees, depth, d)
            told.append(staged(_verified_buckets(dealt, held, verify), "told"))
            for r in told[-1].filter("a IS NULL").groupBy("b").agg(F.sum("n").alias("n")).collect():
                bands[r.b] += r.n
        by_pivots = np.zeros(NARROW)
        if known is not None:
            band = F.floor((F.col("similarity") - similarity + _EDGE) / (1 - similarity) * NARROW)
            for r in known.filter(F.col("similarity") >= similarity - _EDGE).groupBy(band.alias("b")).count().collect():
                by_pivots[min(r.b, NARROW - 1)] = r["count"]
        reached = measured_recall(bands + by_pivots, similarity, d, trees)
        if reached >= recall:
            break

    none = documents.sparkSession.createDataFrame([], "a long, b long, similarity double, n long")
    told = _all([none, *told])
    links = told.filter("a IS NOT NULL AND b IS NOT NULL").select("a", "b", "similarity")
    if known is not None:
        links = links.unionAll(known.filter(F.col("similarity") >= similarity - _EDGE))
    links = staged(links.dropDuplicates(["a", "b"]), "links")
    degree = told.filter("b IS NULL").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("n_links")) if counted else None
    joined = slim.join(classes.select("n", "s1", "s2", "cid", "class_size"), ["n", "s1", "s2"])
    return joined.select("doc_id", "t1", "t2", "cid", "class_size"), links, degree, (d, reached)


def _all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionAll, frames)


def _new_sets(keyed: DataFrame, classes: DataFrame, members: DataFrame, sets: list[DataFrame], pack) -> DataFrame:
    """(cid, grams, signature) of the members whose sets are not held yet, each from the text of one document."""
    wanted = members.select("cid").distinct()
    if sets:
        wanted = wanted.join(_all(sets).select("cid"), "cid", "left_anti")
    new = classes.join(wanted, "cid").select("cid", "least.doc_id", "least.t1", "least.t2")
    new = staged(new, "involved")
    few = new.count() <= BROADCAST_ROWS
    same = [keyed[c].eqNullSafe(new[c]) for c in ("doc_id", "t1", "t2")]
    found = keyed.join(F.broadcast(new) if few else new, same).select("cid", keyed["text"])
    return staged(found.mapInArrow(pack, "cid long, grams binary, signature binary").dropDuplicates(["cid"]), "sets")


def _thin(
    open_: DataFrame, sets: DataFrame, similarity: float, crowd: int, pivots: int, known: DataFrame | None
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """What is left of crowded buckets when no group can be lost by leaving out the others, the pairs compared so far, and the groups
    that these make, as (cid, root).

    A bucket is done when it is no longer crowded, or when its last round left more than half of it.
    """
    left, roots, far = None, None, 1 - similarity
    open_ = open_.withColumn("was", F.lit(None).cast("long"))
    while True:
        sizes = open_.groupBy("bucket").agg(F.count("*").alias("n"), F.max("was").alias("was"))
        over = (F.col("n") <= crowd) | F.coalesce(2 * F.col("n") > F.col("was"), F.lit(False))
        sizes = staged(sizes.select("bucket", "n", over.alias("over")), "buckets")
        open_ = open_.drop("was")
        done = _of(open_, sizes.filter("over")).select("bucket", "tree", "size", "cid")
        left = done if left is None else left.unionAll(done)
        crowded = staged(_of(open_, sizes.filter("NOT over").select("bucket", F.col("n").alias("was"))), "crowded")
        if crowded.isEmpty():
            return left, known, roots
        rank = F.row_number().over(Window.partitionBy("bucket").orderBy("cid"))
        chosen = crowded.withColumn("rank", rank).filter(F.col("rank") <= pivots)
        chosen = staged(chosen.select("bucket", F.col("cid").alias("pivot"), "rank"), "pivots")
        star = _of(crowded, chosen).filter("cid != pivot")
        pairs = star.select(F.least("pivot", "cid").alias("a"), F.greatest("pivot", "cid").alias("b")).distinct()
        pairs = staged(pairs if known is None else pairs.join(known, ["a", "b"], "left_anti"), "pairs")
        many = pairs.groupBy("a").agg(F.count("*").alias("of"))
        compared = staged(verified(pairs.join(many, "a"), sets), "compared")
        known = compared if known is None else staged(known.unionAll(compared), "compared")
        # Members outside the first pivot's group, and members inside that may have a link to one of them.
        roots = components(known.filter(F.col("similarity") >= similarity - _EDGE)).withColumnRenamed("node", "cid")
        rooted = staged(crowded.join(roots, "cid", "left").withColumn("root", F.coalesce("root", "cid")), "rooted")
        main = rooted.join(chosen.filter("rank = 1").select("bucket", F.col("pivot").alias("cid")), ["bucket", "cid"])
        main = main.select("bucket", F.col("root").alias("main"))
        rooted = _of(rooted, staged(main, "main")).withColumn("out", F.col("root") != F.col("main"))
        rooted = rooted.join(chosen.select("bucket", F.col("pivot").alias("cid")), ["bucket", "cid"], "left_anti")
        away = known.select("a", "b", (1 - F.col("similarity")).alias("away"))
        away = away.select(F.col("a").alias("pivot"), F.col("b").alias("cid"), "away").unionAll(
            away.select(F.col("b").alias("pivot"), F.col("a").alias("cid"), "away")
        )
        kept = ["bucket", "tree", "size", "was", "cid"]
        placed = _of(rooted.select(*kept, "out"), chosen.select("bucket", "pivot"))
        placed = staged(placed.join(away, ["pivot", "cid"]), "placed")
        least = placed.filter("out").groupBy("bucket", "pivot").agg(F.min("away").alias("least"))
        slack = F.min(F.col("away") - F.col("least")).alias("slack")
        reach = placed.join(least, ["bucket", "pivot"]).groupBy(*kept, "out").agg(slack)
        open_ = staged(reach.filter(F.col("out") | (F.col("slack") >= -far - _EDGE)).select(*kept), "open")


def _grouped(documents: DataFrame, **options) -> tuple[DataFrame, tuple[int, float]]:
    """doc_id, t1, t2, class_size, class_id, group_id and root of each document, and n_links if links are counted; what was reached.

    Only documents that share a class or a group are joined with it; the others are their own.
    """
    rows, links, degree, reached = similar_classes(documents, **options)
    per_class = rows.groupBy("cid", "class_size").agg(F.min("doc_id").alias("class_id"))
    placed = join_counted(per_class, components(links).withColumnRenamed("node", "cid"), ["cid"])
    placed = staged(placed.filter("class_size > 1 OR root IS NOT NULL").withColumn("root", F.coalesce("root", "cid")), "placed")
    placed = join_counted(placed, placed.groupBy("root").agg(F.min("class_id").alias("group_id")), ["root"])
    if degree is not None:
        placed = join_counted(placed, degree.withColumnRenamed("node", "cid"), ["cid"])
    own = {"class_id": F.col("doc_id"), "group_id": F.col("doc_id"), "root": F.col("cid")}
    found = join_counted(rows, placed.drop("class_size").withColumn("shared", F.lit(True)), ["cid"])
    return found.withColumns({c: F.when(F.col("shared"), F.col(c)).otherwise(x) for c, x in own.items()}).drop("cid", "shared"), reached


def jaccard_groups(documents: DataFrame, **options) -> DataFrame:
    """One row per document: doc_id, t1, t2 (hash of the text), class_id, class_size, n_links, group_id, root, matched_depth,
    measured_recall.

    `class_id` and `group_id` are the smallest ids of the documents with equal shingle sets and of the linked group. `n_links`
    is the number of classes found similar to the document's, each counted once. The last two are the same in all rows: the
    length of prefix at which the walk ended, and the share of links found that was measured there.
    """
    grouped, (d, reached) = _grouped(documents, **options)
    n_links = F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links")
    told = [F.lit(d).alias("matched_depth"), F.lit(reached).alias("measured_recall")]
    return grouped.select("doc_id", "t1", "t2", "class_id", "class_size", n_links, "group_id", "root", *told)


def one_per_group(documents: DataFrame, **options) -> DataFrame:
    """The documents without all but one of each group: the one with the smallest id, then by hash of the text.

    All columns stay. Of rows equal in id and text one stays.
    """
    text, doc_id = options.get("text", "text"), options.get("doc_id", "doc_id")
    names = ["doc_id", "t1", "t2"]
    grouped, _ = _grouped(documents, counted=False, **options)
    keys = staged(grouped.groupBy("root", *names).agg(F.count("*").alias("n")), "keys")
    own = F.struct(F.col("doc_id").isNull().alias("none"), *names)
    kept = keys.groupBy("root").agg(F.min(own).alias("kept"), F.sum("n").alias("of")).filter("of > 1")
    kept = kept.select("root", F.col("kept.doc_id").alias("k0"), F.col("kept.t1").alias("k1"), F.col("kept.t2").alias("k2"))
    stays = F.col("doc_id").eqNullSafe(F.col("k0")) & (F.col("t1") == F.col("k1")) & (F.col("t2") == F.col("k2"))
    # Most documents are neither removed nor repeated; only the others are joined.
    others = join_counted(keys, kept, ["root"], "inner").withColumn("stays", stays).filter("NOT stays OR n > 1")
    others = staged(others.select(*[F.col(c).alias(f"_key_{c}") for c in names], "stays"), "others")
    few = others.count() <= BROADCAST_ROWS
    others = F.broadcast(others) if few else others
    t1, t2 = text_key(F.coalesce(documents[text], F.lit("")))
    same = documents[doc_id].eqNullSafe(others["_key_doc_id"]) & (t1 == others["_key_t1"]) & (t2 == others["_key_t2"])
    alone = documents.join(others, same, "left_anti")
    if others.filter("stays").isEmpty():
        return alone
    twice = documents.join(others.filter("stays"), same).dropDuplicates(["_key_doc_id", "_key_t1", "_key_t2"])
    return alone.unionByName(twice.select(*[documents[c] for c in documents.columns]))
