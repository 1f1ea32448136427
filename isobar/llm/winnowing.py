"""Document fingerprints by winnowing, in built-in functions only.

The tokens of a text are its words; a text of fewer than `short` code points, or of words of over 16 on average, has its code
points as tokens. Every `gram` tokens in a row are hashed. Of each `window` hashes in a row the smallest is picked, the
rightmost of equal ones; the picks with their places are the fingerprint. So any stretch of `window` + `gram` - 1 tokens that
two texts share (of the same kind of token) gives a common pick, and picks are dense by 2 / (`window` + 1). Texts of different
kinds are compared by their code points.

Defined results: null and empty texts have an empty fingerprint, and two of these are wholly alike; fewer tokens than a gram
are one gram, fewer grams than a window one window; an empty table gives an empty result; extra columns are ignored. For
`with_next`, null ids come last, rows with one id are in order of the hash of their text, and a single row is its own next.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

PLACE_BITS = 28
MOST_BUCKETS = 4096


def _by_points(text: str, words: str, short: int) -> str:
    """Whether a text has its code points as tokens."""
    return f"(char_length({text}) < {short} OR 16 * size({words}) < char_length({text}))"


def with_fingerprint(
    df: DataFrame, text: str, name: str, gram: int = 5, window: int = 16, short: int = 200, points: bool = False
) -> DataFrame:
    """Adds `name`_h and `name`_p, the hashes and places picked, and `name`_c, whether they are of code points; with `points`
    they always are. Steps that a lambda looks into are columns of their own, so that each is evaluated once."""
    if window & (window - 1):
        raise ValueError("window has to be a power of two")
    last = (1 << PLACE_BITS) - 1
    hashed = ", ".join(f"get(_h, i + {j})" for j in range(gram))
    steps = {
        "_w": rf"array_remove(split({text}, '[\\x20\\x09-\\x0D]+'), '')",
        f"{name}_c": "true" if points else _by_points(text, "_w", short),
        "_h": f"transform(CASE WHEN {name}_c "
        f"THEN array_remove(split({text}, ''), '') ELSE _w END, x -> xxhash64(x))",
        "_g": f"CASE WHEN size(_h) >= {gram} THEN transform(sequence(0, size(_h) - {gram}), i -> xxhash64({hashed})) "
        "WHEN size(_h) > 0 THEN array(xxhash64(_h)) ELSE CAST(array() AS array<bigint>) END",
        "_m": f"transform(_g, (x, i) -> shiftleft(x & {(1 << 35) - 1}L, {PLACE_BITS}) | CAST({last} - i AS BIGINT))",
    }
    df = df.withColumn("_w", F.expr(steps["_w"])).withColumn(f"{name}_c", F.expr(steps[f"{name}_c"]))
    df = df.withColumn("_h", F.expr(steps["_h"])).drop("_w")
    df = df.withColumn("_g", F.expr(steps["_g"])).drop("_h").withColumn("_m", F.expr(steps["_m"]))
    # Minima over windows of 2, 4, 8 ... hashes; a shorter text has one window.
    few = f"size(_g) < {window}"
    width = 1
    while width < window:
        pairs = f"zip_with(slice(_m, 1, size(_m) - {width}), slice(_m, {width + 1}, size(_m) - {width}), (x, y) -> least(x, y))"
        df = df.withColumn("_m", F.expr(f"CASE WHEN {few} THEN _m ELSE {pairs} END"))
        width *= 2
    df = df.withColumn("_m", F.expr(f"CASE WHEN size(_g) = 0 THEN _m WHEN {few} THEN array(array_min(_m)) ELSE _m END"))
    # A window's rightmost minimum never lies left of the one before, so equal picks are neighbours.
    picks = f"transform(filter(_m, (x, i) -> i = 0 OR x != get(_m, i - 1)), x -> CAST({last} - (x & {last}L) AS INT))"
    df = df.withColumn(f"{name}_p", F.expr(picks)).drop("_m")
    return df.withColumn(f"{name}_h", F.expr(f"transform({name}_p, p -> get(_g, p))")).drop("_g")


def likeness(a: str, b: str) -> Column:
    """Jaccard similarity of two lists of hashes, 1 if both are empty."""
    both = F.size(F.array_union(a, b))
    return F.when(both == 0, 1.0).otherwise(F.size(F.array_intersect(a, b)) / both)


def _alike(df: DataFrame, name: str, a: tuple[str, str], b: tuple[str, str], **options) -> DataFrame:
    """Adds the likeness of two texts, given as text and fingerprint. If one is winnowed by words and the other by code points,
    the former's code points are winnowed too and compared."""
    (a_text, a_name), (b_text, b_name) = a, b
    words = F.when(F.col(f"{a_name}_c") == F.col(f"{b_name}_c"), None).when(F.col(f"{a_name}_c"), F.col(b_text)).otherwise(F.col(a_text))
    # Few texts have another kind than their partner; the others are empty here.
    df = with_fingerprint(df.withColumn("_v", F.coalesce(words, F.lit(""))), "_v", "_x", points=True, **options)
    same = F.col(f"{a_name}_c") == F.col(f"{b_name}_c")
    value = F.when(same, likeness(f"{a_name}_h", f"{b_name}_h")).when(F.col(f"{a_name}_c"), likeness(f"{a_name}_h", "_x_h"))
    return df.withColumn(name, value.otherwise(likeness("_x_h", f"{b_name}_h"))).drop("_v", "_x_h", "_x_p", "_x_c")


def as_string(name: str) -> Column:
    """place:hash, comma-joined, in order of place."""
    return F.expr(f"array_join(zip_with({name}_p, {name}_h, (p, h) -> concat(p, ':', lower(hex(h)))), ',')")


def with_next(
    df: DataFrame, key: str, text: str, derive: Callable[[DataFrame], DataFrame], carried: list[str], bucket_bytes: int = 2 << 20
) -> DataFrame:
    """Adds the columns of `derive`, and `next_...` of the `carried` columns: those of the row with the next smaller key,
    cyclically.

    Rows are dealt to buckets of consecutive keys by approximate quantiles; a key that fills several buckets is dealt on by
    the hash of its text. Each bucket gets the first row of the following one at its end, and a window of its own.
    """
    order = ["_o", "_t1", "_t2"]
    rows = df.withColumns(
        {
            # Descending ids are ascending complements; no id is last.
            "_o": F.bitwise_not(F.coalesce(F.col(key).cast("long"), F.lit(-(1 << 63)))),
            "_t1": F.xxhash64(text),
            "_t2": F.xxhash64(F.lit(7), F.col(text)),
        }
    )
    size = df.agg(F.sum(F.octet_length(text))).first()[0] or 0
    n = int(min(MOST_BUCKETS, 1 + size // bucket_bytes))
    cuts = []
    if n > 1:
        at = [k / n for k in range(1, n)]
        cuts = rows.agg(F.percentile_approx("_o", at, 20 * n)).first()[0] or []
    limits = F.lit(cuts).cast("array<bigint>") if cuts else F.array().cast("array<bigint>")
    below = F.size(F.filter(limits, lambda c: c < F.col("_o")))
    equal = F.size(F.filter(limits, lambda c: c == F.col("_o")))
    within = F.floor((F.col("_t1") / F.lit(2.0**64) + 0.5) * (equal + 1))
    rows = rows.withColumn("_b", (below + F.least(within, equal)).cast("int"))
    slim = rows.groupBy("_b").agg(F.min(F.struct(*order)).alias("_first"))
    # One row per bucket from here on.
    cycle = Window.orderBy("_b")
    whole = cycle.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = F.coalesce(F.lag("_b").over(cycle), F.last("_b").over(whole))
    heads = slim.select(F.col("_b").alias("_own"), before.alias("_to"), *[F.col(f"_first.{c}").alias(f"_f{c}") for c in order])
    match = [rows[c] == heads[f"_f{c}"] for c in order]
    heads = rows.join(F.broadcast(heads), [rows["_b"] == heads["_own"], *match]).dropDuplicates(["_own"])
    ends = heads.withColumn("_b", F.col("_to")).withColumn("_end", F.lit(1)).select(*rows.columns, "_end")
    dealt = rows.withColumn("_end", F.lit(0)).unionByName(ends)
    along = Window.partitionBy("_b").orderBy("_end", *order)
    following = {f"next_{c}": F.lead(c).over(along) for c in carried}
    # The shuffle moves texts alone; what is derived from them is made behind it.
    return derive(dealt.repartition("_b")).withColumns(following).filter("_end = 0").drop("_o", "_t1", "_t2", "_b", "_end")


def compare_with_edited(documents: DataFrame, text: str = "text", doc_id: str = "doc_id", **options) -> DataFrame:
    """Fingerprints of each text and of the text with its last half replaced from the next document, and their likeness."""
    rows = documents.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    paired = with_next(rows, "doc_id", "text", lambda df: with_fingerprint(df, "text", "own", **options), ["text", "own_h", "own_c"])
    half = F.floor(F.char_length("text") / 2).cast("int")
    paired = _alike(paired, "near_next", ("text", "own"), ("next_text", "next_own"), **options)
    edited = paired.select(
        "doc_id",
        "text",
        F.char_length("text").cast("long").alias("n_chars"),
        "own_h",
        "own_p",
        "own_c",
        "next_own_h",
        "near_next",
        F.concat(F.substring("text", F.lit(1), F.char_length("text") - half), F.substring("next_text", F.lit(1), half)).alias("edited"),
    )
    fingerprinted = with_fingerprint(edited, "edited", "new", **options)
    return _alike(fingerprinted, "near_edited", ("text", "own"), ("edited", "new"), **options).drop("text")
