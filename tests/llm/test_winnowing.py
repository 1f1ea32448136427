import hashlib

import brute
import pytest

from isobar.llm.queries import QUERIES
from isobar.llm.winnowing import compare_with_edited, likeness, with_fingerprint


def picks(hashes, window):
    """Places of the rightmost smallest hash of every window."""
    out = []
    for a in range(max(1, len(hashes) - window + 1) if hashes else 0):
        part = hashes[a : a + window]
        out.append(a + max(i for i, h in enumerate(part) if h == min(part)))
    return sorted(set(out))


def test_picks_equal_brute_force(spark):
    texts = [(r[0], r[1]) for r in brute.sample(spark, 80)] + [(900, "a b " * 100), (901, "漢" * 500)]
    df = brute.awkward(spark, texts).selectExpr("doc_id", "coalesce(text, '') AS text")
    rows = with_fingerprint(df, "text", "own").selectExpr(
        "text",
        "own_p",
        "own_h",
        r"transform(array_remove(split(text, '[\\x20\\x09-\\x0D]+'), ''), x -> xxhash64(x)) AS words",
        "transform(array_remove(split(text, ''), ''), x -> xxhash64(x)) AS points",
    )
    grams = "CASE WHEN size(h) >= 5 THEN transform(sequence(0, size(h) - 5), i -> xxhash64(h[i], h[i+1], h[i+2], h[i+3], h[i+4]))"
    grams += " WHEN size(h) > 0 THEN array(xxhash64(h)) ELSE CAST(array() AS array<bigint>) END AS g"
    short = "char_length(text) < 200 OR 16 * size(words) < char_length(text)"
    rows = rows.selectExpr("own_p", "own_h", f"IF({short}, points, words) AS h").selectExpr("own_p", "own_h", grams)
    for row in rows.collect():
        assert row.own_p == picks([g & (1 << 35) - 1 for g in row.g], 16)
        assert row.own_h == [row.g[p] for p in row.own_p]


def test_shared_stretches_share_a_pick(spark):
    stretch = " ".join(f"shared{i}" for i in range(20))
    a = " ".join(f"a{i}" for i in range(60)) + " " + stretch + " " + " ".join(f"b{i}" for i in range(60))
    b = " ".join(f"c{i}" for i in range(90)) + " " + stretch
    df = spark.createDataFrame([(a, b)], "a string, b string")
    row = with_fingerprint(with_fingerprint(df, "a", "x"), "b", "y").first()
    assert set(row.x_h) & set(row.y_h)


def test_edited_texts_and_likeness(spark):
    texts = [(r[0], r[1]) for r in brute.sample(spark, 60)]
    df = spark.createDataFrame([*texts, (-5, None), (9000, "é" * 7)], "doc_id long, text string")
    order = sorted([(i, t or "") for i, t in [*texts, (-5, None), (9000, "é" * 7)]], reverse=True)
    want = {}
    for (i, t), (_, after) in zip(order, order[1:] + order[:1], strict=True):
        half = len(t) // 2
        want[i] = t[: len(t) - half] + after[:half]
    for row in compare_with_edited(df).select("doc_id", "n_chars", "edited").collect():
        assert row.edited == want[row.doc_id]


def test_texts_across_the_border_are_compared(spark):
    long = " ".join(f"word{k:03d}" for k in range(26))[:201]
    other = " ".join(str(k * 7919 % 10007) for k in range(1, 90))[:300]
    rows = [(2, long), (1, long[:199]), (4, other), (3, "y" * 12)]
    got = {r.doc_id: r for r in compare_with_edited(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[2].own_c != got[1].own_c and got[2].near_next > 0.9
    # 300 code points become 150 and 12 by the edit, so half of the picks stay.
    assert got[4].own_c != got[4].new_c and got[4].near_edited > 0.3


def test_order_with_nulls_and_repeats(spark):
    rows = [(None, None), (None, "ab"), (5, "x"), (5, "xy z"), (5, "xy z"), (9, "abc def")]
    got = compare_with_edited(spark.createDataFrame(rows, "doc_id long, text string")).select("doc_id", "edited").collect()
    assert len(got) == 6
    # The row after the first id is one of the texts of id 5; the last one is followed by the first.
    assert {r.edited for r in got if r.doc_id == 9} <= {"abc x", "abc xy ", "abc xy z"}
    one = compare_with_edited(spark.createDataFrame([(1, "abcd")], "doc_id long, text string")).first()
    assert one.edited == "abab" and one.own_h == one.next_own_h


def test_many_buckets_keep_the_order(spark):
    from isobar.llm.winnowing import with_next

    rows = [(i // 3 if i < 60 else 77, f"text {i:04d}") for i in range(400)] + [(None, f"n{i}") for i in range(50)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    got = with_next(df, "doc_id", "text", lambda d: d, ["text", "doc_id"], bucket_bytes=200).collect()
    follows = {r.text: r.next_text for r in got}
    at, seen = got[0].text, []
    for _ in range(len(rows)):
        seen.append(at)
        at = follows[at]
    ids = {t: i for i, t in rows}
    start = min(range(len(seen)), key=lambda k: -(ids[seen[k]] if ids[seen[k]] is not None else -1) * 1000 + k)
    turned = [ids[t] for t in seen]
    assert len(set(seen)) == len(rows)
    drops = sum((b if b is not None else -1) > (a if a is not None else -1) for a, b in zip(turned, turned[1:] + turned[:1], strict=True))
    assert drops == 1 and start >= 0


def test_query(spark):
    rows = QUERIES["op4_winnowing"](spark, "/root/testdata/sf0.001").collect()
    assert len(rows) == 200 and all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in rows)
    texts = {i: t for i, t, *_ in brute.sample(spark, 200)}
    assert sum(r.near_edited for r in rows) > 10 * sum(r.near_next for r in rows)
    last = max(texts)
    edited = texts[last][: len(texts[last]) - len(texts[last]) // 2] + texts[last - 1][: len(texts[last]) // 2]
    assert next(r for r in rows if r.doc_id == last).edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()


def test_empty(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert compare_with_edited(empty).count() == 0
    both = spark.createDataFrame([([], []), ([1], [])], "a array<bigint>, b array<bigint>")
    assert [r[0] for r in both.select(likeness("a", "b")).collect()] == [1.0, 0.0]
    with pytest.raises(ValueError):
        with_fingerprint(empty, "text", "x", window=12)
