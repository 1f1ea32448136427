import hashlib
import zlib
from collections import Counter, defaultdict

import pytest

from isobar.llm.prefix_trie import SLICE_CELLS, _packed, _unpacked, conversation_trie

SCHEMA = "conv_id long, turn long, role string, text string, c long, p1 string, at int, depth int, n int, last string"
HEADS = "crc32(CAST(CAST(c AS STRING) AS BINARY)) % 9"


def rebuilt(rows, heads=True):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [(r, x) for *_, r, x in sorted(turns)] for c, turns in own.items()}
    if not heads:
        return own
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (c % 5 if c >= 0 else -(-c % 5))
        out[c] = own.get(base, [])[:h] + turns[h:]
    return out


def plain(convs):
    """Nodes by walking a trie of dictionaries."""
    members = defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = Counter(p[:-1] for p in members if p)
    leaves, saved = Counter(), Counter()
    for p, who in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += p not in children
            saved[p[:d]] += (len(who) - 1) * len(p[-1][1].encode()) if p else 0
    out = Counter()
    for p, who in members.items():
        ends = ",".join(str(c) for c in sorted(who) if len(convs[c]) == len(p))
        up = min(members[p[:-1]]) if p else None
        out[min(who), len(p), up, len(who), children[p], leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest()] += 1
    return out


def conversations():
    rows = [(c, t, "user" if t % 2 == 0 else "assistant", f"{t} " + "abc"[(c * 7 + t) % 3] * (t + 1)) for c in range(60) for t in range(c % 8 + 1)]
    # Copies, a long one and its copy up to a place, one that is a prefix of another.
    rows += [(100 + c, t, "user", f"same {t} é") for c in range(30) for t in range(3 + (c % 4 == 0))]
    rows += [(c, t, "user", f"long {t if t < 170 or c == 205 else -t}") for c in (205, 206) for t in range(200)]
    # Nulls, ties, repeated rows, negative and missing ids, conversations that lose all turns.
    rows += [(300, None, "user", "null turn"), (300, 0, None, None), (300, 0, "user", None), (300, 0, "user", None), (300, 5, None, "x")]
    rows += [(-3, 0, "a", "b"), (-5, 0, "a", "b"), (None, 0, "a", "b"), (None, None, None, None)]
    rows += [(c, 0, "user", "only") for c in range(401, 440) if c % 5]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", 2, 3, 4, "y") for r in rows], SCHEMA)


@pytest.mark.parametrize("heads", [True, False])
@pytest.mark.parametrize("settings", [{}, {"target_rows": 50}, {"most_cells": 1}])
def test_nodes_equal_a_plain_trie(spark, rows, heads, settings):
    data = conversations()
    got = conversation_trie(frame(spark, data), heads=HEADS if heads else None, **settings)
    assert Counter(rows(got)) == plain(rebuilt(data, heads))


def test_equal_turns_and_roles_are_ordered_by_text(spark, rows):
    texts = ["b", "a", "é", "Z", None, "ab", ""]
    data = [(c, (c + k) % 2 or None, "user", texts[(c * k + k) % 7]) for c in range(40) for k in range(6)]
    got = conversation_trie(frame(spark, data), heads=HEADS)
    assert Counter(rows(got)) == plain(rebuilt(data))


def test_a_full_sketch_gives_the_same_sums(spark, rows):
    """Nodes of one member that the sketch does not prove, below nodes where that member is credited."""
    data = [(c, t, "user", f"{c // 2} {t}" if t < 3 else f"{c} {t}") for c in range(3000) for t in range(7)]
    got = conversation_trie(frame(spark, data), most_cells=1)
    assert Counter(rows(got)) == plain(rebuilt(data, False))


def test_one_large_group(spark, rows):
    data = [(c, t, "user", f"turn {t}") for c in range(3000) for t in range(4)]
    got = Counter(rows(conversation_trie(frame(spark, data))))
    assert got == plain(rebuilt(data, False)) and len(got) == 5


def test_conversations_without_turns_left(spark, rows):
    data = [(c, 0, "user", "only") for c in range(401, 440) if c % 5 and zlib.crc32(str(c).encode()) % 9]
    got = Counter(rows(conversation_trie(frame(spark, data), heads=HEADS)))
    assert got == plain(rebuilt(data)) and len(got) == 1


def test_empty_tables(spark, rows):
    assert rows(conversation_trie(frame(spark, []))) == []
    assert rows(conversation_trie(frame(spark, [(None, 1, "a", "b")]), heads=HEADS)) == []


def test_slices_of_cells():
    import numpy as np

    random = np.random.default_rng(3)
    for n in (0, 1, 7, 5000, 60_000):
        counts = np.zeros(SLICE_CELLS, np.uint8)
        counts[random.integers(0, SLICE_CELLS, n)] = random.integers(1, 3, n)
        assert (_unpacked(_packed(counts), SLICE_CELLS) == counts).all()
