import hashlib
from collections import Counter

import brute
import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from isobar.llm.token_alignment import align, align_tokenizers, byte_letters, shared_ends

PATHS = (public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
LETTERS = byte_letters()


@pytest.fixture(scope="module")
def named():
    a = Tokenizer.from_file(PATHS[0])
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=PATHS[1])


def tokens(named, text):
    """(id, bytes) of both tokenizers by their own libraries; none where they do not spell the text."""
    a, b = named
    if not text:
        return [], []
    first = [(k, bytes(LETTERS[c] for c in a.id_to_token(k))) for k in a.encode(" " + text, add_special_tokens=False).ids]
    second = []
    for k in b.encode(text):
        piece = b.id_to_piece(k)
        second.append((k, bytes([int(piece[3:5], 16)]) if b.is_byte(k) else piece.replace("▁", " ").encode()))
    whole = (" " + text).encode()
    return (first, second) if all(b"".join(w for _, w in side) == whole for side in (first, second)) else ([], [])


def places(side):
    at, out = 0, []
    for k, word in side:
        out.append((k, at, at + len(word)))
        at += len(word)
    return out


def plain(named, texts):
    """Per text: n_a, n_b, n_groups, n_links, links as a counter of pairs, the text of groups."""
    out = []
    for text in texts:
        a, b = (places(side) for side in tokens(named, text or ""))
        shared = sorted({e for _, _, e in a} & {e for _, _, e in b})
        groups, begin = [], 0
        for end in shared:
            groups.append("|".join(",".join(str(k) for k, s, e in side if begin <= s and e <= end) for side in (a, b)))
            begin = end
        links = Counter((x, y) for x, s, e in a for y, t, f in b if s < f and t < e)
        out.append((len(a), len(b), len(shared), sum(links.values()), links, ";".join(groups)))
    return out


TEXTS = ["", " ", "one", "two  spaces", "tab\there", "<|endoftext|> and <s> stay", "naïve café 漢字 🙂 x", "xxxxxxxxxxxxx" * 9, "a" * 300, "▁ odd", "don't 12345 we'll"]


def test_alignment_equals_plain_search(named):
    texts = TEXTS + [t[:700] for _, t, *_ in brute.sample(named and SPARK[0], 60)]
    got = align(texts, PATHS)
    for k, (n_a, n_b, n_groups, n_links, links, groups) in enumerate(plain(named, texts)):
        assert (got["n_a"][k], got["n_b"][k], got["n_groups"][k], got["n_links"][k]) == (n_a, n_b, n_groups, n_links)
        assert got["groups_sha256"][k] == (hashlib.sha256(groups.encode()).hexdigest() if n_a else "")
        assert {(p >> 32, p & 0xFFFFFFFF): t for p, t in zip(got["pairs"][k].tolist(), got["times"][k].tolist(), strict=True)} == dict(links)


SPARK = []


@pytest.fixture(autouse=True, scope="module")
def _session(spark):
    SPARK.append(spark)


@settings(max_examples=500, deadline=None)
@given(st.text(max_size=60))
def test_any_text(named, text):
    got, want = align([text], PATHS), plain(named, [text])[0]
    assert (got["n_a"][0], got["n_b"][0], got["n_groups"][0], got["n_links"][0]) == want[:4]


@settings(max_examples=500, deadline=None)
@given(st.sets(st.integers(0, 400)), st.sets(st.integers(0, 400)), st.sets(st.integers(0, 400)))
def test_shared_ends(a, b, bounds):
    a, b = sorted(a | {401} | bounds), sorted(b | {401} | bounds)
    found = shared_ends(np.array(a), np.array(b), np.searchsorted(a, sorted(bounds | {401})))
    assert [a[k] for k in found] == sorted(set(a) & set(b))


def test_long_stretch_without_a_shared_end():
    a, b = np.append(np.arange(2, 400_000, 2), 400_001), np.append(np.arange(3, 400_000, 2), 400_001)
    assert shared_ends(a, b, np.array([len(a) - 1])).tolist() == [len(a) - 1]
    b[70_000] += 1
    assert len(shared_ends(a, b, np.array([len(a) - 1]))) == 2


@pytest.mark.parametrize("most", [2_000_000, 10])
def test_corpus_counts(spark, rows, named, most):
    df = brute.awkward(spark, [(i, t[:900]) for i, t, *_ in brute.sample(spark, 80)] + list(enumerate(TEXTS, 5000)))
    raw = rows(df, "doc_id", "text")
    found = plain(named, [t for _, t in raw])
    count = Counter(p for *_, links, _ in found for p in links)
    most_of = {}
    for (a, _), n in count.items():
        most_of[a] = max(n, most_of.get(a, 0))
    want = Counter()
    for (doc, _), (n_a, n_b, n_groups, n_links, links, groups) in zip(raw, found, strict=True):
        best = sum(t for p, t in links.items() if count[p] == most_of[p[0]])
        total = sum(t * count[p] for p, t in links.items())
        want[doc, n_a, n_b, n_groups, n_links, best, total, hashlib.sha256(groups.encode()).hexdigest() if n_a else ""] += 1
    assert Counter(rows(align_tokenizers(df, *PATHS, most_pairs=most))) == want


def test_empty_table(spark, rows):
    assert rows(align_tokenizers(spark.createDataFrame([], "doc_id long, text string"), *PATHS)) == []
