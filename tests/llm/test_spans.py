from collections import Counter, defaultdict

import brute

from isobar.llm.sentence_spans import drop_repeated_spans


def split(text):
    tokens = [(m.start(), m.end()) for m in brute.WORD.finditer(text)]
    out, now = [], []
    for i, (a, b) in enumerate(tokens):
        now.append((a, b))
        if text[b - 1] in ".!?" or i + 1 == len(tokens) or "\n" in text[b : tokens[i + 1][0]]:
            out.append(now)
            now = []
    return out


def expected(rows, sentences=3, enough=20, least=12):
    seen = defaultdict(set)
    cut = {(i, t): split(t) for i, t in rows}
    for (i, t), s in cut.items():
        for a in range(len(s)):
            b = n = 0
            b = a
            while b < len(s) and ((b - a < sentences and n < enough) or n < least):
                n += len(s[b])
                b += 1
            if (b - a >= sentences or n >= enough) and n >= least:
                seen[tuple(brute.lower(t[x:y]) for q in s[a:b] for x, y in q)].add((i is None, i or 0, t, a, b))
    gone = defaultdict(set)
    for places in seen.values():
        first = min(places, key=lambda p: (p[0], p[1], p[3]))
        for p in places - {first}:
            gone[None if p[0] else p[1], p[2]] |= set(range(p[3], p[4]))
    out = Counter()
    for i, t in rows:
        s = cut[i, t]
        edge = [q[0][0] for q in s] + [len(t)]
        kept = t[: edge[0]] + "".join(t[edge[k] : edge[k + 1]] for k in range(len(s)) if k not in gone[i, t])
        out[i, kept, len(s), len(gone[i, t])] += 1
    return out


PASSAGE = "Alpha beta gamma delta. Epsilon zeta eta theta iota! Kappa lambda mu nu xi omicron? Pi rho sigma."


def test_equals_brute_force(spark):
    texts = [(r[0], r[1]) for r in brute.sample(spark, 120)]
    texts += [(2000 + k, f"Unique start {k} é. {PASSAGE} Unique end {k}.") for k in range(3)]
    texts += [(3000, f"{PASSAGE}\n{PASSAGE}")]
    df = brute.awkward(spark, texts)
    rows = [(r.doc_id, r.text or "") for r in df.select("doc_id", "text").collect()]
    got = drop_repeated_spans(df).collect()
    assert Counter((r.doc_id, r.text, r.n_sentences, r.n_removed) for r in got) == expected(rows)
    assert sum(r.n_removed for r in got) > 10


def test_removed_places_are_code_points(spark):
    df = spark.createDataFrame([(1, PASSAGE), (2, f"Éé ü. {PASSAGE} End.")], "doc_id long, text string")
    row = drop_repeated_spans(df).filter("doc_id = 2").first()
    text = f"Éé ü. {PASSAGE} End."
    pairs = list(zip(row.removed[::2], row.removed[1::2], strict=True))
    assert row.text == "Éé ü. End." and "".join(text[a:b] for a, b in pairs) == PASSAGE + " "


def test_runs_of_three_sentences_go_whole(spark):
    # Sentences of 15, 15 and 4 words; what follows the copy differs.
    passage = " ".join(f"a{k}" for k in range(15)) + ". " + " ".join(f"b{k}" for k in range(15)) + ". Short tail of it."
    rows = [(1, f"{passage} First goes on here."), (2, f"New start. {passage} Second ends there.")]
    rows += [(3, "Two short. Sentences here."), (4, "Two short. Sentences here."), (5, "Few words"), (6, "few words")]
    got = {r.doc_id: r for r in drop_repeated_spans(spark.createDataFrame(rows, "doc_id long, text string"), whole=True).collect()}
    assert got[2].text == "New start. Second ends there." and got[2].n_removed == 3
    assert [got[k].n_removed for k in (1, 3, 4, 5, 6)] == [0, 0, 2, 0, 1]
    assert got[4].text == got[6].text == ""


def test_empty_table(spark):
    assert drop_repeated_spans(spark.createDataFrame([], "doc_id long, text string")).count() == 0
