import re

import brute
from hypothesis import given, settings
from hypothesis import strategies as st

from isobar.llm.pii import KINDS, base_spans, fit_field, masked_column, spans_column

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits):
    total = 0
    for k, c in enumerate(reversed(digits)):
        x = int(c) * (1 + k % 2)
        total += x if x < 10 else x - 9
    return total % 10 == 0


def plain(text):
    out = [(m.start(), 0, m.end()) for m in EMAIL.finditer(text)]
    out += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(int(x) <= 255 for x in m[0].split("."))]
    for m in CARD.finditer(text):
        digits = re.sub("[^0-9]", "", m[0])
        if 12 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), 2, m.end()))
    out += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return sorted(out)


@settings(max_examples=3000, deadline=None)
@given(st.text(alphabet="a@.-120 5+()é_%", max_size=40))
def test_patterns_equal_their_regexes(text):
    assert base_spans(text) == plain(text)


@settings(max_examples=1000, deadline=None)
@given(st.text(alphabet="0123456789 -.", max_size=60))
def test_digits_equal_their_regexes(text):
    assert base_spans(text) == plain(text)


def test_long_runs_are_linear():
    assert base_spans("a" * 300_000) == [] and base_spans("1" * 300_000) == []
    assert len(base_spans("a@b.c " * 20_000)) == 20_000


def test_whole_table_and_awkward_rows(spark):
    texts = [(r[0], r[1]) for r in brute.sample(spark, 200)]
    texts.append((5000, "call +1 (706) 555-3138 now\nor (706) 555-3138 later; joe.x7@ab.com, that is joe.x7"))
    df = brute.awkward(spark, texts)
    field = fit_field(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))
    got = df.select("doc_id", "text", spans_column(field, df.text).alias("s"), masked_column(field, df.text).alias("m")).collect()
    assert len(got) == df.count()
    for row in got:
        base = [(s.start, KINDS.index(s.kind), s.end) for s in row.s if s.base]
        assert base == plain(row.text or "")
        assert [(s.start, KINDS.index(s.kind)) for s in row.s] == sorted((s.start, KINDS.index(s.kind)) for s in row.s)
        assert (row.m is None) == (row.text is None)
    told = next(r for r in got if r.doc_id == 5000)
    added = {(s.kind, told.text[s.start : s.end]) for s in told.s if not s.base}
    assert added == {("phone", "(706) 555-3138"), ("email", "joe.x7")}
    assert "555" not in told.m and "joe" not in told.m


def test_numbers_that_fail_their_test_stay(spark):
    field = fit_field(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))
    assert field.spans(["no 2362971821055609 and 2362971821055609, version 2.0. of 1999", ""]) == [[], []]


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    field = fit_field(empty)
    assert field.spans(["mail a@b.c"])[0] == [(5, 0, 10, True)]
    assert empty.select(spans_column(field, empty.text)).count() == 0
