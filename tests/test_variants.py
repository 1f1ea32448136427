import json

import pytest
from pyspark.sql import functions as F

from isobar.operators.reshape import flatten_by_path
from isobar.sources import variants as vs


def parsed(spark, *texts):
    return vs.parse_variants(spark.createDataFrame(list(enumerate(texts)), "id LONG, text STRING"), "text")


def plain(value, path="$", leaf=None):
    """Leaves by recursion over Python values."""
    if isinstance(value, dict) and value:
        return [x for k, v in value.items() for x in plain(v, f"{path}.{k}" if k.isidentifier() and k.isascii() else f"{path}['{k}']", k)]
    if isinstance(value, list) and value:
        return [x for i, v in enumerate(value) for x in plain(v, f"{path}[{i}]", leaf)]
    kind = {dict: "object", list: "list", str: "string", bool: "boolean", type(None): "null"}.get(type(value), "number")
    text = None if value is None else value if isinstance(value, str) else json.dumps(value)
    return [(path, leaf, kind, text)]


DOCS = [
    {"a": {"b": [1, {"c": None, "d": [[2, 3], []]}], "odd key": "x"}, "e": {}, "f": 2.5, "g": True, "ü": "é", "dot.ted": 1},
    [1, [2, {"z": "w"}]],
    "only text",
    7,
    None,
    {"a": {"b": {"c": {"d": {"e": {"f": {"g": {"h": 1}}}}}}}},
]


def test_leaves_equal_recursion(spark):
    got = vs.leaves(parsed(spark, *map(json.dumps, DOCS), "{broken", None, ""), ["id"]).collect()
    want = [(i, *x) for i, d in enumerate(DOCS) for x in plain(d)]
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


def test_a_path_reads_its_value_again(spark):
    docs = parsed(spark, *map(json.dumps, DOCS))
    for r in vs.leaves(docs, ["id"]).filter("kind = 'string' OR kind = 'number'").collect():
        (again,) = docs.filter(F.col("id") == r["id"]).select(F.try_variant_get("doc", r["path"], "string")).first()
        assert again == r["value"]


def test_a_long_list_makes_rows(spark):
    df = parsed(spark, json.dumps({"list": [{"v": i, "w": [i]} for i in range(10_000)]}), json.dumps({"list": [{"v": -1}]}))
    found = vs.leaves(df, ["id"])
    assert len(found.columns) == 5 and found.count() == 20_001
    assert found.agg(F.sum(F.col("value").cast("long")).alias("s")).first()["s"] == 2 * sum(range(10_000)) - 1
    facts = {r["path"]: r for r in vs.path_facts(found, ["id"]).collect()}
    assert set(facts) == {"$.list[*].v", "$.list[*].w[*]"}
    assert (facts["$.list[*].v"]["n_leaves"], facts["$.list[*].v"]["n_documents"]) == (10_001, 2)
    with pytest.raises(ValueError):
        vs.wide(found, ["id"])


def test_wide_form(spark):
    df = parsed(spark, '{"b": [{"c": 1}, {"c": "x", "d d": null}], "a": 2}', '{"a": 3}')
    out = vs.wide(vs.leaves(df, ["id"]), ["id"]).orderBy("id")
    assert out.columns == ["id", "a", "b_0_c", "b_1_c", "b_1_d d"]
    assert [tuple(r) for r in out.collect()] == [(0, "2", "1", "x", None), (1, "3", None, None, None)]


def test_declared_lists_fail_above_the_width(spark):
    df = spark.createDataFrame([([(1, 2)] * 60,)], "l ARRAY<STRUCT<a: INT, b: INT>>")
    assert len(flatten_by_path(df).columns) == 120
    with pytest.raises(ValueError):
        flatten_by_path(df, most_columns=100)


def test_lines_and_quarantine(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"x": 1}\n\n{"x": "two"}\nnot json\n[3]\n')
    good, bad = vs.split_bad(vs.read_variants(spark, str(tmp_path)))
    columns = vs.typed_columns(good, {"x": ("$.x", "bigint"), "first": ("$[0]", "string")})
    assert sorted(map(tuple, good.select(*columns).collect()), key=repr) == [(1, None), (None, "3"), (None, None)]
    assert [r["value"] for r in bad.collect()] == ["not json"]


def test_no_documents(spark):
    assert vs.leaves(parsed(spark, "{}").limit(0), ["id"]).count() == 0
    assert vs.leaves(parsed(spark, None, "{"), ["id"]).count() == 0
