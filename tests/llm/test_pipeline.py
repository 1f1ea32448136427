import brute

import corpus_pipeline
from isobar.llm.staging import staged

DATA = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    columns, kept = docs.columns, []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = staged(stage(spark, docs, DATA))
        assert docs.columns == columns
        kept.append({r.doc_id for r in docs.select("doc_id").collect()})
    assert all(b <= a for a, b in zip(kept, kept[1:], strict=False)) and len(kept[0]) > 150 and kept[2] == kept[3]
    texts = [r.text for r in docs.collect()]
    items = [t for _, t in brute.sample(spark, 40, "benchmark")]
    assert not any(i in t for i in items for t in texts) and not any("@example" in t for t in texts)
    mixed = corpus_pipeline.STAGES[-1][1](spark, docs, DATA)
    assert {r.doc_id for r in mixed.collect()} == kept[3]


def test_awkward_documents(spark):
    docs = brute.awkward(spark, [(1, "mail me at a.b@c.org, idiot"), (2, "plain")]).selectExpr(
        "doc_id", "text", "'xx' AS lang", "source", "CAST(length(text) AS BIGINT) AS n_chars", "score", "hits"
    )
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = staged(stage(spark, docs, DATA))
        assert out.columns == docs.columns
        docs = out
    masked = {r.doc_id: r for r in docs.collect()}
    if 1 in masked:
        assert masked[1].text == "mail me at [EMAIL], idiot" and masked[1].n_chars == len(masked[1].text)
    assert corpus_pipeline.STAGES[-1][1](spark, docs, DATA).count() == docs.count()


def test_empty_documents(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = staged(stage(spark, docs, DATA))
        assert docs.count() == 0
