"""Queries over the given tables, each beside its SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from isobar.llm.features import split_by_crc
from isobar.llm.kneser_ney import score_column as lm_column
from isobar.llm.kneser_ney import train as train_lm
from isobar.llm.link_graph import judge_pages
from isobar.llm.lsh_forest import jaccard_groups
from isobar.llm.mixing import mix
from isobar.llm.ordinal import fit_ordinal, rating_column
from isobar.llm.pii import KINDS, fit_field, spans_column
from isobar.llm.prefix_trie import conversation_trie
from isobar.llm.sentence_spans import drop_repeated_spans
from isobar.llm.spaced_seeds import with_hits
from isobar.llm.token_alignment import align_tokenizers
from isobar.llm.toxicity import contract_split, fit_toxicity, score_column
from isobar.llm.warc import pages_from_records, read_warc, write_warc
from isobar.llm.winnowing import as_string, compare_with_edited
from isobar.queries.registry import table
from isobar.session import shared_folder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return register


@query(
    "op5_warc",
    """
    WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
    d AS (SELECT page_id, strlen(body)::BIGINT AS payload_bytes, sha256(body) AS payload_digest FROM p),
    f AS (SELECT payload_digest, min(page_id) AS first FROM d WHERE payload_bytes >= 100 GROUP BY payload_digest)
    SELECT page_id, payload_bytes, payload_digest,
      CASE WHEN first IS NOT NULL AND page_id IS DISTINCT FROM first THEN 'revisit' ELSE 'response' END AS record_type,
      CASE WHEN page_id IS DISTINCT FROM first THEN first END AS refers_to
    FROM d LEFT JOIN f USING (payload_digest)
    """,
)
def warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_folder(spark, "warc")
    write_warc(table(spark, sf_dir, "pages"), folder)
    return pages_from_records(read_warc(spark, folder)).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


@query("op3_mixing")
def mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).drop("source", "spot")


@query("op9_spaced_seeds")
def spaced_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = with_hits(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    items = F.array_sort(F.array_distinct("hits.item"))
    spans = F.transform("hits", lambda h: F.concat_ws(":", h["item"], h["start"], h["end"]))
    return found.select(
        "doc_id",
        (F.size("hits") > 0).alias("contaminated"),
        F.size(items).cast("long").alias("n_items"),
        items.alias("items"),
        F.array_join(spans, ",").alias("spans"),
    )


@query("op7_toxicity")
def toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit_toxicity(documents, table(spark, sf_dir, "labels"), train=~contract_split())
    scored = documents.select("doc_id", contract_split().alias("held_out"), score_column(model, F.col("text")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.7).cast("int"))


#: Grade 0 is low quality, 1 good but toxic, 2 good.
GRADE = "CASE WHEN quality = 0 THEN 0 WHEN quality = 1 THEN CASE WHEN toxic = 1 THEN 1 ELSE 2 END END"


@query("op6_ordinal_quality")
def ordinal_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit_ordinal(documents, table(spark, sf_dir, "labels"), F.expr(GRADE), 3, train=~contract_split())
    rated = documents.select("doc_id", contract_split().alias("held_out"), rating_column(model, F.col("text")).alias("r"))
    return rated.select(
        "doc_id",
        "held_out",
        F.col("r")[0].alias("expected_grade"),
        F.col("r")[1].alias("tail_good"),
        F.col("r")[2].alias("tail_clean"),
        (F.col("r")[1] >= 0.5).cast("int").alias("selected"),
    )


@query("op10_lsh_forest")
def lsh_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_groups(table(spark, sf_dir, "documents")).drop("t1", "t2", "root")


@query("op1_sentence_spans")
def sentence_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    clean = drop_repeated_spans(table(spark, sf_dir, "documents"), whole=True)
    return clean.select(
        "doc_id",
        F.col("n_sentences").cast("long"),
        F.col("n_removed").cast("long"),
        F.array_join(F.col("removed").cast("array<string>"), ",").alias("removed"),
        F.length("text").cast("long").alias("n_chars_left"),
        F.sha2("text", 256).alias("clean_sha256"),
    )


@query("op4_winnowing")
def winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare_with_edited(table(spark, sf_dir, "documents")).select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        as_string("own").alias("fingerprint"),
        as_string("new").alias("edited_fingerprint"),
        "near_edited",
        "near_next",
    )


@query("op8_kneser_ney")
def kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    held = split_by_crc(F.col("doc_id"), 7, 2)
    model = train_lm(documents.filter(~held))
    scored = documents.select("doc_id", held.alias("held_out"), lm_column(model, F.col("text")).alias("s"))
    return scored.select(
        "doc_id", "held_out", "s.n_tokens", "s.n_known", F.lit(model.n_tokens).cast("long").alias("train_tokens"), "s.base_score", "s.score"
    )


@query("op2_skip_chain")
def skip_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = documents.select("doc_id", spans_column(fit_field(documents), F.col("text")).alias("found"))

    def joined(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    base = F.filter("found", lambda s: s["base"])
    counts = [F.expr(f"CAST(size(filter(found, s -> s.base AND s.kind = '{kind}')) AS BIGINT) AS n_{kind}") for kind in KINDS]
    return found.select("doc_id", *counts, F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("found")).alias("spans"))


#: Files of the two tokenizers, which every worker has.
TOKENIZERS = ("/opt/tokenizers/byte_bpe_50k.json", "/opt/tokenizers/piece_bpe_32k.model")


@query("op11_token_alignment")
def token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align_tokenizers(table(spark, sf_dir, "documents"), *TOKENIZERS)


@query(
    "op12_prefix_trie",
    """
    WITH t AS (SELECT conv_id AS c, coalesce(role, '') AS r, coalesce(text, '') AS x,
        row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS i
      FROM conversations WHERE conv_id IS NOT NULL),
    s AS (SELECT c, xor(list_reduce(
          list_prepend(4294967295::BIGINT, list_transform(string_split(c::VARCHAR, ''), lambda ch: ascii(ch)::BIGINT)),
          lambda acc, b: list_reduce(list_prepend(xor(acc, b), range(8)), lambda v, k: xor(v >> 1, 3988292384 * (v & 1)))
        ), 4294967295) % 9 AS h
      FROM (SELECT DISTINCT c FROM t)),
    u AS (SELECT s.c, 0 AS own, i, r, x FROM s JOIN t ON t.c = s.c - s.c % 5 AND i < h
      UNION ALL SELECT s.c, 1, i, r, x FROM s JOIN t USING (c) WHERE i >= h),
    v AS (SELECT c, x, md5(length(r) || ':' || r || x) AS m, row_number() OVER w AS d, lead(c) OVER w IS NULL AS last FROM u
      WINDOW w AS (PARTITION BY c ORDER BY own, i)),
    p AS (SELECT c, d, strlen(x) AS size, last, md5(string_agg(m, '' ORDER BY d) OVER (PARTITION BY c ORDER BY d)) AS k FROM v
      UNION ALL SELECT c, 0, 0, c NOT IN (SELECT c FROM u), '' FROM s),
    n AS (SELECT k, d, min(c) AS conv_id, count(*) AS n_convs, (count(*) - 1) * max(size) AS saves,
        count(*) FILTER (last) = count(*) AS leaf, sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (last), '')) AS ends_sha256
      FROM p GROUP BY k, d),
    a AS (SELECT up.k, up.d, sum(saves) AS saved_tokens, count(*) FILTER (leaf) AS n_leaves, count(*) FILTER (n.d = up.d + 1) AS n_children
      FROM n JOIN p AS up ON up.c = n.conv_id AND up.d <= n.d GROUP BY up.k, up.d)
    SELECT n.conv_id, n.d::BIGINT AS depth, m.conv_id AS parent_conv_id, n.n_convs, n_children, n_leaves,
      saved_tokens::BIGINT AS saved_tokens, n.ends_sha256
    FROM n JOIN a USING (k, d) LEFT JOIN p ON p.c = n.conv_id AND p.d = n.d - 1 LEFT JOIN n AS m ON m.k = p.k AND m.d = p.d
    """,
)
def prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie(table(spark, sf_dir, "conversations"), heads="crc32(CAST(CAST(c AS STRING) AS BINARY)) % 9")


RULES = [
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
]


@query(
    "op13_link_graph",
    r"""
    WITH RECURSIVE a AS (SELECT page_id, html,
        translate(regexp_extract(coalesce(url, ''), '(?s)://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        regexp_extract(coalesce(url, ''), '(?s)://[^/?#]*([^?#]*)', 1) AS path FROM pages),
    rules(domain, prefix, rule, v) AS (VALUES ('com', '/', 'com/', 'allow'), ('example.com', '/en/', 'example.com/en/', 'block'),
        ('www.example.com', '/en/', 'www.example.com/en/', 'allow'), ('net', '/es/', 'net/es/', 'block'), ('net', '/fr/', 'net/fr/', 'block')),
    j AS (SELECT a.*, (SELECT arg_max(rules, length(rule)) FROM rules
        WHERE (host = domain OR ends_with(host, '.' || domain)) AND starts_with(path, prefix)) AS r FROM a),
    s AS (SELECT host, count(*) AS pages, count(*) FILTER (r.v = 'allow') AS allowed, count(*) FILTER (r.v = 'block') AS blocked
      FROM j WHERE host <> '' GROUP BY host),
    x AS (SELECT page_id, host, unnest(list_distinct(list_transform(regexp_extract_all(html,
        '(?is)<a\s[^<>]*?href\s*=\s*["'']?(?:[a-z][a-z0-9+.-]*:)?//([^/?#"''\s<>]*)', 1), lambda h: lower(h)))) AS target FROM a),
    l AS (SELECT host AS source, target, count(*) AS n FROM x WHERE host <> '' AND target <> '' AND host <> target GROUP BY ALL),
    w AS (SELECT source, target, 0.85 * n / sum(n) OVER (PARTITION BY source) AS f, 0.85 * n / sum(n) OVER (PARTITION BY target) AS b FROM l),
    hosts AS (SELECT host FROM s UNION SELECT source FROM l UNION SELECT target FROM l),
    z AS (SELECT host, coalesce(pages, 0)::DOUBLE AS pages, coalesce(allowed, 0)::DOUBLE AS allowed, coalesce(blocked, 0)::DOUBLE AS blocked
      FROM hosts LEFT JOIN s USING (host)),
    moves AS (SELECT source AS frm, target AS dst, f, 0.0 AS b FROM w UNION ALL SELECT target, source, 0.0, b FROM w
      UNION ALL SELECT host, host, 0.0, 0.0 FROM z),
    rank AS (SELECT 0 AS k, host, allowed AS t, pages AS f, blocked AS d, pages AS q FROM z
      UNION ALL
      SELECT k + 1, dst, any_value(z.allowed) + sum(moves.f * t), any_value(z.pages) + sum(moves.f * rank.f),
        any_value(z.blocked) + sum(moves.b * d), any_value(z.pages) + sum(moves.b * q)
      FROM rank JOIN moves ON frm = rank.host JOIN z ON z.host = dst WHERE k < 90 GROUP BY k, dst),
    judged AS (SELECT host, round(coalesce(d / nullif(q, 0), 0), 9) - round(coalesce(t / nullif(f, 0), 0), 9) >= 0.4 AS bad FROM rank WHERE k = 90)
    SELECT page_id, j.host, path, r.rule AS rule, coalesce(r.v, CASE WHEN bad THEN 'block' ELSE 'allow' END) AS verdict
    FROM j LEFT JOIN judged USING (host)
    """,
)
def link_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_pages(table(spark, sf_dir, "pages"), RULES).drop("trust", "distrust")
