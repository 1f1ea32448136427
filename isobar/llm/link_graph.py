"""URL verdicts: rules on hosts and paths first, then trust and distrust that spread along the links between hosts.

A rule such as `example.com/en/` fits its host and all subdomains where the path starts with the rule's path; of several the
longest decides, then the one with the longer host, then the blocking one. What no rule judges is decided per host. Each host
starts with its pages that a rule allows as trust and its blocked pages as distrust. Trust follows links (personalised
PageRank); distrust goes the other way, to hosts that link to distrusted ones. Beside each runs the same rank with all pages of
a host at the start, so that `trust` and `distrust` of a host are shares, between 0 and 1, of what reaches it. A host is blocked
where its distrust exceeds its trust by `limit`.

Only hosts with links to other hosts take part in the rounds; all others keep the shares of their own pages, which is where the
rounds would leave them. Links are absolute or protocol-relative addresses of `<a>` tags; a page counts once per linked host.

Defined results: a null address, or one without `://`, has an empty host and path, fits no rule, and is allowed; links of such
pages count for no host; null markup has no links; rows with equal ids are judged each; columns other than the three named are
ignored; an empty table gives no rows. Rules are a list that the caller holds.
"""

from __future__ import annotations

import string
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from isobar.llm.staging import BROADCAST_ROWS, join_counted, staged

ADDRESS = r"(?s)://([^/?#]*)([^?#]*)"
LINK = r"(?is)<a\s[^<>]*?href\s*=\s*[\"']?(?:[a-z][a-z0-9+.-]*:)?//([^/?#\"'\s<>]*)"


def _small(column: Column) -> Column:
    return F.translate(column, string.ascii_uppercase, string.ascii_lowercase)


def host_of(url: Column) -> Column:
    return _small(F.coalesce(F.regexp_extract(url, ADDRESS, 1), F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, ADDRESS, 2), F.lit(""))


def with_rules(hosts: DataFrame, rules: Sequence[tuple[str, str]]) -> DataFrame:
    """Adds `rules` to one row per host: those on it or a parent domain, the deciding one first.

    Only the last labels of a host, as many as the longest rule has, can name a rule's host.
    """
    spark = hosts.sparkSession
    parts = [(rule.partition("/")[0], rule[len(rule.partition("/")[0]) :], rule, verdict) for verdict, rule in rules]
    listed = spark.createDataFrame(parts, "domain string, path string, rule string, verdict string")
    deepest = max((domain.count(".") + 1 for domain, *_ in parts), default=0)
    labels = F.split("host", r"\.")
    ends = [F.when(F.size(labels) >= k, F.array_join(F.slice(labels, -k, k), ".")) for k in range(1, deepest + 1)]
    domains = hosts.select("host", F.explode(F.array_compact(F.array(*ends)) if ends else F.array().cast("array<string>")).alias("domain"))
    rank = F.struct((-F.length("rule")).alias("a"), (-F.length("domain")).alias("b"), (F.col("verdict") != "block").alias("c"), "path", "rule", "verdict")
    found = join_counted(domains, listed.groupBy("domain").agg(F.collect_set(F.struct("path", "rule", "verdict")).alias("own")), ["domain"], "inner")
    per_host = (
        found.select("host", "domain", F.inline("own"))
        .groupBy("host")
        .agg(F.transform(F.sort_array(F.collect_list(rank)), lambda r: F.struct(r["path"], r["rule"], r["verdict"])).alias("rules"))
    )
    return hosts.join(per_host, "host", "left")


def _decided(rules: Column, path: Column) -> Column:
    """The first rule whose path the address's path starts with, else null."""
    return F.get(F.filter(rules, lambda r: F.startswith(path, r["path"])), F.lit(0))


def host_links(pages: DataFrame, url: str, html: str) -> DataFrame:
    """(source, target, n): how many pages of a host link to another host."""
    found = F.array_distinct(F.transform(F.regexp_extract_all(F.col(html), F.lit(LINK), 1), _small))
    linked = pages.select(host_of(F.col(url)).alias("source"), F.explode(found).alias("target"))
    return linked.filter("source != '' AND target != '' AND source != target").groupBy("source", "target").agg(F.count("*").alias("n"))


def spread(starts: DataFrame, links: DataFrame, damping: float = 0.85, tolerance: float = 1e-6) -> DataFrame:
    """(host, trust, distrust) from (host, pages, allowed, blocked) and (source, target, n).

    Every round adds to the start of a host what its neighbours pass on, so ranks only grow. It ends when what can still come is
    less than `tolerance` of all ranks.
    """
    links = staged(links, "links")
    sent = links.groupBy("source").agg(F.sum("n").alias("all"))
    got = links.groupBy("target").agg(F.sum("n").alias("all"))
    ahead = join_counted(links, sent, ["source"], "inner").select(
        F.col("source").alias("frm"), F.col("target").alias("to"), (F.col("n") / F.col("all") * damping).alias("w"), F.lit(True).alias("forward")
    )
    back = join_counted(links, got, ["target"], "inner").select(
        F.col("target").alias("frm"), F.col("source").alias("to"), (F.col("n") / F.col("all") * damping).alias("w"), F.lit(False).alias("forward")
    )
    steps = staged(ahead.unionAll(back), "steps")
    if steps.isEmpty():
        return _shares(starts.select("host", *_named("allowed", "pages", "blocked", "pages")))
    linked = steps.select(F.col("to").alias("host")).distinct()
    base = staged(
        linked.join(starts, "host", "left").select(
            "host", *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in ("pages", "allowed", "blocked")]
        ),
        "base",
    )
    few = base.count() <= BROADCAST_ROWS
    state = base.select("host", *_named("allowed", "pages", "blocked", "pages"))
    total = None
    while True:
        sums = [F.sum(F.when(F.col("forward") == f, F.col("w") * F.col(c))).alias(c) for c, f in (("t", True), ("f", True), ("d", False), ("q", False))]
        moved = steps.join(F.broadcast(state) if few else state, steps["frm"] == state["host"]).groupBy("to").agg(*sums)
        both = base.join(moved, base["host"] == moved["to"], "left")
        grown = [(F.col(s) + F.coalesce(F.col(c), F.lit(0.0))).alias(c) for c, s in (("t", "allowed"), ("f", "pages"), ("d", "blocked"), ("q", "pages"))]
        state = staged(both.select("host", *grown), "rank")
        before, total = total, state.agg(F.sum(F.col("f") + F.col("q"))).first()[0]
        if before is not None and (total - before) * damping <= tolerance * (1 - damping) * total:
            break
    alone = starts.join(state.select("host"), "host", "left_anti").select("host", *_named("allowed", "pages", "blocked", "pages"))
    return _shares(state.unionByName(alone))


def _named(*sources: str) -> list[Column]:
    return [F.col(c).cast("double").alias(name) for c, name in zip(sources, ("t", "f", "d", "q"), strict=True)]


def _shares(state: DataFrame) -> DataFrame:
    def share(part: str, whole: str) -> Column:
        return F.round(F.coalesce(F.try_divide(F.col(part), F.col(whole)), F.lit(0.0)), 9)

    return state.select("host", share("t", "f").alias("trust"), share("d", "q").alias("distrust"))


def judge_pages(
    pages: DataFrame,
    rules: Sequence[tuple[str, str]],
    page_id: str = "page_id",
    url: str = "url",
    html: str = "html",
    limit: float = 0.4,
    damping: float = 0.85,
) -> DataFrame:
    """(page_id, host, path, rule, verdict, trust, distrust) of every row; `rules` are (allow or block, host/path)."""
    address = pages.select(F.col(page_id).alias("page_id"), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    hosts = staged(with_rules(address.select("host").distinct(), rules), "host-rules")
    ruled = join_counted(address, hosts, ["host"]).withColumn("rule", _decided(F.col("rules"), F.col("path"))).drop("rules")
    counts = [F.count(F.when(F.col("rule.verdict") == v, 1)).alias(n) for v, n in (("allow", "allowed"), ("block", "blocked"))]
    starts = staged(ruled.filter("host != ''").groupBy("host").agg(F.count("*").alias("pages"), *counts), "starts")
    ranks = spread(starts, host_links(pages, url, html), damping)
    judged = join_counted(ruled, ranks, ["host"])
    trust, distrust = F.coalesce("trust", F.lit(0.0)), F.coalesce("distrust", F.lit(0.0))
    other = F.when(distrust - trust >= limit, "block").otherwise("allow")
    return judged.select(
        "page_id",
        "host",
        "path",
        F.col("rule.rule").alias("rule"),
        F.coalesce("rule.verdict", other).alias("verdict"),
        trust.alias("trust"),
        distrust.alias("distrust"),
    )
