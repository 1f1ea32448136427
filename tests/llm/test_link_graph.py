from collections import Counter, defaultdict

import pytest

from isobar.llm.link_graph import judge_pages, spread

RULES = [("allow", "com/"), ("block", "bad.com/en/"), ("allow", "www.bad.com/en/"), ("block", "net/es/"), ("block", "spam.org/")]


def address(url):
    _, found, rest = (url or "").partition("://")
    if not found:
        return "", ""
    rest = rest.split("#")[0].split("?")[0] if "?" not in rest.split("#")[0] else rest.split("?")[0]
    host, slash, path = rest.partition("/")
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), slash + path


def rule_of(host, path):
    best = None
    for verdict, rule in RULES:
        domain, slash, rest = rule.partition("/")
        if (host == domain or host.endswith("." + domain)) and path.startswith(slash + rest) and (best is None or len(rule) > len(best[1])):
            best = (verdict, rule)
    return best


def plain_ranks(starts, links, damping=0.85, rounds=300):
    """Power iteration over dictionaries; `starts` has (pages, allowed, blocked) by host."""
    hosts = set(starts) | {h for pair in links for h in pair}
    out, into = Counter(), Counter()
    for (a, b), n in links.items():
        out[a] += n
        into[b] += n
    seeds = {h: starts.get(h, (0, 0, 0)) for h in hosts}
    start = {h: (s[1], s[0], s[2], s[0]) for h, s in seeds.items()}
    rank = dict(start)
    for _ in range(rounds):
        new = {h: list(v) for h, v in start.items()}
        for (a, b), n in links.items():
            for k in (0, 1):
                new[b][k] += damping * n / out[a] * rank[a][k]
            for k in (2, 3):
                new[a][k] += damping * n / into[b] * rank[b][k]
        rank = new
    return {h: (t / f if f else 0, d / q if q else 0) for h, (t, f, d, q) in rank.items()}


def pages():
    def a(*targets):
        return "<html>" + "".join(f'<p><a class=x href="{t}">t</a></p>' for t in targets) + "</html>"

    rows = [(1, "http://good.com/a", a("/x", "https://friend.org/1", "//friend.org/2"))]
    rows += [(2, "http://friend.org/", a("http://FRIEND2.org"))]
    rows += [(k, "https://farm.org/%d" % k, a("http://spam.org/p")) for k in range(3, 6)]
    rows += [(k, "http://spam.org/p%d?x=/en/" % k, a("http://farm.org/")) for k in range(30, 36)]
    rows += [(7, "HTTP://WWW.bad.com/en/1#top", None), (8, "x://bad.com/en/1", ""), (9, "x://bad.com/de/1", "<a href='//feeder.net'>")]
    rows += [(10, "http://feeder.net/es/2", a("http://spam.org")), (11, "http://feeder.net/en", a("http://spam.org"))]
    rows += [(12, None, a("http://spam.org")), (13, "no address", a("http://spam.org")), (14, "http://", None), (None, "http://com/", None)]
    rows += [(15, "http://a.b.c.net/es/", "<a href=http://spam.org/x>" * 3 + "<a " * 50 + "href"), (15, "http://a.b.c.net/es/", "z" * 100_000)]
    rows += [(16, "http://" + "x." * 3000 + "com/q", None), (17, "http://alone.net/es/1", None), (18, "http://alone.net/de/1", None)]
    rows += [(19, "http://com", None), (20, "http://xcom/", None), (21, "a://b://c/d", None)]
    return rows


LINKS = {
    ("good.com", "friend.org"): 1,
    ("friend.org", "friend2.org"): 1,
    ("farm.org", "spam.org"): 3,
    ("spam.org", "farm.org"): 6,
    ("bad.com", "feeder.net"): 1,
    ("feeder.net", "spam.org"): 2,
    ("a.b.c.net", "spam.org"): 1,
}


@pytest.mark.parametrize("few", [True, False])
def test_verdicts_equal_brute_force(spark, rows, monkeypatch, few):
    if not few:
        monkeypatch.setattr("isobar.llm.link_graph.BROADCAST_ROWS", 1)
    data = pages()
    schema = "page_id long, url string, html string, host string, path int, rule int, pages int, n int, trust string"
    df = spark.createDataFrame([(*r, "h", 1, 2, 3, 4, "t") for r in data], schema)
    found = {k: (*address(u), rule_of(*address(u))) for k, (_, u, _) in enumerate(data)}
    starts = defaultdict(lambda: (0, 0, 0))
    for host, _, rule in found.values():
        if host:
            p, a, b = starts[host]
            starts[host] = (p + 1, a + (rule is not None and rule[0] == "allow"), b + (rule is not None and rule[0] == "block"))
    ranks = plain_ranks(dict(starts), LINKS)
    want = Counter()
    for k, (page, _, _) in enumerate(data):
        host, path, rule = found[k]
        trust, distrust = ranks.get(host, (0, 0))
        verdict = rule[0] if rule else "block" if distrust - trust >= 0.4 else "allow"
        want[page, host, path, rule and rule[1], verdict, round(trust, 4), round(distrust, 4)] += 1
    got = [(*r[:5], round(r[5], 4), round(r[6], 4)) for r in rows(judge_pages(df, RULES))]
    assert Counter(got) == want
    by_host = {r[1]: r[4] for r in got if r[3] is None}
    assert [by_host[h] for h in ("friend.org", "farm.org", "alone.net")] == ["allow", "block", "block"]


def test_ranks_on_a_ring_with_a_hub(spark, rows):
    links = {(f"h{k}", f"h{(k + 1) % 40}"): 1 + k % 3 for k in range(40)} | {("h0", f"x{k}"): 2 for k in range(30)}
    starts = {f"h{k}": (10, k % 7, (k * 3) % 5) for k in range(40)}
    got = spread(
        spark.createDataFrame([(h, *s) for h, s in starts.items()], "host string, pages long, allowed long, blocked long"),
        spark.createDataFrame([(*p, n) for p, n in links.items()], "source string, target string, n long"),
    )
    want = plain_ranks(starts, links)
    found = {h: (t, d) for h, t, d in rows(got)}
    assert set(found) == set(want)
    assert all(abs(x - y) < 1e-4 for h in want for x, y in zip(found[h], want[h], strict=True))


def test_no_rules_and_empty_table(spark, rows):
    shape = "page_id long, url string, html string"
    assert rows(judge_pages(spark.createDataFrame([], shape), RULES)) == []
    assert rows(judge_pages(spark.createDataFrame([(1, "http://a.com/x", None)], shape), []), "rule", "verdict") == [(None, "allow")]
