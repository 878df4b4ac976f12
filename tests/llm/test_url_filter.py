"""Address rules against plain loops: parts, links, precedence, aliases, many rules."""

import random
import re
from urllib.parse import urljoin

import pytest
from pyspark.sql import functions as F

from claimlake.llm import catalog, url_filter
from claimlake.llm.url_filter import Rule

LOWER = str.maketrans(url_filter.UPPER, url_filter.LOWER)


def parts(url):
    if url is None or "://" not in url:
        return "", "", None
    scheme, rest = url.split("://", 1)
    host = re.match(r"[^/?#]*", rest)[0].translate(LOWER)
    path = re.match(r"[^/?#]*([^?#]*)", rest)[1]
    query = re.match(r"[^?#]*(\?[^#]*)?", rest)[1] or ""
    return host, path, f"{scheme.translate(LOWER)}://{host}{path}{query}"


def decided(host, path, rules):
    fit = [r for r in rules if host and (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return min(fit, key=lambda r: (-len(r.host + r.path), r.verdict != "allow", r.host + r.path), default=None)


def expected(pages, links, rules):
    """pages: (id, url); links: (from, to) of absolute addresses."""
    near = {}
    for u, v in ((parts(a)[2], parts(b)[2]) for a, b in links):
        if u and v:
            near.setdefault(u, set()).add(v)
            near.setdefault(v, set()).add(u)
    verdict = lambda node: (r := decided(*parts(node)[:2], rules)) and r.verdict
    reached = {n for n in near if verdict(n) == "block"}
    todo = list(reached)
    while todo:
        fresh = near[todo.pop()] - reached
        reached |= fresh
        todo += fresh
    rows = []
    for i, url in pages:
        host, path, node = parts(url)
        rule = decided(host, path, rules)
        alias = rule is None and node in reached
        rows.append((i, host, path, rule and rule.host + rule.path, rule.verdict if rule else "block" if alias else "allow", alias))
    return sorted(rows, key=repr)


def rows(df):
    return sorted((tuple(r) for r in df.select("page_id", "host", "path", "rule", "verdict", "alias").collect()), key=repr)


RULES = catalog.URL_RULES
URLS = [None, "", "no scheme", "http://a.org", "http://A.ORG?x=1", "http://example.org/en/1", "http://sub.EXAMPLE.org/en/12?y#z", "http://notexample.org/es/x", "https://example.org/es", "https://m.b.com/de/1", "https://m.b.com/fr/1",
        "https://com/de/", "ftp://x.net/a://b", "://x.org/", "http:///es/", "http://ÄB.Com/de/ü\nx", "http://x.net", "http://x.net/?q", "http://b.com#f/de/"]


@pytest.mark.parametrize("joined", [False, True])
def test_parts_and_rules(spark, joined, monkeypatch):
    if joined:
        monkeypatch.setattr(url_filter, "MOST_RULES", 1)
    pages = list(enumerate(URLS)) + [(None, "http://b.com/de/x"), (3, "http://a.org")]
    table = spark.createDataFrame([(i, u, None, "x", 1) for i, u in pages], "page_id long, url string, html string, host string, size int")
    rules = spark.createDataFrame(RULES, "verdict string, host string, path string") if joined else RULES
    assert rows(url_filter.judge(table, rules)) == expected(pages, [], RULES)
    assert url_filter.judge(table.where("page_id < 0"), rules).count() == 0
    assert {r.verdict for r in url_filter.judge(table, []).collect()} == {"allow"}


def test_links_carry_blocks_and_allows_stay(spark):
    tag = lambda kind, to: f"<link rel=\"{kind}\" href='{to}'/>"
    pages = [
        (1, "https://b.com/de/1", ""),  # blocked by a rule
        (2, "https://x.net/a/b", tag("shortcut CANONICAL", "https://b.com/de/1#top")),
        (3, "https://y.net/q", "<META HTTP-EQUIV=Refresh content=\"5; URL='https://x.net/a/b'\">"),
        (4, "https://b.com/fr/1", tag("canonical", "https://b.com/de/1")),  # allowed by a rule
        (5, "https://z.net/", "<!-- " + tag("canonical", "https://b.com/de/1") + " --><script>" + tag("canonical", "https://b.com/de/1")),
        (6, "https://w.net/p/q", tag("canonical", "../r?x=1&amp;y=2")),
        (7, "https://w.net/r?x=1&y=2", tag("canonical", "https://com/de/never-crawled")),
        (8, "https://v.net/", tag("stylesheet", "https://b.com/de/1")),
        (9, "https://W.net/p/q#again", ""),
        (10, "https://u.net/", tag("canonical", "mailto:x@b.com") + tag("canonical", "#x") + tag("canonical", "")),
        (11, None, tag("canonical", "https://b.com/de/1")),
    ]
    table = spark.createDataFrame(pages, "page_id long, url string, html string")
    got = {r.page_id: (r.verdict, r.alias) for r in url_filter.judge(table, RULES).collect()}
    blocked = {2, 3, 6, 7, 9}
    assert got == {i: ("block" if i in blocked | {1} else "allow", i in blocked) for i, *_ in pages}


LINKS = ["x", "/x/y", "../x", "./x", "../../../x", "a/./b/../c", "..", ".", "?q=1", "x?y#z", "//h.net/p", "HTTP://h.net", "a:b", "/", "x/", "/a//b/../c"]


@pytest.mark.parametrize("base", ["http://s.net/a/b/c?d", "http://s.net/", "http://s.net/a/"])
def test_resolve_as_the_library_does(spark, base):
    got = spark.createDataFrame([(x,) for x in LINKS], "x string").select("x", url_filter.resolve(F.lit(base), F.col("x")).alias("to")).collect()
    for r in got:
        want = None if r.x == "a:b" else "HTTP://h.net" if r.x.startswith("HTTP") else urljoin(base, r.x)
        assert r.to == want, (base, r)


@pytest.mark.parametrize("seed", [1, 2])
def test_random_graphs_and_many_rules(spark, seed):
    rng = random.Random(seed)
    host = lambda: ".".join(rng.choices("abcd", k=rng.randint(1, 3)))
    address = lambda: f"http://{host()}/{rng.choice('xyz')}/{rng.choice('xyz')}"
    rules = [Rule(rng.choice(["allow", "block"]), host(), rng.choice(["/", "/x", "/y/", "/z/x", ""])) for _ in range(25)]
    pages = [(i, address()) for i in range(120)] + [(1000 + i, "http://a.b/x/x") for i in range(60)]
    links = [(address(), address()) for _ in range(60)]
    table = spark.createDataFrame(pages, "page_id long, url string").withColumn("html", F.lit(""))
    moved = spark.createDataFrame(links, "from_url string, to_url string")
    want = expected(pages, links, rules)
    assert rows(url_filter.judge(table, rules, moved)) == want
    many = spark.createDataFrame(rules + [Rule("block", f"h{i}.none", "/") for i in range(url_filter.MOST_RULES)], "verdict string, host string, path string")
    assert rows(url_filter.judge(table, many, moved)) == want
