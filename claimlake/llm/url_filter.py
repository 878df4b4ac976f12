"""Block and allow rules over addresses, carried along redirects and canonical links.

A rule is a verdict, a host and the beginning of a path. It fits its host and all subdomains if the path of the address starts with its path; of the rules that fit, the longest decides (host and path
together; of equally long ones an allow, then the first by name). An address without a rule is blocked if it is an alias of a blocked one: if redirects and canonical links, in
either direction and over any number of steps, lead from it to an address that a rule blocks, whether that was crawled or not. An explicit allow takes precedence: what a rule allows stays allowed, whatever its aliases.
All else is allowed.

Host: after the first `://` up to `/`, `?`, `#` or the end, A-Z lower-cased; path: then up to `?`, `#` or the end. An address that is null or has no `://` has neither host nor path, no rule and no
aliases, and is allowed. Aliases compare scheme, host, path and query; fragments don't count. Links come from `<link rel=canonical>` and `<meta http-equiv=refresh>` outside comments and scripts, and from a table of
redirects if one is given; relative ones are resolved against the page's own address (a base element isn't heeded), other schemes such as mailto: are none. Null or empty pages have no links.
Each row of the input has one row in the result, repeated and null ids included; an empty table gives an empty one. Extra columns are ignored.

All is DataFrame expressions and joins. Up to MOST_RULES rules are held against each row in place; more of them are met by suffix of the host and beginning of the path, without a comparison of each with each. Hosts, addresses
and components with a large share of the rows are broadcast, all others shuffled, so that none lands in one task.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .components import connected_components
from .shared import join_large, left_join_large, materialise

#: Rules that each row is held against in place.
MOST_RULES = 200
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


class Rule(NamedTuple):
    verdict: str
    host: str
    path: str


# ---- parts of addresses


def _after_scheme(url: Column) -> Column:
    """What follows the first ://; null without one."""
    at = F.locate("://", url)
    return F.when(at > 0, F.substr(url, at + 3))


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(_after_scheme(url), "^[^/?#]*", 0), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_after_scheme(url), "^[^/?#]*([^?#]*)", 1), F.lit(""))


def _scheme(url: Column) -> Column:
    return F.translate(F.substring_index(url, "://", 1), UPPER, LOWER)


def node_of(url: Column) -> Column:
    """The address without its fragment, scheme and host in lower case; null without ://."""
    query = F.regexp_extract(_after_scheme(url), r"^[^?#]*(\?[^#]*)", 1)
    return F.when(F.contains(url, F.lit("://")), F.concat(_scheme(url), F.lit("://"), host_of(url), path_of(url), query))


def _without_dots(path: Column) -> Column:
    """The path with its . and .. segments followed."""
    steps = F.split(path, "/")
    pushed = F.aggregate(
        steps, F.array().cast("array<string>"),
        lambda kept, step: F.when(step == ".", kept).when(step == "..", F.slice(kept, 1, F.greatest(F.lit(1), F.size(kept) - 1))).otherwise(F.array_append(kept, step)),
    )
    closed = F.when(F.element_at(steps, -1).isin(".", ".."), F.lit("/")).otherwise("")
    return F.when(F.contains(path, F.lit("/.")), F.concat(F.array_join(pushed, "/"), closed)).otherwise(path)


def resolve(base: Column, link: Column) -> Column:
    """The absolute address of a link on a page; null if it leads nowhere else."""
    link = F.trim(F.replace(link, F.lit("&amp;"), F.lit("&")))
    root = F.concat(_scheme(base), F.lit("://"), host_of(base))
    file, rest = F.regexp_extract(link, "^[^?#]*", 0), F.regexp_extract(link, r"^[^?#]*([?#].*)?$", 1)
    folder = F.regexp_replace(path_of(base), "[^/]*$", "")
    within = F.when(F.startswith(link, F.lit("/")), file).otherwise(F.concat(F.when(folder == "", F.lit("/")).otherwise(folder), file))
    return (
        F.when(~F.contains(base, F.lit("://")) | (link == "") | F.startswith(link, F.lit("#")), None)
        .when(link.rlike("^[A-Za-z][A-Za-z0-9+.-]*://"), link)
        .when(link.rlike("^[A-Za-z][A-Za-z0-9+.-]*:"), None)
        .when(F.startswith(link, F.lit("//")), F.concat(_scheme(base), F.lit(":"), link))
        .when(F.startswith(link, F.lit("?")), F.concat(root, path_of(base), link))
        .otherwise(F.concat(root, _without_dots(within), rest))
    )


# ---- links of pages


def _attribute(tag: Column, name: str) -> Column:
    pattern = rf"""(?i)\s{name}\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""
    return F.concat(*(F.regexp_extract(tag, pattern, group) for group in (1, 2, 3)))


def links_in(html: Column) -> Column:
    """The addresses, as written, of canonical links and refreshes."""
    shown = F.regexp_replace(html, r"(?is)<!--.*?(?:-->|\z)|<script\b.*?(?:</script|\z)", " ")
    tags = F.when(html.rlike("(?i)canonical|http-equiv"), F.regexp_extract_all(shown, F.lit(r"(?i)<(?:link|meta)\s[^>]*>"), F.lit(0)))
    canonical = lambda t: F.array_contains(F.split(F.lower(_attribute(t, "rel")), r"\s+"), "canonical")
    refresh = lambda t: F.lower(F.trim(_attribute(t, "http-equiv"))) == "refresh"
    after = r"""(?i)^\s*[0-9.]*\s*[;,]\s*(?:url\s*=\s*)?["']?([^"']*)"""
    found = F.transform(tags, lambda t: F.when(canonical(t), _attribute(t, "href")).when(refresh(t), F.regexp_extract(_attribute(t, "content"), after, 1)))
    return F.coalesce(F.array_distinct(F.filter(found, lambda x: F.coalesce(x != "", F.lit(False)))), F.array().cast("array<string>"))


# ---- rules


def _in_place(rules: list[Rule], host: Column, path: Column) -> Column:
    """(rule, verdict) of the first rule that fits; rules come in the order of precedence."""
    known = F.array(*(F.struct(F.lit(f".{r.host}").alias("suffix"), F.lit(r.path).alias("path"), F.lit(r.host + r.path).alias("rule"), F.lit(r.verdict).alias("verdict")) for r in rules))
    dotted = F.concat(F.lit("."), host)
    fits = lambda r: (host != "") & F.endswith(dotted, r["suffix"]) & F.startswith(path, r["path"])
    return F.get(F.filter(known, fits), 0)


def _by_join(rows: DataFrame, rules: DataFrame) -> DataFrame:
    """Adds rule and verdict to rows (host, path, ...), of any number of rules (verdict, host, path)."""
    addresses = materialise(rows.where("host <> ''").groupBy("host", "path").agg(F.count(F.lit(1)).alias("size")), "addresses")
    labels = rules.agg(F.max(F.size(F.split("host", r"\."))).alias("n"), F.count(F.lit(1)).alias("rules")).first()
    split = F.split("host", r"\.")
    first = F.greatest(F.lit(1), F.size(split) - (labels["n"] or 0) + 1)
    suffixes = F.transform(F.sequence(first, F.size(split)), lambda i: F.array_join(F.slice(split, i, F.size(split)), "."))
    exploded = materialise(addresses.select("host", "path", F.explode(suffixes).alias("suffix")), "suffixes")
    total = exploded.count()
    lengths = rules.groupBy(F.col("host").alias("suffix")).agg(F.collect_set(F.length("path")).alias("lengths"))
    reached = join_large(exploded, exploded.groupBy("suffix").agg(F.count(F.lit(1)).alias("size")).join(lengths, "suffix"), ["suffix"], total).drop("size")
    beginnings = materialise(reached.select("host", "path", "suffix", F.explode("lengths").alias("n")).where(F.length("path") >= F.col("n")).select("host", "path", "suffix", F.substr("path", F.lit(1), F.col("n")).alias("start")), "beginnings")
    preferred = F.max_by("verdict", F.when(F.col("verdict") == "allow", 1).otherwise(0)).alias("verdict")
    known = rules.select(F.col("host").alias("suffix"), F.col("path").alias("start"), "verdict").groupBy("suffix", "start").agg(preferred)
    sized = beginnings.groupBy("suffix", "start").agg(F.count(F.lit(1)).alias("size")).join(known, ["suffix", "start"])
    name = F.concat("suffix", "start")
    order = F.struct(-F.length(name), F.when(F.col("verdict") == "allow", 0).otherwise(1), name)
    best = join_large(beginnings, sized, ["suffix", "start"], beginnings.count()).groupBy("host", "path").agg(F.min_by(F.struct(name.alias("rule"), "verdict"), order).alias("r"))
    groups = addresses.join(best.select("host", "path", "r.rule", "r.verdict"), ["host", "path"])
    return left_join_large(rows, groups, ["host", "path"], rows.count()).select(*rows.columns, "rule", "verdict")


def with_rule(rows: DataFrame, rules: list[Rule] | DataFrame) -> DataFrame:
    """Rows (host, path, ...) with the rule that decides, and its verdict; both are null without one."""
    if isinstance(rules, DataFrame):
        own = rules.select("verdict", "host", "path").where("host is not null and path is not null").distinct()
        first = own.limit(MOST_RULES + 1).collect()
        if len(first) > MOST_RULES:
            return _by_join(rows, own)
        rules = [Rule(*r) for r in first]
    if not rules:
        return rows.withColumns({c: F.lit(None).cast("string") for c in ("rule", "verdict")})
    ordered = sorted(set(rules), key=lambda r: (-len(r.host + r.path), r.verdict != "allow", r.host + r.path))
    return rows.withColumn("r", _in_place(ordered, F.col("host"), F.col("path"))).select(*rows.columns, "r.rule", "r.verdict")


# ---- the operator


def judge(pages: DataFrame, rules: list[Rule] | DataFrame, redirects: DataFrame | None = None, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, host, path, rule, verdict, alias) of every page; alias says that its verdict comes from an alias.

    redirects, if given, has columns from_url and to_url.
    """
    own = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), links_in(F.col(html_col)).alias("links"))
    parsed = own.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), node_of(F.col("url")).alias("node"), F.transform("links", lambda x: node_of(resolve(F.col("url"), x))).alias("targets"))
    judged = materialise(with_rule(parsed, rules), "judged_pages")
    edges = judged.select(F.col("node").alias("u"), F.explode("targets").alias("v"))
    if redirects is not None:
        edges = edges.unionByName(redirects.select(node_of(F.col("from_url")).alias("u"), node_of(F.col("to_url")).alias("v")))
    nodes = with_rule(connected_components(edges).select("node", "component", host_of(F.col("node")).alias("host"), path_of(F.col("node")).alias("path")), rules)
    nodes = materialise(nodes.select("node", "component", "verdict"), "nodes")
    blocked = nodes.groupBy("component").agg(F.count(F.lit(1)).alias("size"), F.bool_or(F.col("verdict") == "block").alias("blocked")).where("blocked").select("component", "size")
    aliases = join_large(nodes, blocked, ["component"], nodes.count()).select("node")
    pages_of = judged.where("verdict is null and node is not null").groupBy("node").agg(F.count(F.lit(1)).alias("size"))
    met = left_join_large(judged, pages_of.join(aliases, "node"), ["node"], judged.count())
    alias = F.col("verdict").isNull() & F.col("size").isNotNull()
    return met.select("page_id", "host", "path", "rule", F.coalesce("verdict", F.when(alias, "block").otherwise("allow")).alias("verdict"), alias.alias("alias"))
