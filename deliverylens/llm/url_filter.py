"""URL filters: allow and block rules, carried over aliases, with DataFrame functions only.

A rule ``host/path`` fits the host and its subdomains if the URL's path begins
with ``/path``; the longest wins. URLs joined by redirects (meta refresh) or
canonical links are one another's aliases. A URL that no rule fits takes the
decision of its alias component: allow if any member has an explicit allow,
else block if any member is blocked, else allow.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .components import components

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _bound(value: Column, use) -> Column:
    """use(value), with the value worked out once."""
    return F.transform(F.array(value), use)[0]


def host_of(url: Column) -> Column:
    """After the first :// up to / ? # or the end, A-Z lower-cased; else empty."""
    return F.coalesce(F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """After the host up to ? # or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """The longest fitting rule as struct(size, allow, rule, verdict), else null; among rules of one length an allow comes first.

    The rules are a literal map by host, looked up by each suffix of the URL's
    host: the caller's list is held in the plan, so it must stay small (some
    thousands); the work a URL doesn't grow with it.
    """
    by_host: dict[str, list] = {}
    for rule, verdict in rules:
        name, slash, rest = rule.partition("/")
        by_host.setdefault(name.lower(), []).append(F.struct(F.lit(slash + rest).alias("path"), F.lit(len(rule)).alias("size"), F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict")))
    table = F.create_map(*[x for k, v in by_host.items() for x in (F.lit(k), F.array(*v))])
    parts = F.split(host, r"\.", -1)
    suffixes = F.transform(parts, lambda _, i: F.array_join(F.slice(parts, i + 1, F.size(parts) - i), "."))
    found = F.flatten(F.transform(suffixes, lambda s: F.coalesce(F.element_at(table, s), F.array().cast("array<struct<path:string,size:int,rule:string,verdict:string>>"))))
    fits = F.filter(found, lambda r: F.startswith(path, r["path"]))
    return F.array_max(F.transform(fits, lambda r: F.struct(r["size"].alias("size"), (r["verdict"] == "allow").alias("allow"), r["rule"].alias("rule"), r["verdict"].alias("verdict"))))


def node_of(url: Column) -> Column:
    """What names a URL among aliases: host, path and query, without scheme and fragment."""
    rest = F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^#]*)", 1)
    full = _bound(rest, lambda r: F.when(r == "", "/").otherwise(r))
    return _bound(host_of(url), lambda h: F.when(h != "", F.concat(h, full)))


def resolved(base: Column, link: Column) -> Column:
    """An absolute URL for a link found on the page ``base``."""
    return _bound(F.trim(F.replace(link, F.lit("&amp;"), F.lit("&"))), lambda x: _resolved(base, x))


def _resolved(base: Column, link: Column) -> Column:
    root = F.concat(F.lit("http://"), host_of(base))
    folder = F.regexp_extract(path_of(base), r"(?s)^(.*/)", 1)
    return (
        F.when(link.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), link)
        .when(F.startswith(link, F.lit("//")), F.concat(F.lit("http:"), link))
        .when(F.startswith(link, F.lit("/")), F.concat(root, link))
        .when(link.rlike(r"^[?#]") | (link == ""), F.concat(root, path_of(base), link))
        .when(link.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), F.lit(None))
        .otherwise(F.concat(root, F.when(folder == "", "/").otherwise(folder), link))
    )


def alias_edges(pages: DataFrame) -> DataFrame:
    """(a, b): URL nodes that a redirect or canonical link of a page joins.

    Comments are no markup. Only pages that name such a link are parsed.
    """
    told = pages.where(F.col("html").rlike("(?i)canonical|refresh")).select("url", F.regexp_replace("html", "(?s)<!--.*?-->", " ").alias("h"))
    tag = told.select("url", F.explode(F.regexp_extract_all("h", F.lit(r"(?is)<(?:link|meta)\b[^>]*>"), F.lit(0))).alias("t"))
    value = r"""\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""

    def attr(name: str) -> Column:
        return F.concat(*[F.regexp_extract("t", rf"(?is)\s{name}{value}", k) for k in (1, 2, 3)])

    canonical = F.col("t").rlike(r"(?is)^<link\b") & attr("rel").rlike(r"(?i)(^|\s)canonical(\s|$)")
    refresh = F.col("t").rlike(r"(?is)^<meta\b") & (F.lower(attr("http-equiv")) == "refresh")
    goal = F.regexp_extract(attr("content"), r"(?is)^\s*[0-9.]*\s*[;,]\s*url\s*=\s*['\"]?([^'\"]*)", 1)
    to = F.when(canonical, attr("href")).when(refresh, goal)
    found = tag.select("url", to.alias("to")).where("to IS NOT NULL AND to != ''")
    goal = _bound(resolved(F.col("url"), F.col("to")), node_of)
    return found.select(node_of(F.col("url")).alias("a"), goal.alias("b")).where("a IS NOT NULL AND b IS NOT NULL AND a != b").distinct()


def judge(pages: DataFrame, rules: Sequence[tuple[str, str]], redirects: DataFrame | None = None) -> DataFrame:
    """(page_id, host, path, rule, verdict, component) for every page.

    pages has page_id, url and html; ``redirects`` may add (source, target)
    URLs seen by a crawler. A null url or one without :// has an empty host and
    path, no rule and no aliases, and is allowed. Repeated pages keep their
    rows; an empty table gives an empty result. ``component`` is the least URL
    node of the page's aliases, null without any.
    """
    edges = alias_edges(pages.select("url", "html"))
    if redirects is not None:
        edges = edges.union(redirects.select(node_of(F.col("source")), node_of(F.col("target"))))
    comp = components(edges)
    at = F.concat(F.lit("http://"), F.col("node"))
    ruled = comp.select("node", "component", rule_of(host_of(at), path_of(at), rules)["verdict"].alias("v"))
    said = ruled.groupBy("component").agg(F.max(F.col("v") == "allow").alias("allow"), F.max(F.col("v") == "block").alias("block"))
    carried = comp.join(said, "component").select("node", "component", (F.coalesce("block", F.lit(False)) & ~F.coalesce("allow", F.lit(False))).alias("blocked"))
    own = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), node_of(F.col("url")).alias("node"))
    own = own.withColumn("r", rule_of(F.col("host"), F.col("path"), rules))
    # Pages without a node meet none; each has a key of its own (no node holds a #), so that they don't fill one partition.
    lone = F.concat(F.lit("#"), F.coalesce(F.col("page_id").cast("string"), F.lit("")))
    out = own.withColumn("node", F.coalesce("node", lone)).join(carried, "node", "left")
    verdict = F.coalesce(F.col("r.verdict"), F.when(F.col("blocked"), "block"), F.lit("allow"))
    return out.select("page_id", "host", "path", F.col("r.rule").alias("rule"), verdict.alias("verdict"), "component")


#: Rules of op1, in the form (host/path, verdict).
OP1_RULES = (("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"), ("net/es/", "block"), ("net/fr/", "block"))

#: The same in DuckDB, over pages: what op1 returns.
ORACLE_SQL = r"""
WITH RECURSIVE p AS (
  SELECT page_id, url, html, regexp_extract(coalesce(url, ''), '^(?s:.*?)://([^/?#]*)', 1) AS h0,
         regexp_extract(coalesce(url, ''), '^(?s:.*?)://[^/?#]*([^?#]*)', 1) AS path,
         regexp_extract(coalesce(url, ''), '^(?s:.*?)://[^/?#]*([^#]*)', 1) AS rest
  FROM pages
), q AS (
  SELECT page_id, url, html, translate(h0, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, path,
         CASE WHEN h0 <> '' THEN translate(h0, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') || CASE WHEN rest = '' THEN '/' ELSE rest END END AS node
  FROM p
), rules(rhost, rpath, rule, verdict) AS (
  VALUES ('com', '/', 'com/', 'allow'), ('example.com', '/en/', 'example.com/en/', 'block'), ('www.example.com', '/en/', 'www.example.com/en/', 'allow'),
         ('net', '/es/', 'net/es/', 'block'), ('net', '/fr/', 'net/fr/', 'block')
), tags AS (
  SELECT url, host, path, node, unnest(regexp_extract_all(regexp_replace(html, '<!--(?s:.*?)-->', ' ', 'g'), '(?i)<(?:link|meta)\b[^>]*>')) AS t FROM q WHERE html IS NOT NULL
), links AS (
  SELECT host, path, node, trim(replace(CASE
    WHEN regexp_matches(t, '(?i)^<link\b') AND regexp_matches(t, '(?i)\srel\s*=\s*["'']?(?:[^"''>]*\s)?canonical[\s"''>/]') THEN regexp_extract(t, '(?i)\shref\s*=\s*["'']?([^"''\s>]*)', 1)
    WHEN regexp_matches(t, '(?i)^<meta\b') AND regexp_matches(t, '(?i)\shttp-equiv\s*=\s*["'']?refresh["''\s>/]') THEN regexp_extract(t, '(?i)[;,]\s*url\s*=\s*["'']?([^"''>]*)', 1)
    ELSE '' END, '&amp;', '&')) AS l
  FROM tags
), goals AS (
  SELECT node AS a, CASE WHEN regexp_matches(l, '^[A-Za-z][A-Za-z0-9+.-]*://') THEN l WHEN l LIKE '//%' THEN 'http:' || l
    WHEN l LIKE '/%' THEN 'http://' || host || l WHEN regexp_matches(l, '^[?#]') THEN 'http://' || host || path || l
    WHEN regexp_matches(l, '^[A-Za-z][A-Za-z0-9+.-]*:') THEN NULL
    ELSE 'http://' || host || CASE WHEN path = '' THEN '/' ELSE regexp_extract(path, '^(?s:.*/)', 0) END || l END AS g
  FROM links WHERE l <> '' AND node IS NOT NULL
), edges AS (
  SELECT DISTINCT a, lower(regexp_extract(g, '^(?s:.*?)://([^/?#]*)', 1)) || CASE WHEN regexp_extract(g, '^(?s:.*?)://[^/?#]*([^#]*)', 1) = '' THEN '/' ELSE regexp_extract(g, '^(?s:.*?)://[^/?#]*([^#]*)', 1) END AS b
  FROM goals WHERE g IS NOT NULL AND regexp_extract(g, '^(?s:.*?)://([^/?#]*)', 1) <> ''
), both_ways AS (SELECT a, b FROM edges WHERE a <> b UNION SELECT b, a FROM edges WHERE a <> b),
reach(a, b) AS (SELECT a, a FROM both_ways UNION SELECT r.a, e.b FROM reach r JOIN both_ways e ON r.b = e.a),
node_rule AS (
  SELECT n.b, arg_max(r.verdict, length(r.rule)) AS verdict FROM (SELECT DISTINCT b FROM reach) n
  JOIN rules r ON (regexp_extract(n.b, '^[^/?#]*', 0) = r.rhost OR ends_with(regexp_extract(n.b, '^[^/?#]*', 0), '.' || r.rhost))
    AND starts_with(regexp_extract(n.b, '^[^/?#]*([^?#]*)', 1), r.rpath)
  GROUP BY n.b
), comp AS (
  SELECT reach.a, min(reach.b) AS component, coalesce(bool_or(v.verdict = 'block'), false) AND NOT coalesce(bool_or(v.verdict = 'allow'), false) AS blocked
  FROM reach LEFT JOIN node_rule v ON reach.b = v.b GROUP BY reach.a
), own AS (
  SELECT q.page_id, q.host, q.path, q.node, arg_max(r.rule, length(r.rule)) AS rule, arg_max(r.verdict, length(r.rule)) AS verdict
  FROM (SELECT row_number() OVER () AS i, * FROM q) q LEFT JOIN rules r ON (q.host = r.rhost OR ends_with(q.host, '.' || r.rhost)) AND starts_with(q.path, r.rpath)
  GROUP BY q.i, q.page_id, q.host, q.path, q.node
)
SELECT own.page_id, own.host, own.path, own.rule, coalesce(own.verdict, CASE WHEN comp.blocked THEN 'block' END, 'allow') AS verdict, comp.component
FROM own LEFT JOIN comp ON own.node = comp.a
"""
