"""URL rules with redirect equivalence.

A rule is a host and a path prefix (``example.org/es/``). It fits a URL of its
host or of a subdomain whose path starts with the rule's; the longest fitting
rule decides. A URL without a rule takes the decision of its aliases: pages
are nodes, redirects (meta refresh) and canonical links are edges, and a
connected component is one resource. In a component an explicit allow (of a
page or of a link target) goes before any block; a component without decision
is allowed. A page's own rule always stands.

Defined results: a null URL, or one without ``://``, has an empty host and path,
no rule and no alias, and is allowed; null or empty html has no links; repeated
rows give repeated results; an empty table gives an empty table; other columns
are not looked at. Links are taken from the whole html and resolved as RFC 3986,
section 5 says; a rule looks at a page's path as it is written, at an alias's path
without dot segments. ``SQL`` resolves relative links by prefixing only: it agrees where
no link has a dot segment, a query or a fragment alone, or a ``://`` after a relative start.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, whole_text, written
from .components import connected_components

# (verdict, rule) of the contract (fixed values)
RULES = (("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"),
         ("allow", "com/fr/"), ("block", "com/de/"))


def host(url: Column) -> Column:
    return ascii_lower(F.coalesce(F.regexp_extract(url, "://([^/?#]*)", 1), F.lit("")))


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(h: Column, p: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, allow before block on equal
    length; null without one. The rules are a configured list, not data."""
    ordered = sorted(rules, key=lambda r: (-len(r[1]), r[0], r[1]))
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for v, r in reversed(ordered):
        rhost, slash, rest = r.partition("/")
        fits = ((h == rhost) | h.endswith("." + rhost)) & p.startswith(slash + rest)
        rule = F.when(fits, F.lit(r)).otherwise(rule)
        verdict = F.when(fits, F.lit(v)).otherwise(verdict)
    return rule, verdict


def _no_dots(p: Column) -> Column:
    """A path without its ``.`` and ``..`` segments (RFC 3986, 5.2.4)."""
    parts = F.split(p, "/")
    kept = F.aggregate(F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 1, F.lit(0))), F.array().cast("array<string>"), lambda acc, x: (
        F.when(x == ".", acc).when(x == "..", F.slice(acc, F.lit(1), F.greatest(F.size(acc) - 1, F.lit(0))))
        .otherwise(F.concat(acc, F.array(x)))))
    folder = F.element_at(parts, -1).isin(".", "..")    # a last dot segment leaves its folder
    kept = F.when(folder, F.concat(kept, F.array(F.lit("")))).otherwise(kept)
    return F.when(p.contains("/."), F.concat(F.lit("/"), F.array_join(kept, "/"))).otherwise(p)


def node(url: Column) -> Column:
    """A URL as a graph node: scheme and host in lower case, no dot segments, no fragment; null without ``://``."""
    scheme = ascii_lower(F.regexp_extract(url, "^(.*?)://", 1))
    p, query = _no_dots(path(url)), F.regexp_extract(url, "://[^?#]*(\\?[^#]*)", 1)
    return F.when(url.contains("://"), F.concat(scheme, F.lit("://"), host(url), F.when(p == "", F.lit("/")).otherwise(p), query))


def _resolved(base: Column, href: Column) -> Column:
    """Absolute form of ``href`` found on the page ``base`` (RFC 3986, 5.2; ``node`` takes out dot segments and fragment).
    An absolute one of a scheme without ``//`` (``mailto:``) is no page: null."""
    scheme, origin = F.regexp_extract(base, "^(.*?)://", 1), F.regexp_extract(base, "^(.*?://[^/?#]*)", 1)
    page, query = path(base), F.regexp_extract(base, "://[^?#]*(\\?[^#]*)", 1)
    folder = F.regexp_replace(page, "[^/]*$", "")
    return (F.when(href.rlike("^[A-Za-z][A-Za-z0-9+.-]*://"), href)
            .when(href.rlike("^[A-Za-z][A-Za-z0-9+.-]*:"), F.lit(None))
            .when(href.startswith("//"), F.concat(scheme, F.lit(":"), href))
            .when(href.startswith("/"), F.concat(origin, href))
            .when(href.startswith("?"), F.concat(origin, page, href))
            .when(href.startswith("#"), F.concat(origin, page, query, href))
            .when(href != "", F.concat(origin, F.when(folder == "", F.lit("/")).otherwise(folder), href)))


def link_targets(html: Column) -> Column:
    """Array of the hrefs of canonical links and meta refreshes."""
    tags = F.regexp_extract_all(html, F.lit("(?is)<(?:link|meta)\\b[^>]*>"), F.lit(0))

    def target(tag: Column) -> Column:
        href = F.concat(*(F.regexp_extract(tag, "(?is)\\bhref\\s*=\\s*(?:\"([^\"]*)\"|'([^']*)'|([^\\s\"'>]+))", i) for i in (1, 2, 3)))
        refresh = F.regexp_extract(tag, "(?is)\\burl\\s*=\\s*['\"]?([^'\">\\s]+)", 1)
        return (F.when(tag.rlike("(?is)^<link\\b.*\\brel\\s*=\\s*[\"']?[^\"'>]*\\bcanonical\\b"), href)
                .when(tag.rlike("(?is)^<meta\\b.*\\bhttp-equiv\\s*=\\s*[\"']?refresh\\b"), refresh).otherwise(F.lit("")))

    found = F.array_remove(F.transform(tags, target), "")
    return F.transform(found, lambda x: F.trim(F.replace(x, F.lit("&amp;"), F.lit("&"))))


def alias_edges(pages: DataFrame) -> DataFrame:
    """(a, b): page node and link target node, distinct, without loops."""
    links = pages.select("url", F.explode(link_targets(whole_text(F.col("html")))).alias("href"))
    edges = links.select(node(F.col("url")).alias("a"), node(_resolved(F.col("url"), F.col("href"))).alias("b"))
    return edges.where("a is not null and b is not null and a <> b").distinct()


def alias_verdicts(pages: DataFrame, rules=RULES) -> DataFrame:
    """(node, alias_verdict) of the nodes in components with a decision."""
    comp = written(connected_components(alias_edges(pages)), "aliases")
    _, v = rule_of(host(F.col("node")), path(F.col("node")), rules)
    roots = (comp.groupBy("root").agg(F.bool_or(v == "allow").alias("allow"), F.bool_or(v == "block").alias("block"))
             .where("allow or block")
             .select("root", F.when(F.col("allow"), F.lit("allow")).otherwise(F.lit("block")).alias("alias_verdict")))
    return comp.join(written(roots, "alias-roots"), "root").select("node", "alias_verdict")


def judge_urls(pages: DataFrame, rules=RULES) -> DataFrame:
    """page_id, host, path, rule, verdict of every page."""
    aliases = written(alias_verdicts(pages, rules), "alias-verdicts")
    h, p = host(F.col("url")), path(F.col("url"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    judged = (pages.select("page_id", h.alias("host"), p.alias("path"), node(F.col("url")).alias("node"))
              .withColumn("rule", rule).withColumn("own", verdict))
    return (judged.join(aliases, "node", "left")
            .select("page_id", "host", "path", "rule",
                    F.coalesce("own", "alias_verdict", F.lit("allow")).alias("verdict")))


_HOST = "translate(coalesce(regexp_extract({u}, '://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_PATH = "coalesce(regexp_extract({u}, '://[^/?#]*([^?#]*)', 1), '')"


def _case(what) -> str:
    def fits(r):
        rhost, slash, rest = r.partition("/")
        return f"(host = '{rhost}' OR ends_with(host, '.{rhost}')) AND starts_with(path, '{slash + rest}')"
    ordered = sorted(RULES, key=lambda r: (-len(r[1]), r[0], r[1]))
    return "CASE " + " ".join(f"WHEN {fits(r)} THEN '{what(v, r)}'" for v, r in ordered) + " END"


_LOWER = "translate({x}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_SCHEME, _ORIGIN = "regexp_extract({u}, '^(.*?)://', 1)", "regexp_extract({u}, '^(.*?://[^/?#]*)', 1)"
_QUERY = "coalesce(regexp_extract({u}, '://[^?#]*(\\?[^#]*)', 1), '')"
# segment by segment; a last dot segment leaves its folder
_NO_DOTS = ("CASE WHEN contains({p}, '/.') THEN coalesce(nullif(list_reduce(list_concat([''], string_split({p}, '/')[2:]), lambda acc, x: "
            "CASE x WHEN '.' THEN acc WHEN '..' THEN regexp_replace(acc, '/[^/]*$', '') ELSE acc || '/' || x END) "
            "|| CASE WHEN string_split({p}, '/')[-1] IN ('.', '..') THEN '/' ELSE '' END, ''), '/') WHEN {p} = '' THEN '/' ELSE {p} END")
_NODE = ("CASE WHEN contains({u}, '://') THEN " + _LOWER.format(x=_SCHEME) + " || '://' || " + _HOST + " || "
         + _NO_DOTS.replace("{p}", _PATH) + " || " + _QUERY + " END")
SQL = f"""
WITH RECURSIVE tags AS (
  SELECT url, unnest(regexp_extract_all(coalesce(html, ''), '(?is)<(?:link|meta)\\b[^>]*>')) AS tag FROM pages
), hrefs AS (
  SELECT url, replace(CASE
    WHEN regexp_matches(tag, '(?is)^<link\\b.*\\brel\\s*=\\s*["'']?[^"''>]*\\bcanonical\\b')
      THEN concat(regexp_extract(tag, '(?is)\\bhref\\s*=\\s*(?:"([^"]*)"|''([^'']*)''|([^\\s"''>]+))', 1),
                  regexp_extract(tag, '(?is)\\bhref\\s*=\\s*(?:"([^"]*)"|''([^'']*)''|([^\\s"''>]+))', 2),
                  regexp_extract(tag, '(?is)\\bhref\\s*=\\s*(?:"([^"]*)"|''([^'']*)''|([^\\s"''>]+))', 3))
    WHEN regexp_matches(tag, '(?is)^<meta\\b.*\\bhttp-equiv\\s*=\\s*["'']?refresh\\b')
      THEN regexp_extract(tag, '(?is)\\burl\\s*=\\s*[''"]?([^''">\\s]+)', 1) ELSE '' END, '&amp;', '&') AS href FROM tags
), targets AS (
  SELECT url, CASE WHEN regexp_matches(href, '^[A-Za-z][A-Za-z0-9+.-]*://') THEN href
    WHEN regexp_matches(href, '^[A-Za-z][A-Za-z0-9+.-]*:') THEN NULL
    WHEN starts_with(href, '//') THEN {_SCHEME.format(u='url')} || ':' || href
    WHEN starts_with(href, '/') THEN {_ORIGIN.format(u='url')} || href
    WHEN starts_with(href, '?') THEN {_ORIGIN.format(u='url')} || {_PATH.format(u='url')} || href
    WHEN starts_with(href, '#') THEN {_ORIGIN.format(u='url')} || {_PATH.format(u='url')} || {_QUERY.format(u='url')} || href
    ELSE {_ORIGIN.format(u='url')} || CASE regexp_replace({_PATH.format(u='url')}, '[^/]*$', '') WHEN '' THEN '/'
         ELSE regexp_replace({_PATH.format(u='url')}, '[^/]*$', '') END || href END AS target
  FROM hrefs WHERE href <> ''
), pairs AS (
  SELECT DISTINCT {_NODE.format(u='url')} AS a, {_NODE.format(u='target')} AS b FROM targets
), edges AS (
  SELECT a, b FROM pairs WHERE a <> b UNION SELECT b, a FROM pairs WHERE a <> b
), reach AS (
  SELECT a AS node, a AS seen FROM edges
  UNION SELECT r.node, e.b FROM reach r JOIN edges e ON e.a = r.seen
), seen AS (
  SELECT node, {_HOST.format(u='seen')} AS host, {_PATH.format(u='seen')} AS path FROM reach
), alias AS (
  SELECT node, CASE WHEN bool_or(v = 'allow') THEN 'allow' WHEN bool_or(v = 'block') THEN 'block' END AS alias_verdict
  FROM (SELECT node, {_case(lambda v, r: v)} AS v FROM seen) GROUP BY node
), p AS (
  SELECT page_id, {_NODE.format(u='url')} AS node, {_HOST.format(u='url')} AS host, {_PATH.format(u='url')} AS path FROM pages
)
SELECT page_id, host, path, {_case(lambda v, r: r)} AS rule,
       coalesce({_case(lambda v, r: v)}, alias_verdict, 'allow') AS verdict
FROM p LEFT JOIN alias ON alias.node = p.node
"""
