"""URL filters with redirect equivalence, in DataFrame functions only.

Rules (action, host and path) judge a URL: a rule fits its host and all
subdomains where the URL's path starts with the rule's path; the longest rule
wins. Redirects and canonical links make URLs aliases of each other:
connected components over these edges carry block decisions from a URL to its
aliases. Precedence: a URL's own rule; else an explicit allow of any alias;
else a block of any alias; else allow.

Edges come from the pages (``<link rel=canonical>``, ``<meta
http-equiv=refresh>``) and from an optional table of redirects; relative targets
are resolved against the page as RFC 3986 says. A URL is the same node whatever
its scheme, fragment, trailing slash, ``.`` and ``..`` segments or tracking
parameters are, and whatever the order of its parameters. URLs of one node are
aliases of each other once an edge touches the node, also one to itself (a page
that names its own address with a slash).

Defined cases: a null URL, or one without ``://``, has an empty host and path,
no rule and no aliases, and is allowed; a null page has no edges; repeated rows are judged alike; rules that are equally
long: the longer host, then allow before block; an empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regstar.llm.components import connected_components
from regstar.llm.shared import SharedTables, columns

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
TRACKING = r"^(?:utm_[a-z]+|ref|gclid|fbclid)(?:=|$)"
_CANONICAL = r"(?i)<link\b[^>]*\brel\s*=\s*[\"']?canonical\b[^>]*>"
_REFRESH = r"(?i)<meta\b[^>]*\bhttp-equiv\s*=\s*[\"']?refresh\b[^>]*>"
_HREF = r"(?i)\bhref\s*=\s*[\"']?([^\"'\s>]+)"
_GOTO = r"(?i)\burl\s*=\s*[\"']?([^\"'\s>]+)"


@dataclass(frozen=True)
class UrlRule:
    """``where`` is host and path in one, as ``example.com/en/``."""

    action: str
    where: str

    @property
    def host(self) -> str:
        return self.where.partition("/")[0]

    @property
    def path(self) -> str:
        return "".join(self.where.partition("/")[1:])


def host_of(url: Column) -> Column:
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_for(host: Column, path: Column, rules: tuple[UrlRule, ...]) -> Column:
    """Struct (rule, action) of the rule that decides, or null. Rules are a
    list kept by hand, tried longest first."""
    order = sorted(rules, key=lambda r: (-len(r.where), -len(r.host), r.action))
    chosen = F.lit(None).cast("struct<rule:string,action:string>")
    for rule in reversed(order):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        chosen = F.when(fits, F.struct(F.lit(rule.where).alias("rule"), F.lit(rule.action).alias("action"))).otherwise(chosen)
    return chosen


def node_of(url: Column) -> Column:
    """The URL as a node of the alias graph; null without ``://``."""
    host, path = host_of(url), F.regexp_replace(_without_dots(path_of(url)), "/+$", "")
    query = F.regexp_extract(url, r"(?s)^.*?://[^?#]*\?([^#]*)", 1)
    kept = F.array_sort(F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(TRACKING)))
    return F.when(
        F.contains(url, F.lit("://")), F.concat(host, path, F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise(F.lit("")))
    )


def _without_dots(path: Column) -> Column:
    """The path with its ``.`` and ``..`` segments carried out (but for a
    trailing slash, which a node never has)."""

    def step(kept: Column, part: Column) -> Column:
        up = F.slice(kept, 1, F.greatest(F.size(kept) - 1, F.lit(0)))
        return F.when(part == ".", kept).when(part == "..", up).otherwise(F.concat(kept, F.array(part)))

    parts = F.split(F.substring(path, 2, 1 << 30), "/")
    kept = F.aggregate(parts, F.array().cast("array<string>"), step)
    return F.when(path.rlike(r"/\.\.?(?:/|$)"), F.concat(F.lit("/"), F.array_join(kept, "/"))).otherwise(path)


def _absolute(target: Column, base: Column) -> Column:
    """``target`` as it is meant on the page ``base`` (RFC 3986, section 5.2)."""
    target = F.regexp_replace(F.trim(target), "&amp;", "&")
    scheme = F.regexp_extract(base, r"(?s)^(.*?):\/\/", 1)
    root = F.regexp_extract(base, r"(?s)^(.*?://[^/?#]*)", 1)
    page = F.regexp_extract(base, r"(?s)^([^#]*)", 1)
    folder = F.regexp_replace(path_of(base), "[^/]*$", "")
    return (
        F.when(target.rlike("^[A-Za-z][A-Za-z0-9+.-]*://"), target)
        .when(target.startswith("//"), F.concat(scheme, F.lit(":"), target))
        .when(target.startswith("/"), F.concat(root, target))
        .when(target.startswith("?"), F.concat(root, path_of(base), target))
        .when(target.startswith("#"), page)
        .otherwise(F.concat(root, F.when(folder == "", F.lit("/")).otherwise(folder), target))
    )


def page_edges(pages: DataFrame) -> DataFrame:
    """(a, b): nodes that ``pages`` (url, html) declare to be one resource."""
    some = pages.where(F.contains("url", F.lit("://"))).select("url", "html").where(
        F.col("html").rlike(_CANONICAL) | F.col("html").rlike(_REFRESH)
    )
    tags = F.concat(
        F.transform(
            F.regexp_extract_all("html", F.lit(_CANONICAL), F.lit(0)), lambda t: F.regexp_extract(t, _HREF, 1)
        ),
        F.transform(F.regexp_extract_all("html", F.lit(_REFRESH), F.lit(0)), lambda t: F.regexp_extract(t, _GOTO, 1)),
    )
    targets = some.select("url", F.explode(tags).alias("target")).where("target <> ''")
    return targets.select(node_of(F.col("url")).alias("a"), node_of(_absolute(F.col("target"), F.col("url"))).alias("b"))


def judge_urls(
    pages: DataFrame, rules: tuple[UrlRule, ...], *, redirects: DataFrame | None = None
) -> DataFrame:
    """(page_id, host, path, rule, verdict, component) for each row of
    ``pages`` (page_id, url, html). ``redirects``: (from_url, to_url).
    ``component`` is the smallest alias of a URL that has any, else null."""
    shared = SharedTables(pages.sparkSession, "url_filters")
    pages = columns(pages, "page_id", "url", "html")
    edges = page_edges(pages)
    if redirects is not None:
        edges = edges.unionByName(
            redirects.select(node_of(F.col("from_url")).alias("a"), node_of(F.col("to_url")).alias("b"))
        )
    edges = shared.put(edges, "edges")
    linked = connected_components(edges, shared)
    # An edge from a node to itself makes no link, but aliases of the node's URLs.
    own = edges.where("a = b").select(F.col("a").alias("node")).distinct().join(linked, "node", "left_anti")
    aliases = linked.unionByName(own.withColumn("component", F.col("node")))
    as_url = F.concat(F.lit("://"), F.col("node"))
    # The stripped trailing slash counts where a rule names a folder.
    with_slash = F.concat(path_of(as_url), F.lit("/"))
    decided = aliases.withColumn("own", rule_for(host_of(as_url), with_slash, rules)["action"])
    classes = shared.put(
        decided.groupBy("component").agg(
            F.coalesce(F.bool_or(F.col("own") == "allow"), F.lit(False)).alias("allow"),
            F.coalesce(F.bool_or(F.col("own") == "block"), F.lit(False)).alias("block"),
        ),
        "classes",
    )
    known = shared.put(aliases, "aliases").join(classes, "component").select(
        "node", "component", F.expr("block AND NOT allow").alias("blocked")
    )
    known = shared.put(known, "known")
    url = F.col("url")
    judged = pages.select(
        "page_id", host_of(url).alias("host"), path_of(url).alias("path"), node_of(url).alias("node")
    ).withColumn("chosen", rule_for(F.col("host"), F.col("path"), rules))
    by_alias = F.when(F.col("blocked"), F.lit("block")).otherwise(F.lit("allow"))
    return judged.join(known, "node", "left").select(
        "page_id", "host", "path", F.col("chosen.rule").alias("rule"),
        F.coalesce(F.col("chosen.action"), by_alias).alias("verdict"), "component",
    )
