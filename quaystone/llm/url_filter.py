"""URL filter: host and path rules, carried over redirects and canonical links.

A url that no rule fits is still the same page as the urls it redirects to, is
redirected from or names as canonical. These links are the edges of a graph whose
connected components are found by distributed star contractions; a block of any
member reaches all members, and an explicit allow of a url is stronger than a
block that only reaches it over links.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import payload, quoted, stage
from .components import components

UPPER, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BROADCAST_RULES = 200_000  # rule hosts that a broadcast may hold; more are joined by a shuffle

# what a browser doesn't read as tags, the tags that hold a link, and one attribute of a tag
_HIDDEN = r"(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>|<template\b.*?</template\s*>"
_TAGS = r"(?is)<(?:link|meta)\s[^>]*>"
_ATTR = r"""(?is)\s{name}\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""
_REFRESH = r"""(?is)^\s*[0-9.]*\s*[;,]\s*url\s*=\s*['"]?([^'"]*)"""
_ENTITIES = (("&quot;", '"'), ("&#34;", '"'), ("&#39;", "'"), ("&lt;", "<"), ("&gt;", ">"), ("&#38;", "&"), ("&amp;", "&"))


def lowered(text: Column) -> Column:
    return F.translate(text, UPPER, SMALL)


def host_of(url: Column) -> Column:
    """What stands between the first :// and the next /, ? or #, A-Z lower-cased; without :// empty."""
    return lowered(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    """What follows the host, up to ? or #; without :// empty."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def node_url(url: Column) -> Column:
    """The url as a node: without fragment, scheme and host lower-cased; null stays null."""
    bare = F.regexp_replace(url, r"(?s)#.*$", "")
    head = F.regexp_extract(bare, r"(?s)^(.*?://[^/?#]*)", 1)
    return F.concat(lowered(head), F.substring(bare, F.length(head) + 1, F.length(bare)))


def _attribute(tag: Column, name: str) -> Column:
    """An attribute's value; without the attribute empty."""
    pattern = _ATTR.replace("{name}", name)
    value = F.concat(*[F.regexp_extract(tag, pattern, k) for k in (1, 2, 3)])
    for entity, char in _ENTITIES:
        value = F.replace(value, F.lit(entity), F.lit(char))
    return F.trim(F.regexp_replace(value, r"[\x09-\x0D]", ""))


def _without_dots(path: Column) -> Column:
    """A path without its . and .. segments."""
    parts = F.split(path, "/")
    last = F.element_at(parts, -1)
    kept = F.aggregate(parts, F.array().cast("array<string>"), lambda acc, p: (
        F.when(p == "..", F.when(F.size(acc) > 1, F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(1)))).otherwise(acc))
        .when(p == ".", acc).otherwise(F.concat(acc, F.array(p)))))
    ended = F.when(last.isin(".", ".."), F.concat(kept, F.array(F.lit("")))).otherwise(kept)
    return F.when(F.size(F.filter(parts, lambda p: p.isin(".", ".."))) > 0, F.array_join(ended, "/")).otherwise(path)


def resolved(target: Column, base: Column) -> Column:
    """The http or https url that a link on the page ``base`` leads to; null when it leads to none."""
    scheme = F.regexp_extract(base, r"(?s)^(.*?)://", 1)
    site = F.regexp_extract(base, r"(?s)^(.*?://[^/?#]*)", 1)
    folder = F.regexp_extract(F.concat(F.when(path_of(base) == "", "/").otherwise(path_of(base))), r"(?s)^(.*/)", 1)
    tail = F.regexp_extract(target, r"(?s)^[^?#]*(.*)$", 1)
    path = F.regexp_extract(target, r"(?s)^([^?#]*)", 1)
    no_page = F.lit(None).cast("string")
    return (F.when(target.rlike(r"(?i)^https?://[^/?#]"), target)
            .when(target.rlike(r"(?i)^[a-z][a-z0-9+.-]*:"), no_page)
            .when((site == "") | (target == "") | target.startswith("#"), no_page)
            .when(target.startswith("//"), F.concat(scheme, F.lit(":"), target))
            .when(target.startswith("/"), F.concat(site, _without_dots(path), tail))
            .when(target.startswith("?"), F.concat(site, path_of(base), tail))
            .otherwise(F.concat(site, _without_dots(F.concat(folder, path)), tail)))


def page_links(pages: DataFrame, *, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(from_url, to_url): every page's canonical links and immediate or timed meta redirects to another url."""
    url, html = F.col(quoted(url_col)), F.col(quoted(html_col))
    some = pages.where(html.rlike("(?i)canonical|refresh") & url.isNotNull()).select(url.alias("u"), html.alias("body"))
    tags = some.select("u", F.explode(F.regexp_extract_all(F.regexp_replace("body", _HIDDEN, " "), F.lit(_TAGS), F.lit(0))).alias("tag"))
    tag = F.col("tag")
    is_link = tag.rlike(r"(?i)^<link") & F.array_contains(F.split(lowered(_attribute(tag, "rel")), r"\s+"), "canonical")
    is_meta = tag.rlike(r"(?i)^<meta") & (lowered(_attribute(tag, "http-equiv")) == "refresh")
    target = (F.when(is_link, _attribute(tag, "href"))
              .when(is_meta, F.trim(F.regexp_extract(_attribute(tag, "content"), _REFRESH, 1))))
    return (tags.select(F.col("u").alias("from_url"), target.alias("t")).where("t <> ''")
            .select("from_url", resolved(F.col("t"), F.col("from_url")).alias("to_url")).where("to_url is not null"))


def _hinted(df: DataFrame, n: int, limit: int) -> DataFrame:
    """Broadcast behind a counted bound."""
    return F.broadcast(df) if n <= limit else df


def judged(urls: DataFrame, rules: DataFrame, broadcast_rules: int = BROADCAST_RULES) -> DataFrame:
    """(key, rule, verdict) of the rows of ``urls`` (key, host, path) that a rule fits; the longest rule of each.

    A host's suffixes are looked up among the rule hosts, and of a fitting host's
    rules those whose path is a prefix of the url's: two equi-joins, whatever the
    number of rules. Rules of equal length and different verdict: allow.
    """
    ready = stage(rules.where("host is not null and verdict in ('allow', 'block')")
                  .select(lowered(F.col("host")).alias("rule_host"), F.coalesce("path", F.lit("")).alias("rule_path"), "verdict")
                  .groupBy("rule_host", "rule_path").agg(F.min("verdict").alias("verdict")))
    hosts = stage(ready.groupBy("rule_host").agg(F.array_sort(F.collect_set(F.length("rule_path"))).alias("lengths")))
    n_rules, labels = ready.agg(F.count(F.lit(1)), F.max(F.size(F.split("rule_host", r"\.")))).first()
    part = F.split("host", r"\.")
    # a suffix with more labels than any rule host can't be one
    suffixes = F.transform(F.sequence(F.lit(1), F.least(F.size(part), F.lit(labels or 1))),
                           lambda k: F.array_join(F.slice(part, -k, k), "."))
    tails = urls.select("key", "path", F.explode(suffixes).alias("rule_host"))
    tried = (tails.join(_hinted(hosts, n_rules, broadcast_rules), "rule_host")
             .select("key", "path", "rule_host", F.explode("lengths").alias("n")).where("n <= length(path)")
             .select("key", "rule_host", F.expr("substring(path, 1, n)").alias("rule_path")))
    fits = tried.join(_hinted(ready, n_rules, broadcast_rules), ["rule_host", "rule_path"])
    rule = F.concat("rule_host", "rule_path")
    best = F.max_by(F.struct(rule.alias("rule"), "verdict"), F.struct(F.length(rule), F.col("verdict") == "allow", rule))
    return fits.groupBy("key").agg(best.alias("best")).select("key", "best.rule", "best.verdict")


def filter_urls(pages: DataFrame, rules: DataFrame, *, redirects: DataFrame | None = None, url_col: str = "url",
                html_col: str | None = "html", keep: tuple[str, ...] = (), broadcast_rules: int = BROADCAST_RULES) -> DataFrame:
    """One row per page: host, path, rule, verdict, blocked_by and the ``keep`` columns.

    ``rules``: host, path and verdict (allow or block). A rule fits its host and
    all subdomains where the path starts with the rule's; the longest wins, allow
    before block. ``redirects``: more links, as (from_url, to_url). ``html_col=None``
    reads no html.

    verdict: that of the url's rule. Without a rule: block when a rule blocks any
    url of its component (also one that is no page), else allow. ``blocked_by`` is
    the least such rule, null for all others. Links to other schemes than http and
    https, to nowhere and to the page itself count for nothing, and so do tags in
    comments, scripts, styles and templates.

    A null url or one without :// has an empty host and path; a null url has no
    links. Rules without host or with another verdict are left out; a null path is
    empty. Pages alike stay as many rows. ``keep`` columns named like a result get
    the suffix ``_src``. An empty table gives an empty result.
    """
    names = ("host", "path", "rule", "verdict", "blocked_by")
    node = lambda url: F.unhex(F.sha2(node_url(url), 256))
    links = pages.sparkSession.createDataFrame([], "from_url string, to_url string")
    if html_col is not None:
        links = page_links(pages, url_col=url_col, html_col=html_col)
    if redirects is not None:
        links = links.unionByName(redirects.select("from_url", "to_url"))
    links = stage(links.where("from_url is not null and to_url is not null")
                  .select(node_url(F.col("from_url")).alias("x"), node_url(F.col("to_url")).alias("y")).where("x <> y").distinct())
    url = F.col(quoted(url_col))
    every = (pages.select(node_url(url).alias("u")).union(links.select("x")).union(links.select("y"))
             .where("u is not null").distinct())
    known = stage(judged(every.select(F.unhex(F.sha2("u", 256)).alias("key"), host_of(F.col("u")).alias("host"),
                                      path_of(F.col("u")).alias("path")), rules, broadcast_rules))
    member = components(links.select(F.unhex(F.sha2("x", 256)).alias("a"), F.unhex(F.sha2("y", 256)).alias("b")))
    blocked = stage(member.join(known.where("verdict = 'block'"), member["node"] == known["key"])
                    .groupBy("root").agg(F.min("rule").alias("blocked_by")))
    reached = stage(member.join(blocked, "root").select(F.col("node").alias("key"), "blocked_by"))
    # one row a url; a url with a third of all pages is split by the join, whose other side is written
    decided = stage(known.join(reached, "key", "full"))
    rows = pages.select(F.struct(*payload(pages, keep, names), F.lit(0).alias("_")).alias("extra"), host_of(url).alias("host"),
                        path_of(url).alias("path"), node(url).alias("key"))
    out = rows.join(decided, "key", "left")
    return out.select("host", "path", "rule", F.coalesce("verdict", F.when(F.col("blocked_by").isNotNull(), "block"), F.lit("allow")).alias("verdict"),
                      F.when(F.col("rule").isNull(), F.col("blocked_by")).alias("blocked_by"),
                      *[F.col(f"extra.{quoted(f)}") for f in rows.schema["extra"].dataType.names if f != "_"])
