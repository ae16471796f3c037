"""URL rules with redirect equivalence (dealt operator 2).

A page's own rule (host and subdomains, path prefix, longest wins) decides first. Pages
without one take the decision of their aliases: urls joined by canonical links and redirects
form groups (distributed connected components), a rule on any alias counts for the group, and
an explicit allow in the group goes before a block. Pages that neither have.

A url's node is its text without scheme, fragment and ``utm_`` parameters, its host in lower
case; so such spellings of one address are one alias without an edge.
"""

from __future__ import annotations

from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, let
from .components import connected_components

_HREF = r"""(?is)\b%s\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""


def lower_ascii(c: Column) -> Column:
    return F.translate(c, ascii_uppercase, ascii_lowercase)


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host and path as the contract has them; both empty without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    return (lower_ascii(F.regexp_extract(rest, r"^[^/?#]*", 0)),
            F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1))


def longest_rule(host: Column, path: Column, rules: list[tuple[str, str]]) -> Column:
    """Struct (verdict, rule) of the longest rule that fits, else null; of rules of one length
    an allow wins. ``rules`` is a short list of (verdict, host/path) given by the caller."""
    fits = None
    for verdict, rule in sorted(rules, key=lambda r: (-len(r[1]), r[0] != "allow", r[1])):
        name, _, tail = rule.partition("/")
        hit = ((host == name) | host.endswith("." + name)) & path.startswith("/" + tail)
        value = F.struct(F.lit(verdict).alias("verdict"), F.lit(rule).alias("rule"))
        fits = F.when(hit, value) if fits is None else fits.when(hit, value)
    return fits if fits is not None else F.lit(None).cast("struct<verdict:string,rule:string>")


def url_node(url: Column, host: Column, path: Column) -> Column:
    """Alias key of a url with its parts; null stays null, and a text without ``://`` is its own key."""
    query = F.regexp_extract(url, r"^[^?#]*(\?[^#]*)", 1)
    query = F.regexp_replace(query, r"([?&])utm_[^&]*(?=&|$)", "$1")
    query = F.regexp_replace(F.regexp_replace(F.regexp_replace(query, "&{2,}", "&"), r"\?&", "?"), "[?&]$", "")
    return F.when(F.instr(url, "://") > 0, F.concat(host, path, query)).otherwise(url)


def _attribute(tag: Column, name: str) -> Column:
    found = [F.nullif(F.regexp_extract(tag, _HREF % name, g), F.lit("")) for g in (1, 2, 3)]
    return F.coalesce(*found)


def _absolute(link: Column, base: Column) -> Column:
    """A link resolved against its page's url (absolute, ``//host``, ``/path`` or relative)."""
    link = F.trim(F.replace(link, F.lit("&amp;"), F.lit("&")))
    scheme = F.regexp_extract(base, r"^(.*?)://", 1)
    root = F.regexp_extract(base, r"^.*?://[^/?#]*", 0)
    folder = F.regexp_extract(base, r"^(.*?://[^/?#]*(?:/[^?#/]*(?=/))*)", 1)
    return (F.when(link.rlike("^[A-Za-z][A-Za-z0-9+.-]*://"), link)
            .when(link.startswith("//"), F.concat(scheme, F.lit(":"), link))
            .when(link.startswith("/"), F.concat(root, link))
            .when(link.rlike("^[?#]") | (link == "") | link.rlike("^[A-Za-z][A-Za-z0-9+.-]*:"), F.lit(None))
            .otherwise(F.concat(folder, F.lit("/"), link)))


def alias_links(pages: DataFrame, url_col: str, html_col: str) -> DataFrame:
    """``url, target``: canonical links and meta-refresh redirects in the whole html. Links are found and
    resolved as elements of arrays, so that no filter copies their expressions into itself."""
    tags = F.regexp_extract_all(F.col("html"), F.lit(r"(?is)<(?:link|meta)\b[^>]*>"), F.lit(0))

    def link(tag):
        canonical = F.when(F.array_contains(F.split(F.lower(_attribute(tag, "rel")), r"\s+"), "canonical"), _attribute(tag, "href"))
        refresh = F.when(F.lower(_attribute(tag, "http-equiv")) == "refresh",
                         F.nullif(F.regexp_extract(_attribute(tag, "content"),
                                                   r"(?is)^\s*[0-9.]*\s*[;,]?\s*url\s*=\s*['\"]?([^'\"]+)", 1), F.lit("")))
        return F.coalesce(canonical, refresh)

    links = F.filter(F.transform(tags, link), lambda x: x.isNotNull())
    targets = F.filter(F.transform(links, lambda x: _absolute(x, F.col("url"))), lambda x: x.isNotNull())
    rows = pages.select(F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    return rows.where("url is not null and html is not null").select("url", F.explode(targets).alias("target"))


def _node_and_rule(url: Column, rules: list[tuple[str, str]]) -> Column:
    """Struct (node, verdict) of a url."""
    return let(F.struct(*[c.alias(n) for c, n in zip(url_parts(url), ("host", "path"))]), lambda part: F.struct(
        url_node(url, part["host"], part["path"]).alias("node"),
        longest_rule(part["host"], part["path"], rules)["verdict"].alias("verdict")))


def judge_urls(pages: DataFrame, rules: list[tuple[str, str]], id_col: str = "page_id", url_col: str = "url",
               html_col: str = "html", edges: DataFrame | None = None) -> DataFrame:
    """``page_id, host, path, rule, verdict, alias_verdict`` for each row.

    ``edges`` (url, target) adds redirects known from elsewhere, such as a crawl log. A null
    url, or one without ``://``, has empty host and path; null urls have no aliases. Null ids
    and repeated rows pass through, each judged alone; an empty table gives no rows. A very long
    html is searched whole, in its row's task. Of rules of one length an allow wins. Other
    columns, also such that are called like the result's, are not read."""
    scratch = Scratch(pages.sparkSession, "urlrules")
    links = alias_links(pages, url_col, html_col)
    if edges is not None:
        links = links.unionByName(edges.select("url", "target"))
    ends = links.select(F.explode(F.array(F.struct(_node_and_rule(F.col("url"), rules).alias("a"),
                                                   _node_and_rule(F.col("target"), rules).alias("b")))).alias("e"))
    links = scratch.save(ends.select(F.col("e.a.node").alias("a"), F.col("e.b.node").alias("b"), F.col("e.a.verdict").alias("va"),
                                     F.col("e.b.verdict").alias("vb")).distinct(), "links")
    groups = connected_components(links, "a", "b", scratch)
    ruled = links.select(F.explode(F.array(F.struct(F.col("a").alias("node"), F.col("va").alias("verdict")),
                                           F.struct(F.col("b").alias("node"), F.col("vb").alias("verdict")))).alias("r"))
    ruled = ruled.select("r.*").where("verdict is not null").distinct()
    # an allow on any alias goes before a block
    decided = scratch.save(ruled.join(groups, "node").groupBy("component").agg(F.min("verdict").alias("alias_verdict")),
                           "decided")
    verdicts = scratch.save(groups.join(decided, "component").select("node", "alias_verdict"), "verdicts")
    host, path = url_parts(F.col("url"))
    out = (pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"))
           .select("page_id", "url", host.alias("host"), path.alias("path"))
           .withColumn("node", url_node(F.col("url"), F.col("host"), F.col("path")))
           .withColumn("own", longest_rule(F.col("host"), F.col("path"), rules)))
    return out.join(verdicts, "node", "left").select(
        "page_id", "host", "path", F.col("own.rule").alias("rule"),
        F.coalesce("own.verdict", "alias_verdict", F.lit("allow")).alias("verdict"), "alias_verdict")
