"""URL filters with redirect equivalence (operator 2).

Every url gets the verdict of the longest rule that fits it.  A url that no rule fits
takes the decision of its aliases: urls are nodes of a graph whose edges are canonical
links, redirects (meta refresh, or a given table of redirects) and spelling variants with the same normal form;
its connected components are found in Spark, and a component's decision is allow if
a rule allows one of its urls, else block if a rule blocks one, else ``default``.

Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; path: from
there up to ``?``, ``#`` or the end.  A declared target is unescaped and resolved against its
page's url (host root, folder, query or fragment alone, dot segments).  A rule (verdict, host, path) fits its host and all
subdomains where the path starts with the rule's; the longest ``host + path`` wins, ties
go to allow, then to the smaller text.  Rules are a short literal list, tested on each row.

Edge cases: a null url or one without ``://`` has empty host and path, is no node and gets the
default unless a rule fits the empty host; a null or empty html has no links; repeated rows are judged alike;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from ..operators.components import connected_components

#: fixed values: the rules of the query
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
DEFAULT = "allow"
#: host prefixes and query parameters that don't change a page, and endings of the same path
MIRRORS = "www|m|mobile|amp"
TRACKING = "utm_[a-z]+|ref|fbclid|gclid"
#: the basic HTML entities, by name and by number
ENTITIES = (
    (r"&(?:lt|LT|#0*60|#[xX]0*3[cC]);", "<"),
    (r"&(?:gt|GT|#0*62|#[xX]0*3[eE]);", ">"),
    (r"&(?:quot|QUOT|#0*34|#[xX]0*22);", '"'),
    (r"&(?:apos|#0*39|#[xX]0*27);", "'"),
    (r"&(?:sol|#0*47|#[xX]0*2[fF]);", "/"),
    (r"&(?:amp|AMP|#0*38|#[xX]0*26);", "&"),
)
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    host = F.regexp_extract(url, r"^(?s:.*?)://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"^(?s:.*?)://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """Struct (size, allow, rule) of the winning rule, or null."""
    found = []
    for verdict, h, p in rules:
        fits = ((host == h) | F.endswith(host, F.lit("." + h))) & F.startswith(path, F.lit(p))
        entry = F.struct(F.lit(len(h + p)).alias("size"), F.lit(verdict == "allow").alias("allow"), F.lit(h + p).alias("rule"))
        found.append(F.when(fits, entry))
    if not found:
        return F.lit(None).cast("struct<size:int,allow:boolean,rule:string>")
    # array_sort puts nulls last; ties: allow first, then the smaller text
    order = lambda a, b: (
        F.when(a.isNull() & b.isNull(), 0).when(a.isNull(), 1).when(b.isNull(), -1)
        .when(a["size"] != b["size"], b["size"] - a["size"])
        .when(a["allow"] != b["allow"], b["allow"].cast("int") - a["allow"].cast("int"))
        .when(a["rule"] < b["rule"], -1).when(a["rule"] > b["rule"], 1).otherwise(0)
    )
    return F.get(F.array_sort(F.array(*found), order), 0)


def without_dots(path: Column) -> Column:
    """``path`` (empty or from a slash on) with its ``.`` and ``..`` segments resolved."""
    parts = F.split(path, "/", -1)
    step = lambda done, x: (
        F.when(x == ".", done).when(x == "..", F.slice(done, 1, F.greatest(F.lit(1), F.size(done) - 1))).otherwise(F.array_append(done, x))
    )
    kept = F.aggregate(F.slice(parts, 2, F.size(parts)), F.array(F.lit("")), step)
    folder = F.when(F.element_at(parts, -1).isin(".", ".."), F.lit("/")).otherwise(F.lit(""))
    return F.when(path.rlike(r"/\.\.?(?:/|$)"), F.concat(F.array_join(kept, "/"), folder)).otherwise(path)


def normal_form(url: Column) -> Column:
    """The spelling that all variants of a url share; null where there is no ``://``."""
    host = F.regexp_replace(host_of(url), rf"^(?:{MIRRORS})\.", "")
    path = F.regexp_replace(without_dots(path_of(url)), r"(?:/index)?\.html?$|/+$", "")
    query = F.regexp_extract(url, r"^[^?#]*\?([^#]*)", 1)
    query = F.regexp_replace(F.regexp_replace(query, rf"(?:^|&)(?:{TRACKING})=[^&]*", ""), r"^&", "")
    return F.when(F.instr(url, "://") > 0, F.concat(host, path, F.when(query != "", F.concat(F.lit("?"), query)).otherwise(F.lit(""))))


def unescaped(text: Column) -> Column:
    """``text`` with the basic HTML entities replaced, the ampersand last."""
    for pattern, mark in ENTITIES:
        text = F.regexp_replace(text, pattern, mark)
    return text


def resolved(target: Column, source: Column) -> Column:
    """The absolute url of ``target`` on the page ``source``; null for another scheme than ``x://``
    and for a relative target on a source without a host."""
    base = F.regexp_extract(source, r"^([^/?#]*://[^/?#]*)", 1)
    path = F.regexp_extract(source, r"^[^/?#]*://[^/?#]*([^?#]*)", 1)
    folder = F.coalesce(F.nullif(F.regexp_extract(path, r"(?s)^(.*/)", 1), F.lit("")), F.lit("/"))
    url = (
        F.when(target.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), target)
        .when(target.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), F.lit(None).cast("string"))
        .when(base == "", F.lit(None).cast("string"))
        .when(F.startswith(target, F.lit("//")), F.concat(F.regexp_extract(source, r"^([^/?#]*:)//", 1), target))
        .when(F.startswith(target, F.lit("/")), F.concat(base, target))
        .when(F.startswith(target, F.lit("?")), F.concat(base, path, target))
        .when(F.startswith(target, F.lit("#")), F.concat(F.regexp_extract(source, r"^([^#]*)", 1), target))
        .otherwise(F.concat(base, folder, target))
    )
    piece = lambda i: F.regexp_extract(url, r"(?s)^([^/?#]*://[^/?#]*)([^?#]*)(.*)$", i)
    return F.concat(piece(1), without_dots(piece(2)), piece(3))


def links(pages: DataFrame) -> DataFrame:
    """(source, target): urls that ``pages`` declare canonical or refresh to."""
    attribute = r"""(?<![\w-]){}\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+))"""
    value = lambda tag, name: unescaped(F.concat(*[F.regexp_extract(tag, "(?i)" + attribute.format(name), i) for i in (1, 2, 3)]))
    tags = lambda pattern: F.regexp_extract_all("html", F.lit(pattern), F.lit(0))
    declared = F.filter(tags(r"(?i)<link\b[^>]*>"), lambda t: value(t, "rel").rlike(r"(?i)(?:^|\s)canonical(?:\s|$)"))
    canonical = F.transform(declared, lambda t: value(t, "href"))
    refresh = F.transform(
        tags(r"""(?i)<meta\b[^>]*\bhttp-equiv\s*=\s*["']?refresh\b[^>]*>"""),
        lambda t: F.regexp_extract(value(t, "content"), r"(?i)\burl\s*=\s*['\"]?([^'\"]*)", 1),
    )
    found = pages.filter(F.col("url").isNotNull()).select(F.col("url").alias("source"), F.explode(F.concat(canonical, refresh)).alias("to"))
    found = found.withColumn("to", F.regexp_replace("to", r"^\s+|\s+$", "")).filter("to != ''")
    return found.select("source", resolved(F.col("to"), F.col("source")).alias("target")).filter("target is not null")


def judge(pages: DataFrame, rules=RULES, redirects: DataFrame | None = None, default: str = DEFAULT) -> DataFrame:
    """(page_id, host, path, rule, verdict, alias_of): ``alias_of`` is the smallest normal form
    of the url's component.  ``redirects(source, target)`` adds edges."""
    found = links(pages)
    if redirects is not None:
        found = found.unionByName(redirects.select("source", "target"))
    found = materialize(found.distinct(), "url_links")
    edges = found.select(normal_form(F.col("source")).alias("a"), normal_form(F.col("target")).alias("b")).filter("a is not null and b is not null")
    roots = connected_components(edges).select(F.col("node").alias("at"), "root")
    urls = pages.select("page_id", "url")
    known = urls.select("url").unionByName(found.select(F.col("source").alias("url"))).unionByName(found.select(F.col("target").alias("url")))
    own = rule_of(host_of(F.col("url")), path_of(F.col("url")), rules)
    decided = known.select(normal_form(F.col("url")).alias("node"), own.alias("rule")).filter("node is not null and rule is not null")
    decided = decided.groupBy("node").agg(F.max(F.col("rule.allow").cast("int")).alias("allow"))
    nodes = known.select(normal_form(F.col("url")).alias("node")).filter("node is not null").distinct()
    placed = nodes.join(roots, F.col("node") == F.col("at"), "left").select("node", F.coalesce("root", "node").alias("root"))
    placed = materialize(placed.join(decided, "node", "left"), "url_nodes")
    verdicts = materialize(placed.groupBy("root").agg(F.max("allow").alias("alias_allow")), "url_components")
    aliases = materialize(placed.select("node", "root").join(verdicts, "root"), "url_aliases").select(F.col("node").alias("at"), "root", "alias_allow")
    judged = urls.withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url")), "node": normal_form(F.col("url"))})
    judged = judged.join(aliases, F.col("node") == F.col("at"), "left").withColumn("own", rule_of(F.col("host"), F.col("path"), rules))
    allowed = F.coalesce(F.col("own.allow"), F.col("alias_allow") == 1, F.lit(default == "allow"))
    return judged.select(
        "page_id", "host", "path", F.col("own.rule").alias("rule"), F.when(allowed, "allow").otherwise("block").alias("verdict"), F.col("root").alias("alias_of")
    )
