"""URL rules whose block decisions reach every alias of a page. DataFrame functions only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabprep.llm.common import free_names, lower_ascii
from tabprep.llm.components import connected_components

#: Action and pattern; a pattern is a host, then a path that starts with a slash.
RULES = (
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
)

_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
_LINK = r"(?is)<link\b[^>]*>"
_META = r"(?is)<meta\b[^>]*>"
_BASE = r"(?is)<base\b[^>]*>"
#: What stands inside is no markup.
_NO_MARKUP = r"(?is)<!--.*?(?:-->|\z)|<(script|style|template|noscript)\b.*?(?:</\1\s*>|\z)"
_CANONICAL = r"(?i)\srel\s*=\s*(?:\"(?:[^\"]*\s)?canonical(?:\s[^\"]*)?\"|'(?:[^']*\s)?canonical(?:\s[^']*)?'|canonical(?=[\s/>]))"
_REFRESH = r"(?i)http-equiv\s*=\s*[\"']?\s*refresh\b"
#: A refresh after no time is a redirect.
_AT_ONCE = r"(?i)\bcontent\s*=\s*[\"']?\s*0*(?:\.0*)?\s*[;,]"
_HREF = r"(?is)\bhref\s*=\s*[\"']?\s*([^\"'\s>]+)"
_URL = r"(?is)\burl\s*=\s*[\"']?([^\"'\s>]+)"


def host_of(url: Column) -> Column:
    """Text between the first ``://`` and the next ``/``, ``?`` or ``#``; else empty."""
    return lower_ascii(F.coalesce(F.regexp_extract(url, _PARTS, 1), F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _PARTS, 2), F.lit(""))


def _fits(host: Column, path: Column, pattern: str) -> Column:
    domain, slash, rest = pattern.partition("/")
    return F.concat(F.lit("."), host).endswith("." + domain) & path.startswith(slash + rest)


def match_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """Pattern of the longest fitting rule, null if none fits; of equal ones the first listed."""
    ordered = sorted(rules, key=lambda r: -len(r[1]))
    return F.coalesce(*[F.when(_fits(host, path, text), F.lit(text)) for _, text in ordered])


def action_of(rule: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """``allow`` or ``block`` for a pattern, null for none. A pattern listed twice keeps its first action."""
    verbs = {text: verb for verb, text in reversed(rules)}
    names = {v: [t for t in verbs if verbs[t] == v] for v in ("block", "allow")}
    return F.when(rule.isin(names["block"]), "block").when(rule.isin(names["allow"]), "allow")


def alias_of(url: Column) -> Column:
    """The page a url names: the url with scheme and host in lower case and without its fragment. Null without a host."""
    front = F.regexp_extract(url, r"(?s)^(.*?://)", 1)
    rest = F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^#]*)", 1)
    return F.when(host_of(url) != "", F.concat(lower_ascii(front), host_of(url), rest))


def without_dots(path: Column) -> Column:
    """A path that starts with a slash, with its segments ``.`` and ``..`` carried out."""
    parts = F.slice(F.split(path, "/"), 2, 1 << 30)
    kept = F.aggregate(
        parts,
        F.array().cast("array<string>"),
        lambda done, x: F.when(x == ".", done)
        .when(x == "..", F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))))
        .otherwise(F.concat(done, F.array(x))),
    )
    closing = F.element_at(parts, -1).isin(".", "..") & (F.size(kept) > 0)
    return F.concat(F.lit("/"), F.array_join(kept, "/"), F.when(closing, "/").otherwise(""))


def resolved(base: Column, link: Column) -> Column:
    """``link`` as it stands on the page ``base``; null if the base has no host or the link another scheme."""
    own = F.regexp_extract(base, r"(?s)^(.*?://[^/?#]*)", 1)
    whole = F.regexp_extract(base, r"(?s)^([^#]*)", 1)
    path = path_of(base)
    rest = F.regexp_extract(link, r"(?s)^[^?#]*(.*)$", 1)
    given = F.regexp_extract(link, r"(?s)^([^?#]*)", 1)
    folder = F.when(path == "", "/").otherwise(F.regexp_extract(path, r"(?s)^(.*/)", 1))
    return (
        F.when(link.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*://"), link)
        .when(link.startswith("//"), F.concat(F.lit("http:"), link))
        .when((own == "") | link.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*:"), None)
        .when(link.startswith("#"), F.concat(whole, link))
        .when(link.startswith("?"), F.concat(own, path, link))
        .when(link.startswith("/"), F.concat(own, without_dots(given), rest))
        .otherwise(F.concat(own, without_dots(F.concat(folder, given)), rest))
    )


def _first(tag: Column, *patterns: str) -> Column:
    """What the first fitting pattern finds in a tag, with ampersands decoded; null if none fits."""
    found = F.coalesce(*[F.nullif(F.regexp_extract(tag, p, 1), F.lit("")) for p in patterns])
    return F.replace(found, F.lit("&amp;"), F.lit("&"))


def _held(frame: DataFrame, name: str, value: Column) -> DataFrame:
    """``frame`` with a column that is computed once; a mere projection would be copied into each later use."""
    return frame.select(*[c for c in frame.columns if c != name], F.explode(F.array(value)).alias(name))


def page_links(pages: DataFrame) -> DataFrame:
    """(url, target) for the canonical links and immediate redirects that pages declare.

    Tags in comments, scripts, styles, templates and noscript elements do not count, nor does a refresh after
    some time. A target that is not absolute is resolved against the page's base element if it has
    one, else against its url.
    """
    marked = pages.where(F.col("html").rlike(r"(?i)\bcanonical\b|http-equiv")).select("url", "html")
    clean = _held(marked, "html", F.regexp_replace("html", _NO_MARKUP, " "))
    all_of = lambda pattern: F.regexp_extract_all(F.col("html"), F.lit(pattern), F.lit(0))
    tags = F.concat(
        F.filter(all_of(_LINK), lambda t: t.rlike(_CANONICAL)),
        F.filter(all_of(_META), lambda t: t.rlike(_REFRESH) & t.rlike(_AT_ONCE)),
    )
    base = _first(F.regexp_extract("html", _BASE, 0), _HREF).alias("base")
    found = clean.select("url", base, F.explode(tags).alias("tag"))
    found = _held(found, "link", _first(F.col("tag"), _HREF, _URL)).where("link is not null").drop("tag")
    on = F.coalesce(F.when(F.col("base").isNotNull(), resolved(F.col("url"), F.col("base"))), F.col("url"))
    found = _held(_held(found, "on", on).drop("base"), "target", resolved(F.col("on"), F.col("link")))
    return found.select("url", "target").where("target is not null")


def judge_urls(pages: DataFrame, links: DataFrame, rules: Sequence[tuple[str, str]] = RULES) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` and ``verdict`` of each row's ``url``.

    ``links(url, target)`` are redirects and canonical links. Urls are aliases if a chain of links
    joins the pages they name (``alias_of``), in either direction, and by nothing else. A page with a
    rule of its own gets that rule's action. Any other page is blocked if one of its aliases
    is blocked by a rule and none is allowed by one; else it is allowed.

    Null, empty or unparsable urls have an empty host, fit no rule, are no one's alias and are
    allowed. Repeated rows are judged alike and all returned; no pages give no rows. Columns
    of ``pages`` that bear a name of the result are renamed with closing underscores first.
    """
    for name in ("host", "path", "rule", "verdict"):
        if name in pages.columns:
            pages = pages.withColumnRenamed(name, free_names(pages, [name])[0])
    node, key, stop = free_names(pages, ["node", "key", "propagated"])

    def placed(frame: DataFrame, url: str) -> DataFrame:
        parts = frame.withColumn("host", host_of(F.col(url))).withColumn("path", path_of(F.col(url)))
        rule = match_rule(F.col("host"), F.col("path"), rules)
        return parts.withColumns({"rule": rule, node: alias_of(F.col(url))}).withColumn(
            "verdict", action_of(F.col("rule"), rules)
        )

    judged = placed(pages, "url")
    sources = placed(links.select("url"), "url")
    targets = placed(links.select(F.col("target").alias("url")), "url")
    edges = placed(placed(links, "url").select(F.col(node).alias("u"), "target"), "target").select(
        "u", F.col(node).alias("v")
    )
    labels = connected_components(edges)

    ruled = judged.select(node, "verdict").unionByName(sources.select(node, "verdict"))
    ruled = ruled.unionByName(targets.select(node, "verdict")).where(F.col("verdict").isNotNull())
    ruled = ruled.where(F.col(node).isNotNull()).distinct()
    blocked = (
        ruled.join(labels.withColumnRenamed("node", node), node, "left")
        .groupBy(F.coalesce("label", node).alias(key))
        .agg(F.max(F.col("verdict") == "block").alias("block"), F.max(F.col("verdict") == "allow").alias("allow"))
        .where("block and not allow")
        .select(key)
    )
    reached = labels.join(blocked.withColumnRenamed(key, "label"), "label").select(F.col("node").alias(node))
    stopped = blocked.select(F.col(key).alias(node)).unionByName(reached).distinct().withColumn(stop, F.lit(True))
    out = judged.join(stopped, node, "left")
    verdict = F.coalesce("verdict", F.when(F.col(stop), F.lit("block")).otherwise(F.lit("allow")))
    return out.withColumn("verdict", verdict).drop(node, stop)
