"""The URL filter over ``pages``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tabprep.llm.common import UPPER, table
from tabprep.llm.url_filter import judge_urls, page_links


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    judged = judge_urls(pages.select("page_id", "url"), page_links(pages.select("url", "html")))
    return judged.select("page_id", "host", "path", "rule", "verdict")


_RULE = """CASE
    WHEN (h = 'example.org' OR h LIKE '%.example.org') AND starts_with(p, '/en/1') THEN 'example.org/en/1'
    WHEN (h = 'example.org' OR h LIKE '%.example.org') AND starts_with(p, '/es/') THEN 'example.org/es/'
    WHEN (h = 'com' OR h LIKE '%.com') AND starts_with(p, '/de/') THEN 'com/de/'
    WHEN (h = 'com' OR h LIKE '%.com') AND starts_with(p, '/fr/') THEN 'com/fr/'
    WHEN (h = 'org' OR h LIKE '%.org') AND starts_with(p, '/') THEN 'org/'
END"""

def _resolved(base: str, link: str) -> str:
    """SQL for a link as it stands on a page."""
    own = f"regexp_extract({base}, '(?s)^(.*?://[^/?#]*)', 1)"
    path = f"coalesce(regexp_extract({base}, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '')"
    given, rest = f"regexp_extract({link}, '(?s)^([^?#]*)', 1)", f"regexp_extract({link}, '(?s)^[^?#]*(.*)$', 1)"
    folder = f"CASE WHEN {path} = '' THEN '/' ELSE regexp_extract({path}, '(?s)^(.*/)', 1) END"

    def without_dots(text: str) -> str:
        parts = f"string_split({text}, '/')[2:]"
        step = "CASE x WHEN '.' THEN done WHEN '..' THEN regexp_replace(done, '/[^/]*$', '') ELSE done || '/' || x END"
        kept = f"list_reduce(list_concat([''], {parts}), lambda done, x: {step})"
        return f"CASE WHEN {kept} = '' THEN '/' WHEN ({parts})[-1] IN ('.', '..') THEN {kept} || '/' ELSE {kept} END"

    return f"""CASE WHEN regexp_matches({link}, '^[A-Za-z][A-Za-z0-9+.\\-]*://') THEN {link}
        WHEN starts_with({link}, '//') THEN 'http:' || {link}
        WHEN {own} = '' OR regexp_matches({link}, '^[A-Za-z][A-Za-z0-9+.\\-]*:') THEN NULL
        WHEN starts_with({link}, '#') THEN regexp_extract({base}, '(?s)^([^#]*)', 1) || {link}
        WHEN starts_with({link}, '?') THEN {own} || {path} || {link}
        WHEN starts_with({link}, '/') THEN {own} || ({without_dots(given)}) || {rest}
        ELSE {own} || ({without_dots(f"{folder} || {given}")}) || {rest} END"""


_LINK_OF = """replace(coalesce(nullif(regexp_extract(tag, '(?is)\\bhref\\s*=\\s*["'']?\\s*([^"''\\s>]+)', 1), ''),
        nullif(regexp_extract(tag, '(?is)\\burl\\s*=\\s*["'']?([^"''\\s>]+)', 1), '')), '&amp;', '&')"""

_SQL = f"""
WITH RECURSIVE clean AS (
    SELECT url, regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(html, '(?is)<!--.*?(?:-->|\\z)', ' ', 'g'),
        '(?is)<script\\b.*?(?:</script\\s*>|\\z)', ' ', 'g'), '(?is)<style\\b.*?(?:</style\\s*>|\\z)', ' ', 'g'),
        '(?is)<template\\b.*?(?:</template\\s*>|\\z)', ' ', 'g'), '(?is)<noscript\\b.*?(?:</noscript\\s*>|\\z)', ' ', 'g') AS html
    FROM pages WHERE regexp_matches(html, '(?i)\\bcanonical\\b|http-equiv')
), tags AS (
    SELECT url, regexp_extract(html, '(?is)<base\\b[^>]*>') AS base_tag,
        unnest(list_filter(regexp_extract_all(html, '(?is)<link\\b[^>]*>'), lambda t: regexp_matches(t,
               '(?i)\\srel\\s*=\\s*(?:"(?:[^"]*\\s)?canonical(?:\\s[^"]*)?"|''(?:[^'']*\\s)?canonical(?:\\s[^'']*)?''|canonical[\\s/>])'))
        || list_filter(regexp_extract_all(html, '(?is)<meta\\b[^>]*>'),
               lambda t: regexp_matches(t, '(?i)http-equiv\\s*=\\s*["'']?\\s*refresh\\b')
                   AND regexp_matches(t, '(?i)\\bcontent\\s*=\\s*["'']?\\s*0*(?:\\.0*)?\\s*[;,]'))) AS tag
    FROM clean
), read AS (
    SELECT url, {_LINK_OF} AS link, {_LINK_OF.replace("(tag,", "(base_tag,")} AS base FROM tags
), placed AS (
    SELECT url, link, coalesce(CASE WHEN base IS NOT NULL THEN {_resolved("url", "base")} END, url) AS page FROM read
), links AS (
    SELECT * FROM (SELECT url, {_resolved("page", "link")} AS target FROM placed) WHERE target IS NOT NULL
), urls AS (
    SELECT DISTINCT url FROM (SELECT url FROM pages UNION ALL SELECT url FROM links UNION ALL SELECT target FROM links)
), parts AS (
    SELECT url, translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS h,
        coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS p
    FROM urls
), ruled AS (
    SELECT url, h, p, {_RULE} AS rule, CASE WHEN h <> '' THEN translate(regexp_extract(url, '(?s)^(.*?://)', 1), '{UPPER}', '{UPPER.lower()}')
        || h || regexp_extract(url, '(?s)^.*?://[^/?#]*([^#]*)', 1) END AS node FROM parts
), judged AS (
    SELECT *, CASE WHEN rule IN ('org/', 'com/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block' END AS action FROM ruled
), edges AS (
    SELECT a.node AS u, b.node AS v FROM links l JOIN judged a ON a.url IS NOT DISTINCT FROM l.url
    JOIN judged b ON b.url = l.target WHERE a.node IS NOT NULL AND b.node IS NOT NULL
), sides AS (
    SELECT u, v FROM edges UNION SELECT v, u FROM edges
), reach AS (
    SELECT DISTINCT u AS node, u AS other FROM sides
    UNION SELECT r.node, s.v FROM reach r JOIN sides s ON s.u = r.other
), labels AS (
    SELECT node, min(other) AS label FROM reach GROUP BY node
), groups AS (
    SELECT coalesce(l.label, j.node) AS label, bool_or(action = 'block') AS blocks, bool_or(action = 'allow') AS allows
    FROM judged j LEFT JOIN labels l ON l.node = j.node WHERE j.node IS NOT NULL GROUP BY 1
)
SELECT p.page_id, j.h AS host, j.p AS path, j.rule,
    coalesce(j.action, CASE WHEN g.blocks AND NOT coalesce(g.allows, false) THEN 'block' ELSE 'allow' END) AS verdict
FROM pages p JOIN judged j ON j.url IS NOT DISTINCT FROM p.url
LEFT JOIN labels l ON l.node = j.node LEFT JOIN groups g ON g.label = coalesce(l.label, j.node)
"""

QUERIES = {"op1_url_filter": op1_url_filter}
ORACLES = {"op1_url_filter": _SQL}
