import random
from collections import Counter

import duckdb

from tabprep.llm.components import connected_components
from tabprep.llm.url_filter import judge_urls, page_links
from tabprep.llm.url_queries import ORACLES, op1_url_filter
from tests import oracle

PAGES = "page_id long, url string, html string, host string"


def verdicts(spark, rows):
    pages = spark.createDataFrame([(i, u, h, "x") for i, u, h in rows], PAGES)
    found = judge_urls(pages.drop("html"), page_links(pages)).collect()
    return sorted((r["page_id"], r["rule"], r["verdict"]) for r in found)


def test_longest_rule_wins_and_subdomains_count(spark):
    assert verdicts(
        spark,
        [
            (1, "http://A.example.ORG/es/x?q", None),
            (2, "https://example.org/en/12#t", ""),
            (3, "https://badexample.org/en/12", ""),
            (4, "https://x.com/de/", ""),
            (5, "https://com", ""),
        ],
    ) == [
        (1, "example.org/es/", "block"),
        (2, "example.org/en/1", "block"),
        (3, "org/", "allow"),
        (4, "com/de/", "block"),
        (5, None, "allow"),
    ]


def test_blocks_reach_aliases_unless_one_is_allowed(spark):
    canonical = '<LINK href="http://x.com/de/1" rel=canonical>'
    refresh = '<meta http-equiv="refresh" content="0; url=http://mirror.net/a/">'
    both = '<link rel="canonical" href="http://x.com/fr/1">'
    assert verdicts(
        spark,
        [
            (1, "http://mirror.net/a/", canonical),
            (2, "http://start.net/b", refresh),
            (3, "http://free.net/c", canonical.replace("/1", "/2")),
            (4, "http://free.net/c#top", both),
            (5, "http://lone.net/", ""),
            (5, "http://lone.net/", ""),
        ],
    ) == [
        (1, None, "block"),
        (2, None, "block"),
        (3, None, "allow"),
        (4, None, "allow"),
        (5, None, "allow"),
        (5, None, "allow"),
    ]


def test_relative_targets_and_rel_tokens(spark):
    rows = {
        "story.html": "http://h.net/a/story.html", "../b": "http://h.net/b", "?page=1": "http://h.net/a/x?page=1",
        "./": "http://h.net/a/", "..": "http://h.net/", "../../../c/./d?q=/../1": "http://h.net/c/d?q=/../1", "/e/../f": "http://h.net/f",
        "//o.net/g": "http://o.net/g", "https://o.net/h": "https://o.net/h", "mailto:x": None,
    }
    html = {k: f"<link rel='nofollow canonical' href='{k}'>" for k in rows}
    pages = spark.createDataFrame([("http://h.net/a/x?z=1", h) for h in html.values()], "url string, html string")
    assert sorted(r["target"] for r in page_links(pages).collect()) == sorted(t for t in rows.values() if t)
    other = spark.createDataFrame([("http://h.net", "<link rel=canonical href=i><link rel='not-canonical' href=j>")], "url string, html string")
    assert [r["target"] for r in page_links(other).collect()] == ["http://h.net/i"]


def test_only_edges_join_urls_that_differ_in_query(spark):
    blocked = '<link rel="canonical" href="http://x.com/de/1">'
    rows = [(1, "http://h.net/view?id=1", blocked), (2, "http://h.net/view?id=2", ""), (3, "HTTP://H.net/view?id=1#t", ""), (4, "http://h.net/view", "<link rel=canonical href='?id=1'>")]
    rows += [(5, "https://h.net/view?id=1", ""), (6, "http://h.net/view/?id=1", "")]
    want = [(1, None, "block"), (2, None, "allow"), (3, None, "block"), (4, None, "block"), (5, None, "allow"), (6, None, "allow")]
    assert verdicts(spark, rows) == want


def test_only_markup_counts_and_only_immediate_redirects(spark):
    block = '<link rel="canonical" href="http://x.com/de/1">'
    refresh = '<meta content="{}; url=http://x.com/de/1" http-equiv=refresh>'
    rows = [
        (1, "http://a.net/1", f"<!-- {block} -->"), (2, "http://a.net/2", f"<script>'{block}'</script>"), (3, "http://a.net/3", f"<noscript>{refresh.format(0)}</noscript>"),
        (4, "http://a.net/4", refresh.format(5)), (5, "http://a.net/5", refresh.format("0")), (6, "http://a.net/6", refresh.format("0.0")),
        (7, "http://a.net/7", "<base href='//x.com/de/'><link rel=canonical href=9>"), (8, "http://a.net/8", f"<!-- -->{block}<!--"),
    ]
    assert [v for *_, v in verdicts(spark, rows)] == ["allow"] * 4 + ["block"] * 4


def test_pattern_listed_twice_keeps_its_first_action(spark):
    pages = spark.createDataFrame([(1, "http://a.net/x/1")], "page_id long, url string")
    links = spark.createDataFrame([], "url string, target string")
    for rules, want in (([("block", "net/x/"), ("allow", "net/x/")], "block"), ([("allow", "net/x/"), ("block", "net/x/"), ("block", "net/")], "allow")):
        assert judge_urls(pages, links, rules).first()["verdict"] == want


def test_query_equals_its_sql_where_pages_have_links(spark, root):
    rng = random.Random(6)
    hosts = ["x.com", "A.example.org", *(f"h{k}.net" for k in range(90)), "www.y.com"]
    paths = ["/de/1", "/fr/2", "/es/a", "/en/1x", "/a/b/c.html", "/", "", "/a?q=1", "/b/#t", "/v?id=2"]
    fixed = ["../d", "c.html", "?q=1", "#x", "/de/1", "/es/../fr/2", "./", "..", "mailto:x", "/a&amp;b"]
    rows = []
    for k in range(400):
        hrefs = [*fixed, f"//h{k % 90}.net/a/b/c.html", f"http://x.com/de/{k}", f"http://x.com/fr/{k}", f"https://h{k % 7}.net/v?id=2"]
        url = rng.choice(["http", "https"]) + "://" + rng.choice(hosts) + rng.choice(paths) if k % 40 else rng.choice([None, "", "no url"])
        tags = []
        for _ in range(rng.choice([0, 0, 1, 1, 2])):
            href, kind = rng.choice(hrefs), rng.randrange(7)
            link = [f'<link rel="canonical" href="{href}">', f"<LINK href='{href}' rel='me canonical'>", f"<link rel=not-canonical href={href}>"]
            meta = [f'<meta http-equiv="Refresh" content="0;URL={href}">', f'<meta http-equiv=refresh content="9; url={href}">']
            tags.append([*link, *meta, f"<!-- {link[0]} -->", f"<script>{link[0]}</script>"][kind])
        base = f'<base href="{rng.choice(hrefs)}">' if k % 5 == 0 else ""
        rows.append((k, url, None if k % 50 == 1 else f"<head>{base}{''.join(tags)}</head><p>x"))
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(f"{root}/pages.parquet")
    df = op1_url_filter(spark, root)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{root}/pages.parquet/*.parquet')")
    assert page_links(spark.read.parquet(f"{root}/pages.parquet")).count() > 120
    assert oracle.differences(df, con, ORACLES["op1_url_filter"]) == []
    verdicts_by = Counter((r["rule"], r["verdict"]) for r in df.collect())
    assert verdicts_by[None, "block"] > 5 and verdicts_by[None, "allow"] > 5


def test_very_long_page_and_url(spark):
    url = "http://a.net/" + "p" * 100_000
    html = "<p>" * 400_000 + '<link rel="canonical" href="http://x.com/de/1">' + "<!--" * 100_000
    assert verdicts(spark, [(1, url, html)]) == [(1, None, "block")]


def test_nulls_and_no_pages(spark):
    pages = spark.createDataFrame([(None, None, None), (2, "nothing", "")], "page_id long, url string, html string")
    found = judge_urls(pages.drop("html"), page_links(pages)).collect()
    assert {(r["host"], r["path"], r["rule"], r["verdict"]) for r in found} == {("", "", None, "allow")}
    assert judge_urls(pages.drop("html").limit(0), page_links(pages.limit(0))).count() == 0


def test_components_of_a_path_a_star_and_loops(spark):
    edges = [(k, k + 1) for k in range(1, 40)] + [(100, k) for k in range(101, 160)] + [(7, 7), (None, 3), (500, 501), (501, 500)]
    found = {r["node"]: r["label"] for r in connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert found == {k: 1 for k in range(1, 41)} | {k: 100 for k in range(100, 160)} | {500: 500, 501: 500}
    assert connected_components(spark.createDataFrame([], "u long, v long")).count() == 0
