import time
from html.parser import HTMLParser

import numpy as np

from tabprep.llm.html_blocks import ARTICLE, FRAME, OPEN, page_blocks
from tabprep.llm.html_main import extract_main_text, main_texts, repeated_tokens
from tabprep.llm.html_queries import op3_html_main_text

FRAMED = "<header>H</header><nav><ul><li>Menu</li></ul></nav>{}<footer>&copy; F</footer>"


def test_blocks_and_kinds():
    html = (
        "<!DOCTYPE html><head><title>T</title><style>p{}</style></head><body><!-- c <p>no</p> -->"
        '<div class="cookie-notice">we</div><article><header><h1>A &amp; b</h1></header>'
        "<p>x  <b>y</b>\n z<br>w</p><script>if (a<b) '</p>'</script>1 &lt;i&gt; 2"
        '<form>f</form><section id="comments"><p>c</p></section></article><div>o</div><aside>s'
    )
    assert page_blocks(html) == [
        ("we", FRAME), ("A & b", ARTICLE), ("x y z w", ARTICLE), ("1 <i> 2", ARTICLE), ("f", FRAME), ("c", FRAME),
        ("o", OPEN), ("s", FRAME),
    ]
    assert page_blocks(None) == page_blocks("") == page_blocks("<p></p><!-- open") == []
    assert page_blocks("a < b &am &amp") == [("a < b &am &", OPEN)]


def test_only_real_frame_marks_count():
    text = "<p>t</p>"
    for mark in (
        'style="overflow:hidden"', 'title="Hidden gems"', 'href="/hidden/"', 'data-x="display:none"', 'class="has-sidebar"',
        'class="no-sidebar"', 'class="content-with-menu"', 'class="post comments-open"', "class='a' data-hidden",
    ):
        assert page_blocks(f"<article {mark}>{text}</article>") == [("t", ARTICLE)], mark
        assert page_blocks(f"<div {mark}><article>{text}</article></div>") == [("t", ARTICLE)], mark
        assert page_blocks(f"<div {mark}>{text}</div>") == [("t", OPEN)], mark
    for mark in ("hidden", 'hidden=""', "style='color:red; display: none'", 'class="x sidebar"', 'id="site-header"', 'role=menu'):
        assert page_blocks(f"<div {mark}>{text}</div>") == [("t", FRAME)], mark
    assert page_blocks(f'<div class="post-header">{text}</div>') == [("t", OPEN)]
    assert page_blocks(f'<div class="sidebar">a<main>{text}</main>b</div>') == [("a", FRAME), ("t", ARTICLE), ("b", FRAME)]
    assert page_blocks(f"<aside>a<article>{text}</article></aside><div hidden><main>{text}</main></div>") == [
        ("a", FRAME), ("t", FRAME), ("t", FRAME),
    ]
    assert page_blocks(f'<main><div class="comments"><article>{text}</article></div></main>') == [("t", FRAME)]


def test_suffix_array_against_brute_force():
    rng = np.random.default_rng(0)
    streams = [rng.integers(0, 3, n) for n in (0, 5, 40, 60, 4)]
    for least in (1, 4, 8):
        grams = {}
        for k, s in enumerate(streams):
            for i in range(len(s) - least + 1):
                grams.setdefault(tuple(s[i : i + least]), set()).add(k)
        for k, (s, got) in enumerate(zip(streams, repeated_tokens(streams, range(5), least))):
            want = np.zeros(len(s), dtype=bool)
            for i in range(len(s) - least + 1):
                if len(grams[tuple(s[i : i + least])]) > 1:
                    want[i : i + least] = True
            assert (got == want).all()


def test_repeated_runs_go_and_unique_ones_stay():
    shared = "all pages of this host begin with these very words"
    pages = [page_blocks(f"<div>{shared}</div><p>{own} {shared}</p><p>{own}</p>") for own in ("one", "two", "one")]
    assert main_texts(pages) == ["one\none", "two\ntwo", "one\none"]
    assert main_texts([]) == [] and main_texts([[]]) == [""]


def story(k, n=30):
    return " ".join(f"word{k}x{j}" for j in range(n))


def test_article_is_evidence_only():
    legal = "all rights to this text stay with the house that printed it"
    pages = [page_blocks(f"<article><p>{story(k)}</p><p>{legal}</p></article><p>page{k} has words of its own</p>") for k in range(4)]
    assert main_texts(pages) == [f"{story(k)}\npage{k} has words of its own" for k in range(4)]
    # Two articles alone may share a passage, and a block that is shared in part stays whole.
    assert main_texts(pages[:2]) == [f"{story(k)}\n{legal}\npage{k} has words of its own" for k in range(2)]
    mixed = [page_blocks(f"<main><p>{story(k)}</p><p>{legal} and {k}</p></main>") for k in range(4)]
    assert main_texts(mixed) == [f"{story(k)}\n{legal} and {k}" for k in range(4)]
    # A run that goes on over the border of two blocks covers neither.
    first, second = "one two three four five", "six seven eight nine ten"
    split = [page_blocks(f"<article><p>{story(k)}</p><p>{first}</p><p>{second}</p></article>") for k in range(4)]
    assert main_texts(split) == [f"{story(k)}\n{first}\n{second}" for k in range(4)]


def test_copies_of_an_article_keep_their_text():
    body = "".join(f"<p>{story(k)}</p>" for k in range(5))
    frames = [f"<nav>menu number {k} of this site</nav><article><h1>A title</h1>{body}</article><footer>foot {k}</footer>" for k in range(6)]
    want = "\n".join(["A title", *map(story, range(5))])
    assert main_texts([page_blocks(f) for f in frames]) == [want] * 6
    views = [f"<article><h1>A title</h1><p>View number {k}</p>{body}</article>" for k in range(3)]
    assert main_texts([page_blocks(v) for v in views]) == [want.replace("title", f"title\nView number {k}") for k in range(3)]
    # Among many other articles of the host, a passage that few of them share stays as well.
    others = [f"<article><p>{story(100 + k)}</p><p>{story(k % 3)}</p></article>" for k in range(40)]
    few = [o if k < 6 else f"<article><p>{story(100 + k)}</p></article>" for k, o in enumerate(others)]
    texts = main_texts([page_blocks(o) for o in few])
    assert texts[:6] == [f"{story(100 + k)}\n{story(k % 3)}" for k in range(6)]


def test_hints_count_by_head_word():
    for mark in ("story ad-free", "main-content share-page", "entry news-alert-article", "search-results-page", "comment-free read"):
        assert page_blocks(f'<div class="{mark}"><p>t</p></div>') == [("t", OPEN)], mark
    for mark in ("cookie-notice", "ad-slot-2", "share-bar", "related-posts", "left sidebar-box", "post-comments", "nav_links", "ads"):
        assert page_blocks(f'<div id="{mark}"><p>t</p></div>') == [("t", FRAME)], mark


def test_broken_markup_takes_time_by_its_length():
    parts = ["<b>", "</i>", "<div>", "</span>", '<a href="x', "<", "<!--", "&am", "'"]
    for html in ("<b>" * 150_000 + "</i>" * 150_000, "<i>" + "<b></p>" * 150_000 + "</i>", "".join(parts * 40_000), "<p " * 300_000):
        start = time.perf_counter()
        page_blocks(html + "<p>end")
        assert len(html) >= 900_000 and time.perf_counter() - start < 8


class Plain(HTMLParser):
    """The text of the article element, block by block, by the standard library's parser."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.inside, self.hidden, self.parts, self.out = 0, 0, [], []

    def close_block(self):
        text = " ".join("".join(self.parts).split())
        self.parts = []
        if text:
            self.out.append(text)

    def handle_starttag(self, tag, attrs):
        if tag in ("p", "h1", "h2", "h3", "ul", "li", "div", "article", "blockquote", "table", "tr", "pre", "ol", "section"):
            self.close_block()
        elif tag == "br":
            self.parts.append(" ")
        self.inside += tag == "article"
        self.hidden += tag in ("script", "style")

    def handle_endtag(self, tag):
        if tag in ("p", "h1", "h2", "h3", "ul", "li", "div", "article", "blockquote", "table", "tr", "pre", "ol", "section"):
            self.close_block()
        self.inside -= tag == "article"
        self.hidden -= tag in ("script", "style")

    def handle_data(self, data):
        if self.inside and not self.hidden:
            self.parts.append(data)


def test_query_gives_every_article_of_the_table(spark):
    folder = "/root/testdata/sf0.01"
    rows = spark.read.parquet(f"{folder}/pages.parquet").collect()
    found = {r["page_id"]: r for r in op3_html_main_text(spark, folder).collect()}
    assert len(found) == len(rows)
    for r in rows:
        plain = Plain()
        plain.feed(r["html"] or "")
        plain.close()
        text = "\n".join(plain.out)
        got = found[r["page_id"]]
        assert (got["text"], got["n_chars"], got["url"]) == (text, len(text), r["url"])


def test_runs_repeated_across_groups_of_a_host_count(spark):
    note, legal = "this section of the paper is written by its own readers", "all rights stay with the house that printed these pages"
    rows = []
    for k in range(24):
        some = f"<div>{note}</div>" if k % 8 == 0 else ""
        body = f"<article><p>{story(k)}</p><p>{legal if k % 3 == 0 else k}</p></article><p>a{k} has words n{k}</p>{some}"
        rows.append((k, "http://h.net/" + str(k), body))
    rows += [(24, "http://other.net/", f"<p>{note}</p>"), (25, "http://h.net/0", rows[0][2])]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    want = dict(extract_main_text(pages).select("page_id", "text").collect())
    assert want[0] == want[25] == f"{story(0)}\na0 has words n0" and want[24] == note
    for size in (1, 2, 5):
        found = dict(extract_main_text(pages, group_pages=size).select("page_id", "text").collect())
        open_text = {k: t.split("\n")[-1] for k, t in found.items()}
        assert open_text == {k: t.split("\n")[-1] for k, t in want.items()}


def test_groups_of_a_host_judge_like_the_whole_host(spark):
    """Stale blocks of articles, copies of articles and partners in frames and articles, over the borders of groups."""
    legal, menu = "all rights stay with the house that printed these pages", "a long menu of this site that every page could show"
    rare, cross = "few of the articles of this host end with this passage here", "ends one block and begins the next one with these"
    rows = []
    for k in range(40):
        body = f"<article><p>{story(k % 30)}</p>" + (f"<p>{legal}</p>" if k % 4 == 0 else "") + (f"<p>{rare}</p>" if k % 10 == 1 else "") + "</article>"
        tail = f"<p>{menu} o{k}</p>" if k == 3 else f"<nav>{menu}</nav>" if k == 17 else ""
        tail += f"<p>{story(9)} p{k}</p>" if k == 5 else ""
        tail += f"<footer>f {cross[:20]}</footer><div>{cross[20:]}</div>" if k in (6, 31) else f"<p>own words of o{k}</p>" if k % 7 == 0 else ""
        rows.append((k, "http://h.net/" + str(k), body + tail))
    rows += [(100 + k, "http://h.net/" + str(k), rows[k][2]) for k in (3, 4, 5)]
    rows += [(200, "http://o.net/", f"<article><p>{legal}</p></article>"), (201, "http://o.net/", None), (202, "http://h.net/e", "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    host = [r for r in rows if "h.net" in r[1]]
    want = dict(zip([r[0] for r in host], main_texts([page_blocks(r[2]) for r in host]))) | {200: legal, 201: ""}
    assert legal not in want[0] and rare in want[1] and menu not in want[3] and "word9x" not in want[5].split("\n")[-1]
    for size in (1, 4, 15, 500):
        assert dict(extract_main_text(pages, group_pages=size).select("page_id", "text").collect()) == want, size


def test_whole_pages_in_spark(spark):
    article = FRAMED.format("<article><p>same text on both pages, a long one at that</p></article>")
    rows = [(1, "http://h.net/1", article), (2, "http://h.net/2", article), (3, None, None), (4, "x", ""), (4, "x", "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'k' AS text")
    for size in (1, 500):
        found = sorted(tuple(r) for r in extract_main_text(pages, group_pages=size).select("page_id", "text").collect())
        text = "same text on both pages, a long one at that"
        assert found == [(1, text), (2, text), (3, ""), (4, ""), (4, "")]
    assert extract_main_text(pages.limit(0)).count() == 0
