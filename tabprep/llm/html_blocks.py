"""Cuts an HTML page into text blocks and tells the page's frame from its content."""

from __future__ import annotations

import re
from collections import Counter
from html import unescape

#: Kinds of blocks.
ARTICLE, OPEN, FRAME = 0, 1, 2

# Element names of HTML, and words of class names, ids and roles.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
UNSEEN = frozenset(
    "head title script style noscript template svg math iframe object canvas audio video map".split()
)
RAW = frozenset("script style textarea title noscript iframe".split())
FRAMES = frozenset("nav aside form dialog menu button select option textarea label fieldset".split())
EDGES = frozenset("header footer".split())
MAIN = frozenset("article main".split())
BLOCKS = frozenset(
    "html body p div section article main header footer nav aside form h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table "
    "caption thead tbody tfoot tr blockquote pre figure figcaption address details summary fieldset legend hr "
    "dialog menu center hgroup".split()
)
HINTS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense banner banners sponsor sponsored promo promoted "
    "promotion cookie cookies consent gdpr notice notices alert newsletter subscribe subscription signup login "
    "sidebar sidebars menu menus nav navbar navigation breadcrumb breadcrumbs pagination pager comment comments "
    "commentlist disqus reply replies respond related recommended recommendations share sharing social popup "
    "modal overlay masthead toolbar widget widgets contentinfo complementary search".split()
)
EDGE_HINTS = frozenset("header footer".split())
#: Words that say how something is laid out; the word before them says what it is.
LAYOUT = frozenset(
    "container wrapper wrap box bar list links link item items section block slot unit area inner outer panel button "
    "buttons icon icons form posts left right top bottom col column row group text body".split()
)

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*'|[\"'])*?)(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"([^\s\"'<>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_UNDRAWN = re.compile(r"(?:^|;)\s*display\s*:\s*none\b", re.I)
_SPLIT = re.compile(r"[^a-z0-9]+")
#: A class or id that begins or ends so tells what stands beside or inside a container, not what it is.
_CONTAINER = re.compile(r"(?:^|[-_])(?:has|no|not|with|without|hide|is)[-_]|[-_](?:open|opened|closed|enabled|disabled|on|off|count|active)$")
#: Heads of content, not of the site.
_CONTENT_HEAD = re.compile(r"^(?:post|entry|article|story|content|section|title|single)[-_]*header$")


def _is_hint(token: str, in_main: bool) -> bool:
    """If one class, id or role names a part of the frame, by its whole or by its head word.

    The head of ``cookie-notice`` is its last word; of ``share-bar`` and ``ad-slot-2`` the last one
    that is not just layout. So ``ad-free`` and ``search-results-page`` name no frame.
    """
    if _CONTAINER.search(token):
        return False
    words = [w for w in _SPLIT.split(token) if w and not w.isdigit()]
    while len(words) > 1 and words[-1] in LAYOUT:
        words.pop()
    head = {token, *words[-1:]}
    return bool(head & HINTS or (head & EDGE_HINTS and not in_main and not _CONTENT_HEAD.search(token)))


def _is_frame(name: str, attributes: str, in_main: bool) -> int:
    """2 if an element is frame or hidden for sure, 1 if a class, id or role hints at it, else 0."""
    if name in FRAMES or (name in EDGES and (name == "footer" or not in_main)):
        return 2
    if not attributes or name in ("html", "body"):
        return 0
    hint = 0
    for m in _ATTRIBUTE.finditer(attributes):
        kind, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if kind == "hidden" or (kind == "style" and _UNDRAWN.search(value)):
            return 2
        if kind in ("class", "id", "role") and any(_is_hint(t, in_main) for t in value.lower().split()):
            hint = 1
    return hint


def page_blocks(html: str | None) -> list[tuple[str, int]]:
    """(text, kind) of each block with text, in page order.

    References are decoded, white space is one space, and markup, comments, scripts and styles
    are gone. Kind ``ARTICLE`` is text in an article or main element, ``FRAME`` is text in
    menus, headers, footers, sidebars, notices, adverts, forms and reader comments, by element
    name or by class, id or role, and ``OPEN`` is anything else. A main element, or an
    article outside main, lifts a mark that comes from a hint of class, id or role alone. Time
    grows with the length of a page, however broken its markup.
    """
    html = html or ""
    out: list[tuple[str, int]] = []
    parts: list[str] = []
    # Name, and what holds above it: hinted frame (1), frame (2) or unseen (3), and main.
    stack: list[tuple[str, int, bool]] = []
    standing: Counter[str] = Counter()
    frame, main = 0, False
    at, end = 0, len(html)

    def close() -> None:
        if parts:
            text = " ".join(unescape("".join(parts)).split())
            parts.clear()
            if text:
                out.append((text, FRAME if frame else ARTICLE if main else OPEN))

    while at < end:
        m = _TAG.search(html, at)
        if not m:
            if frame < 3:
                parts.append(html[at:])
            break
        if m.start() > at and frame < 3:
            parts.append(html[at : m.start()])
        at = m.end()
        if m[2] is None:
            continue
        name = m[2].lower()
        if name in BLOCKS:
            close()
        elif name in ("br", "td", "th", "option"):
            parts.append(" ")
        if m[1]:
            if standing[name]:  # else nothing ends here, and the stack need not be searched
                last = None
                while last != name:
                    last, below, inside = stack.pop()
                    standing[last] -= 1
                if (below, inside) != (frame, main):
                    close()
                frame, main = below, inside
            continue
        if name in VOID or m[3].endswith("/") and name not in BLOCKS:
            continue
        unseen = name in UNSEEN
        framed = 0 if unseen or frame > 1 else _is_frame(name, m[3], main)
        enters = name in MAIN and not main and not framed and frame < 2
        if name in RAW:  # what stands inside is no markup
            stop = re.compile(rf"</{name}\b[^>]*(?:>|\Z)|\Z", re.I).search(html, at)
            if not unseen and frame < 3:
                parts.append(html[at : stop.start()] if not framed else " ")
            at = stop.end()
            continue
        if unseen or framed or enters:
            close()
        stack.append((name, frame, main))
        standing[name] += 1
        if unseen:
            frame = 3
        elif framed:
            frame = max(frame, framed)
        elif enters:
            frame = 0
        main = main or enters
    close()
    return out
