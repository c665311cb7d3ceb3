"""Main text of web pages: blocks of the DOM, labelled content or boilerplate by a minimum cut."""

from __future__ import annotations

import html
import re
import sys

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rentlens.llm.common import by_value

by_value(sys.modules[__name__])

# Fixed values of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe svg math textarea select object canvas title".split())
UNENDED = frozenset("script style title textarea".split())  #: without an end tag they reach to the end of the page
BLOCK = frozenset("""address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption
    figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol p pre section summary table tbody
    td tfoot th thead tr ul button label""".split())
HEADING = frozenset("h1 h2 h3 h4 h5 h6".split())
#: An opening tag ends these open ones, as far up as the tags that bound them.
ENDS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
        "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
        "option": ({"option"}, {"select"})}
TAG = re.compile(r"<!--(?:.*?-->|.*)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>"
                 r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>", re.S)
ATTRIBUTE = re.compile(r"""\b(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
TOKEN = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")

# What a container says about its blocks: log odds of content.
CONTENT_TAGS = frozenset("article main".split())
OTHER_TAGS = frozenset("nav footer aside form header menu dialog button label fieldset legend".split())
CONTENT_NAMES = frozenset("article content post entry main story body".split())
OTHER_NAMES = frozenset("""ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner nav
    navbar navigation menu breadcrumb breadcrumbs sidebar aside footer header masthead topbar cookie cookies consent notice
    notices notification alert gdpr newsletter subscribe subscription signup login popup modal overlay share sharing social
    related recommended recommendations teaser teasers comment comments commentlist reply replies respond disqus search
    pagination pager copyright legal widget toolbar skip tags complementary contentinfo dialog form""".split())
#: Class names that tell of a page's layout, state or topic and not of the element: has-sidebar, comments-open, category-legal.
MODIFIER = re.compile(r"(?:has|with|category|tag)[-_].*|.*[-_]open", re.I | re.S)
IN_CONTENT, IN_OTHER, HIDDEN = 5.0, -7.0, -12.0
#: Smoothness between neighbours in page order, and between neighbours under one parent and one grandparent.
ADJACENT, SIBLING, COUSIN = 0.3, 0.5, 0.2


def _evidence(tag: str, attributes: str, outer: float, path: tuple[str, ...]) -> float:
    """Log odds of content inside an element, from its own names or else from its container's."""
    if tag in ("html", "body"):
        return 0.0
    names: list[str] = []
    if attributes:
        for m in ATTRIBUTE.finditer(attributes):
            key, value = m[1].lower(), m[2] or m[3] or m[4] or ""
            if key == "hidden" or key == "aria-hidden" and value == "true" or key == "style" and re.search(
                    r"display\s*:\s*none|visibility\s*:\s*hidden", value):
                return HIDDEN
            if key in ("class", "id", "role"):
                names += [t.lower() for name in value.split() if not MODIFIER.fullmatch(name) for t in TOKEN.findall(name)]
    if tag in OTHER_TAGS or OTHER_NAMES.intersection(names):
        if tag == "header" and "article" in path and not OTHER_NAMES.intersection(names) - {"header"}:
            return outer  # the article's own head holds its title
        return min(outer, IN_OTHER) if outer < 0 else IN_OTHER
    if outer == IN_OTHER and (tag == "main" or tag == "article" and not OTHER_TAGS.intersection(path)):
        return IN_CONTENT  # the page's own mark of its text says more than a container's name
    if outer < -1:
        return outer  # nothing else inside boilerplate is the article
    if tag in CONTENT_TAGS:
        return IN_CONTENT
    if CONTENT_NAMES.intersection(names):
        return max(outer, 2.0)
    return outer


def blocks(page: str) -> list[tuple[str, float, int, int, str, float]]:
    """(text, evidence, parent, grandparent, tag, share of text in links) of the page's blocks, in page order.

    A block is the text between two tags of block elements, with references decoded and white space made one space.
    """
    out: list[tuple[str, float, int, int, str, float]] = []
    stack: list[tuple[str, float, int]] = [("", 0.0, 0)]  # tag, evidence, number of the element
    number = links = 0
    parts: list[str] = []
    linked: list[str] = []

    def flush() -> None:
        if not parts:
            return
        text = " ".join(html.unescape("".join(parts)).split())
        if text:
            holders = [e for e in stack if e[0] in BLOCK] or [stack[0]]
            share = len(" ".join(html.unescape("".join(linked)).split())) / len(text)
            out.append((text, stack[-1][1], holders[-1][2], holders[-2][2] if len(holders) > 1 else 0, holders[-1][0],
                        min(1.0, share)))
        parts.clear()
        linked.clear()

    def close(k: int) -> None:
        nonlocal links
        links -= sum(e[0] == "a" for e in stack[k:])
        del stack[k:]

    def shut(tags: set[str], bound: set[str]) -> None:
        for k in range(len(stack) - 1, 0, -1):
            if stack[k][0] in tags:
                return close(k)
            if stack[k][0] in bound:
                return

    at, n = 0, len(page)
    while at < n:
        m = TAG.search(page, at)
        if m is None:
            parts.append(page[at:])
            break
        if m.start() > at:
            piece = page[at:m.start()]
            parts.append(piece)
            if links:
                linked.append(piece)
        at = m.end()
        tag = m[2] or m[5]
        if not tag:
            continue
        tag, ending, attributes = tag.lower(), m[1] or m[4], m[3] or m[6] or ""
        if tag == "br":
            parts.append(" ")
            continue
        if tag in BLOCK:
            flush()
        if ending:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] == tag:
                    close(k)
                    break
            continue
        if tag in RAW:
            end = re.compile(f"</{tag}(?=[\\s/>])[^>]*>?", re.I).search(page, at)
            if end:
                at = end.end()
            elif tag in UNENDED:
                at = n
            continue
        if tag in ENDS:
            shut(*ENDS[tag])
        elif tag in BLOCK and tag not in ("button", "label"):
            shut({"p"}, {"td", "th", "table", "button", "body", "caption"})
        if tag in VOID:
            continue
        number += 1
        links += tag == "a"
        stack.append((tag, -9.0 if tag == "head" else _evidence(tag, attributes, stack[-1][1], tuple(e[0] for e in stack)),
                      number))
    flush()
    return out


def log_odds(text: str, evidence: float, tag: str, share: float) -> float:
    """The classifier: log odds that a block is content, from its container, length, sentence end, tag and links."""
    words = text.count(" ") + 1
    odds = evidence + 1.5 * min(words, 30) / 30 - 0.6 - 3.0 * share
    if text[-1] in ".!?:;\"'»”…)":
        odds += 0.4
    if tag in HEADING:
        odds += 0.3
    elif tag == "li" and words < 4:
        odds -= 0.5
    return odds


def min_cut(odds: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """Which nodes lie on the content side of the minimum cut.

    Positive odds are the capacity from the source, negative ones that to the sink; edges have their weight both ways.
    Dinic's algorithm: what is left of a node's terminal capacity is its excess, flow goes from nodes with positive to nodes
    with negative excess along shortest paths, and the content side is what the rest of the source still reaches.
    """
    tiny, n = 1e-9, len(odds)
    excess = list(odds)
    if min(excess, default=0) >= 0 or max(excess, default=0) <= 0:
        if not edges or min(excess, default=0) > 0 or max(excess, default=0) <= 0:
            return [x > tiny for x in excess]
    heads: list[list[int]] = [[] for _ in range(n)]
    to: list[int] = []
    room: list[float] = []
    for a, b, w in edges:
        heads[a].append(len(to))
        to.append(b)
        room.append(w)
        heads[b].append(len(to))
        to.append(a)
        room.append(w)

    def levels() -> tuple[list[int], bool]:
        level = [-1] * n
        queue = [i for i in range(n) if excess[i] > tiny]
        for i in queue:
            level[i] = 0
        found, k = False, 0
        while k < len(queue):
            i = queue[k]
            k += 1
            for e in heads[i]:
                j = to[e]
                if level[j] < 0 and room[e] > tiny:
                    level[j] = level[i] + 1
                    found = found or excess[j] < -tiny
                    queue.append(j)
        return level, found

    while True:
        level, found = levels()
        if not found:
            return [x >= 0 for x in level]
        arc = [0] * n
        for start in range(n):
            while excess[start] > tiny and level[start] == 0:
                path, i = [], start
                while excess[i] >= -tiny or i == start:
                    while arc[i] < len(heads[i]):
                        e = heads[i][arc[i]]
                        if room[e] > tiny and level[to[e]] == level[i] + 1:
                            break
                        arc[i] += 1
                    if arc[i] < len(heads[i]):
                        path.append(heads[i][arc[i]])
                        i = to[path[-1]]
                    elif path:
                        i = to[path.pop() ^ 1]
                        arc[i] += 1
                    else:
                        break
                if not path:
                    break
                flow = min(excess[start], -excess[i], min(room[e] for e in path))
                excess[start] -= flow
                excess[i] += flow
                for e in path:
                    room[e] -= flow
                    room[e ^ 1] += flow


def main_text(page: str | None) -> str:
    """The article of a page: its content blocks in page order, one per line; empty if there is none."""
    found = blocks(page or "")
    odds = [log_odds(text, evidence, tag, share) for text, evidence, _, _, tag, share in found]
    weights: dict[tuple[int, int], float] = {}
    parents: dict[int, int] = {}
    grands: dict[int, int] = {}
    for k, (_, _, parent, grand, _, _) in enumerate(found):
        if k:
            weights[k - 1, k] = weights.get((k - 1, k), 0.0) + ADJACENT
        for seen, key, weight in ((parents, parent, SIBLING), (grands, grand, COUSIN)):
            if key in seen:
                weights[seen[key], k] = weights.get((seen[key], k), 0.0) + weight
            seen[key] = k
    keep = min_cut(odds, [(a, b, w) for (a, b), w in weights.items()])
    return "\n".join(b[0] for b, kept in zip(found, keep) if kept)


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars (code points) of every page.

    Each page is a graph of its own: a block's log odds are its capacity to the source (content) or the sink
    (boilerplate), neighbours in page order and in the DOM are joined by smoothness edges, and the minimum cut gives
    the labels. A null or empty page, and one without content, has the empty text. Null keys stay null, repeated rows each
    give a row, other columns are left out, and an empty table gives an empty result.
    """
    kinds = ", ".join(f"{c} {pages.schema[c].dataType.simpleString()}" for c in ("page_id", "url"))

    def run(batches):
        for batch in batches:
            for k in range(0, batch.num_rows, 256):
                b = batch.slice(k, 256)
                found = [main_text(p) for p in b.column("html").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [b.column("page_id"), b.column("url"), pa.array(found, pa.string()),
                     pa.array([len(t) for t in found], pa.int64())], ["page_id", "url", "text", "n_chars"])

    rows = pages.select("page_id", "url", F.col("html").cast("string").alias("html"))
    return rows.mapInArrow(run, f"{kinds}, text string, n_chars long")
