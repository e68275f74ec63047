"""Main text of web pages by consensus on host paths.

1. Each page's containers (body, article, div, table cell, ...) are scored: the
   characters of running text below them, less link text; boilerplate, which is left out
   anyway, counts for nothing.  A deeper one wins only if it holds all its ancestor has.  A
   container's path is the chain of tags and classes from the root, with digits made
   general (``post-17`` and ``post-18`` are one class).
2. Per host the pages vote, each for its best path: in Spark the votes of each path are added
   up, and the path with the most wins.
3. Every page is extracted again from the containers on its host's winning path; a page
   that has none there uses its own best container.  Main text beside them is kept too if
   it stands directly in a container around them, in the same article or, without one, in
   the same part of the body.

Left out wherever they stand: navigation, footers, sidebars, forms, scripts, styles,
hidden parts; a header, but for the headings of one inside the article; and elements
with a class or id of boilerplate: one that is such a word (``sidebar``) or is made of such words and
words of layout (``cookie-notice``, ``comment-list``), but not one that holds another word
(``has-sidebar``, ``ad-free``, ``social-science``).  No class takes away an article, a main
part or a first heading, nor what stands around the page's main part, its first article
or heading or, where it has none of them, around most of its text.  Code listings are kept as they are.

Pages are read by one scan: scripts and styles go straight to their own end mark, a tag
ends at its ``>`` or before the next ``<`` outside a quoted value, and containers know their
parent only, so time and memory are linear in the page, however broken or deep.

Scale: scoring and extraction are one pass each; between them only (host, path,
votes) is shuffled, summed before the shuffle, so a host that holds a third of the pages is
no hot key; the winners are joined back by host as a table, and a host with many pages
is dealt out by a salt of its pages.

Defined results: a null or empty page, or one without main text, gives the empty text; a null url
or one without a host shares the empty host; an unclosed element ends with its
parent; an unclosed script or comment ends with the page, a tag without any ``>`` behind it is
text; ties between paths go to the longer, then the last in order; rows that share a
page_id are extracted each for itself; a null page_id is kept; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, map_batches, materialise

# Quotes bound a value only behind "="; all repeats are possessive, so a failed match is not tried again.
_TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/<>]*+)((?:[^<>=]++|=\s*+"[^"]*+"|=\s*+'[^']*+'|=)*+)""")
_ATTRIBUTE = re.compile(r"""(?<![a-zA-Z-])([a-zA-Z-]++)(?:\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s"'>]++)))?+""")
#: Their content is not markup.
_RAW = {"script", "style", "textarea", "title", "noscript", "template", "iframe", "svg", "math", "object"}
_END = {tag: re.compile(rf"</{tag}(?=[\s/>])", re.I) for tag in _RAW}
#: Without an end mark these take the rest of the page with them; others are passed over.
_TO_THE_END = {"script", "style"}
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
_INLINE = {"a", "abbr", "b", "bdi", "bdo", "big", "br", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img",
           "ins", "kbd", "label", "mark", "q", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time",
           "tt", "u", "var", "wbr"}
_CODE = {"pre", "code", "samp", "kbd"}
#: Elements that are closed by what follows, so they bound blocks but hold no path.
_LOOSE = {"p", "li", "dt", "dd", "option", "h1", "h2", "h3", "h4", "h5", "h6", "tr", "thead", "tbody", "tfoot", "pre",
          "blockquote", "figcaption", "caption", "address", "hr", "ul", "ol", "dl", "figure"}
_HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
_BOILER_TAGS = {"nav", "aside", "footer", "form", "button", "select", "menu", "dialog", "head", "fieldset", "search"}
_BOILER_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alert", "alertdialog",
                 "menu", "menubar", "form"}
_BOILER_WORDS = {"ad", "ads", "advert", "adverts", "advertisement", "advertising", "banner", "sponsor", "sponsored",
                 "promo", "promotion", "sidebar", "menu", "nav", "navbar", "navigation", "breadcrumb", "breadcrumbs",
                 "footer", "cookie", "cookies", "consent", "gdpr", "notice", "popup", "modal", "overlay", "newsletter",
                 "subscribe", "subscription", "share", "sharing", "social", "related", "recommended", "recommendations",
                 "comment", "comments", "reply", "replies", "respond", "disqus", "widget", "login", "signup", "toolbar",
                 "pagination", "pager", "skip"}
#: Words of layout that say nothing against the boilerplate word beside them.
_LAYOUT_WORDS = {"", "area", "article", "aside", "author", "bar", "block", "body", "bottom", "box", "buttons", "center",
                 "column", "container", "content", "entry", "footer", "form", "global", "group", "header", "inner", "item",
                 "items", "left", "link", "links", "list", "main", "meta", "mobile", "outer", "page", "panel", "post",
                 "posts", "primary", "reader", "right", "row", "secondary", "section", "side", "site", "slot", "sticky",
                 "text", "thread", "title", "top", "unit", "user", "wrap", "wrapper"}
#: Parts a host's pages are dealt into.
SALTS = 16
_NEVER = {"html", "body", "article", "main", "h1"}


@dataclass
class Block:
    text: str
    linked: int  # characters of link text
    container: int  # the innermost one it stands in, -1 for none
    boiler: bool
    mark: int = -1  # the innermost element around it that has a class of boilerplate


@dataclass
class Page:
    parent: list[int] = field(default_factory=list)  # of each container; parents come first
    step: list[str] = field(default_factory=list)  # tag and classes
    tag: list[str] = field(default_factory=list)
    blocks: list[Block] = field(default_factory=list)


@dataclass
class Open:
    """An open element."""

    tag: str
    container: int
    boiler: bool  # by tag, role or style
    mark: int  # of the innermost element with a class of boilerplate
    in_article: bool
    headings_only: bool


def _attributes(text: str) -> dict[str, str]:
    found: dict[str, str] = {}
    for m in _ATTRIBUTE.finditer(text):
        found.setdefault(m[1].lower(), next((v for v in m.groups()[1:] if v is not None), ""))
    return found


def _is_boiler(tag: str, attributes: dict[str, str], in_article: bool) -> bool:
    """Whether an element is boilerplate by its tag, role or style."""
    if tag in _BOILER_TAGS or attributes.get("role", "").lower() in _BOILER_ROLES:
        return True
    if tag == "header" and not in_article:
        return True
    return "hidden" in attributes or re.search(r"display\s*:\s*none|visibility\s*:\s*hidden",
                                               attributes.get("style", "")) is not None


def _names_boiler(tag: str, attributes: dict[str, str]) -> bool:
    """Whether one of an element's classes, or its id, names boilerplate."""
    if tag in _NEVER:
        return False
    for name in f"{attributes.get('class', '')} {attributes.get('id', '')}".split():
        words = set(re.split(r"[^a-z]+", re.sub(r"(?<=[a-z])(?=[A-Z])", "-", name).lower()))
        if not _BOILER_WORDS.isdisjoint(words) and words <= _BOILER_WORDS | _LAYOUT_WORDS:
            return True
    return False


def _step(tag: str, attributes: dict[str, str]) -> str:
    classes = sorted(set(re.sub(r"\d+", "#", attributes.get("class", "").lower()).split()))
    return ".".join([tag, *classes]).replace(">", "")


def tokens(page: str) -> Iterator[tuple[str, str, str]]:
    """("text", piece, ""), ("open", tag, attributes) and ("close", tag, ""), in one scan."""
    at, last, endless = 0, page.rfind(">"), set()
    while True:
        mark = page.find("<", at)
        if mark < 0 or (mark > last and not page.startswith("<!--", mark)):
            break
        m = _TAG.match(page, mark)
        if m is None:
            following = page[mark + 1:mark + 2]
            if following not in ("!", "?", "/"):
                yield "text", page[at:mark + 1], ""
                at = mark + 1
                continue
            if mark > at:
                yield "text", page[at:mark], ""
            if page.startswith("<!--", mark):
                end, size = page.find("-->", mark + 4), 3
            elif page.startswith("<![CDATA[", mark):
                end, size = page.find("]]>", mark), 3
                if end >= 0:
                    yield "raw", page[mark + 9:end], ""
            else:
                end, size = page.find(">", mark), 1
            if end < 0:
                return
            at = end + size
            continue
        if mark > at:
            yield "text", page[at:mark], ""
        at = m.end() + page.startswith(">", m.end())
        tag = m[2].lower()
        if tag not in _RAW or m[1]:
            if tag not in _RAW:
                yield ("close" if m[1] else "open"), tag, m[3]
            continue
        yield "raw", "", ""
        if m[3].rstrip().endswith("/") or tag in endless:
            continue
        end = _END[tag].search(page, at)
        if end is not None:
            at = page.find(">", end.end()) + 1 or len(page)
        elif tag in _TO_THE_END:
            return
        else:
            endless.add(tag)
    if at < len(page):
        yield "text", page[at:], ""


def parse(page: str) -> Page:
    """Containers and text blocks of a page."""
    out = Page()
    stack = [Open("", -1, False, -1, False, False)]
    is_open: Counter[str] = Counter()
    parts: list[str] = []
    linked, links, heading, code = 0, 0, False, 0
    # Elements with a class of boilerplate: the one around each; and those around the main part, the first article and heading.
    around: list[int] = []
    anchors: dict[str, int] = {}

    def flush() -> None:
        nonlocal linked
        text = " ".join("".join(parts).split())
        if text:
            top = stack[-1]
            out.blocks.append(Block(text, linked, top.container, top.boiler or (top.headings_only and not heading), top.mark))
        parts.clear()
        linked = 0

    def push(element: Open) -> None:
        stack.append(element)
        is_open[element.tag] += 1

    def close(tag: str) -> None:
        while is_open[tag]:
            gone = stack.pop()
            is_open[gone.tag] -= 1
            if gone.tag == tag:
                return

    def marked(tag: str, attributes: dict[str, str]) -> int:
        """The mark inside this element."""
        if not _names_boiler(tag, attributes):
            return stack[-1].mark
        around.append(stack[-1].mark)
        return len(around) - 1

    for kind, name, rest in tokens(page):
        if kind == "text":
            piece = html.unescape(name)
            parts.append(piece)
            linked += len(piece) if links else 0
            continue
        if kind == "raw":
            parts.append(name)
            continue
        tag, closing, top = name, kind == "close", stack[-1]
        if tag in _CODE:
            code = max(0, code + (-1 if closing else 1))
        if tag == "a":
            links = max(0, links + (-1 if closing else 1))
        if tag in _INLINE:
            if tag == "br":
                parts.append(" ")
            elif closing and top.tag == tag:
                flush()
                close(tag)
            elif not closing and tag not in _VOID and not code and rest.strip():
                attributes = _attributes(rest)
                boiler, mark = _is_boiler(tag, attributes, True), marked(tag, attributes)
                if boiler or mark != top.mark:
                    # An inline advert or share link: open it as an element of its own.
                    flush()
                    push(Open(tag, top.container, top.boiler or boiler, mark, True, False))
            continue
        flush()
        links = 0
        if tag in _VOID:
            continue
        if closing:
            if tag in _HEADINGS:
                heading = False
            close(tag)
            continue
        attributes = _attributes(rest) if rest.strip() else {}
        if tag in ("article", "main", "h1") and not top.boiler:
            anchors.setdefault(tag, top.mark)
        if tag in _LOOSE:
            heading = tag in _HEADINGS or (heading and tag not in ("p", "li", "pre"))
            boiler, mark = _is_boiler(tag, attributes, top.in_article), marked(tag, attributes)
            if boiler or mark != top.mark:
                push(Open(tag, top.container, top.boiler or boiler, mark, top.in_article, top.headings_only))
            elif top.tag == tag and tag in ("p", "li"):
                close(tag)  # a paragraph opened by a boilerplate one ends it
            continue
        heading = False
        in_article = top.in_article or tag in ("article", "main")
        boiler = top.boiler or _is_boiler(tag, attributes, in_article)
        out.parent.append(top.container)
        out.step.append(_step(tag, attributes))
        out.tag.append(tag)
        push(Open(tag, len(out.tag) - 1, boiler, marked(tag, attributes), in_article,
                  top.headings_only or (tag == "header" and not boiler)))
    flush()
    _settle(out, around, anchors)
    return out


def _settle(page: Page, around: list[int], anchors: dict[str, int]) -> None:
    """Make the blocks under elements with a class of boilerplate boilerplate, unless the element
    stands around the page's main part or, where it has none, around most of its text."""
    cleared = set()
    anchor = next((anchors[t] for t in ("main", "article", "h1") if t in anchors), None)
    if anchor is None and around:
        held, total = [0] * len(around), 0
        for b in page.blocks:
            if not b.boiler:
                total += len(b.text) - b.linked
                if b.mark >= 0:
                    held[b.mark] += len(b.text) - b.linked
        for k in range(len(around) - 1, -1, -1):
            if around[k] >= 0:
                held[around[k]] += held[k]
        cleared = {k for k, n in enumerate(held) if 2 * n > total}
    while anchor is not None and anchor >= 0:
        cleared.add(anchor)
        anchor = around[anchor]
    bad = []
    for k, above in enumerate(around):
        bad.append(k not in cleared or (above >= 0 and bad[above]))
    for b in page.blocks:
        b.boiler = b.boiler or (b.mark >= 0 and bad[b.mark])


def _paths(page: Page) -> tuple[list[int], list[tuple[int, str]]]:
    """The path of each container as a number, and (parent path, step) of each number."""
    known: dict[tuple[int, str], int] = {}
    of = []
    for parent, step in zip(page.parent, page.step):
        of.append(known.setdefault((of[parent] if parent >= 0 else -1, step), len(known)))
    return of, list(known)


def _written(path: int, known: list[tuple[int, str]]) -> str:
    steps = []
    while path >= 0:
        path, step = known[path]
        steps.append(step)
    return ">".join(reversed(steps))


def best_path(page: Page) -> str | None:
    """The path with the most running text below its containers, less link text; of equal ones the longest."""
    of, known = _paths(page)
    below = [0] * len(of)
    for b in page.blocks:
        if not b.boiler and b.container >= 0:
            below[b.container] += len(b.text) - 2 * b.linked
    for c in range(len(of) - 1, -1, -1):
        if page.parent[c] >= 0:
            below[page.parent[c]] += below[c]
    scores, sizes = [0] * len(known), []
    for path, score in zip(of, below):
        scores[path] += score
    for above, step in known:
        sizes.append(len(step) + (sizes[above] + 1 if above >= 0 else 0))
    top = max(scores, default=0)
    if top <= 0:
        return None
    size = max(sizes[p] for p, s in enumerate(scores) if s == top)
    return max(_written(p, known) for p, s in enumerate(scores) if s == top and sizes[p] == size)


def _on_path(page: Page, path: str | None) -> set[int]:
    """The containers whose path is ``path``."""
    if path is None:
        return set()
    steps = path.split(">")
    deep, found = [], set()
    for c, (parent, step) in enumerate(zip(page.parent, page.step)):
        at = deep[parent] if parent >= 0 else 0
        deep.append(at + 1 if 0 <= at < len(steps) and steps[at] == step else -1)
        if deep[c] == len(steps):
            found.add(c)
    return found


def _is_main(b: Block) -> bool:
    return not b.boiler and len(b.text) > 2 * b.linked


def _under(page: Page, tops: set[int]) -> list[bool]:
    out: list[bool] = []
    for c, parent in enumerate(page.parent):
        out.append(c in tops or (parent >= 0 and out[parent]))
    return out


def main_text(page: Page, path: str | None) -> str:
    """The text under the containers on ``path``, or under the page's own best one, and
    the main text that would be lost beside them: that in the articles around them (without
    one, in the outermost containers but the body that hold such text), and that which stands
    directly in a container around them."""
    chosen = _on_path(page, path)
    inside = _under(page, chosen)
    if not any(not b.boiler and b.container >= 0 and inside[b.container] for b in page.blocks):
        best = best_path(page)
        if best is None:
            return "\n".join(b.text for b in page.blocks if not b.boiler and b.container < 0)
        chosen = _on_path(page, best)
        inside = _under(page, chosen)
    beside, filled = [False] * len(page.parent), [False] * len(page.parent)
    for b in page.blocks:
        if b.container >= 0 and not b.boiler:
            filled[b.container] = True
            if _is_main(b) and not inside[b.container]:
                beside[b.container] = True
    for c in range(len(page.parent) - 1, -1, -1):
        if page.parent[c] >= 0:
            for flags in (beside, filled):
                flags[page.parent[c]] = flags[page.parent[c]] or flags[c]
    # Of each container: the article it stands in, and the outermost one around it but the body with text beside.
    article, outer = [], []
    for c, (parent, tag) in enumerate(zip(page.parent, page.tag)):
        article.append(c if tag in ("article", "main") else article[parent] if parent >= 0 else -1)
        over = outer[parent] if parent >= 0 else -1
        outer.append(over if over >= 0 or tag in ("html", "body") or not beside[c] else c)
    wide, around = set(chosen), {-1}
    for c in chosen:
        parent = page.parent[c]
        if not filled[c] or (parent >= 0 and inside[parent]):
            continue
        if article[c] >= 0:
            wide.update([article[c]] if beside[article[c]] else [])
        elif parent >= 0 and outer[parent] >= 0:
            wide.add(outer[parent])
        while parent >= 0 and parent not in around:
            around.add(parent)
            parent = page.parent[parent]
    inside = _under(page, wide)
    return "\n".join(b.text for b in page.blocks if not b.boiler and (
        (b.container >= 0 and inside[b.container]) or (b.container in around and _is_main(b))))


def host_of(url):
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def host_paths(pages: DataFrame) -> DataFrame:
    """host, path: the path that the pages of a host vote for."""
    def vote(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        votes: dict[tuple[str, str], int] = {}
        for host, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            path = best_path(parse(text or ""))
            if path is not None:
                votes[host, path] = votes.get((host, path), 0) + 1
        if not votes:
            return None
        return pa.record_batch([pa.array([h for h, _ in votes]), pa.array([p for _, p in votes]),
                                pa.array(list(votes.values()), pa.int64())], names=["host", "path", "votes"])

    votes = map_batches(pages.select(host_of(F.col("url")).alias("host"), "html"), vote,
                        "host string, path string, votes long")
    summed = votes.groupBy("host", "path").agg(F.sum("votes").alias("votes"))
    return (summed.groupBy("host").agg(F.max(F.struct("votes", F.length("path").alias("n"), "path")).alias("best")).select("host", "best.path"))


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    bounded_batches(pages.sparkSession)
    own = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    winners = materialise(host_paths(own), "host-paths")
    # Each host's path goes to every salt, so a host with a third of the pages is dealt out over its tasks.
    salted = winners.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    joined = (own.withColumns({"host": host_of(F.col("url")), "salt": F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)).cast("int")})
              .join(salted, ["host", "salt"], "left").select("page_id", "url", "html", "path"))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [main_text(parse(t or ""), p) for t, p in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())]
        return pa.record_batch([batch.column(0), batch.column(1), pa.array(texts, pa.string()),
                                pa.array([len(t) for t in texts], pa.int64())],
                               names=["page_id", "url", "text", "n_chars"])

    return map_batches(joined, run, "page_id long, url string, text string, n_chars long")
