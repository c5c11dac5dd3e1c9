"""Main text of web pages, by two passes of block rules.

A page is cut into blocks at block-level tags. What lies in navigation, headers, footers,
forms, scripts and the like, or in an element whose class, id or role says so, is left out.
The first pass decides blocks by length, link density and stop-word density: long blocks
with stop words are text, blocks of links are not, and short or unclear ones stay open.
Stop words say nothing about scripts other than Latin, so there length and link density
decide. In the second pass an open block takes the label of its nearest decided neighbours
(of both if they agree, else of the nearer). Where a page marks its article, only blocks
within it can be text, and there an open block is, unless it is short or has many links and
stands between blocks of links.
A class that says what a wrapper has or lacks (``has-sidebar``, ``no-sidebar``,
``content-with-sidebar``) says nothing of its content. If no block of a marked article remains, the
page is read again, and then an article also begins within what is left out for its class; it
is taken if it is longer than the text found without it.
Where the first pass decides no block as text (another language, or short blocks only), the
open blocks of few links are text: the long ones, or all if none is long.

Defined results: null and empty pages, and pages without text, give the empty string; rows
are handled each by itself, also if they are equal; nothing is cut at any length, and the
time is in proportion to the page's length, however bad its markup; an empty table stays
empty; other columns are kept, whatever their names.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scan import in_batches, pieces

SHORT = 70  # characters
MUCH_LINK, SOME_LINK = 0.5, 0.2
STOPS_TEXT = 0.15

#: Frequent words of several languages.
STOP_WORDS = frozenset(
    """a about after all also an and any are as at be been but by can could for from had has have he her his i if in into is
    it its more no not of on one or other she so some such than that the their them then there they this to was we were
    what when which who will with would you
    au aux avec ce ces cette dans de des du elle en est et il ils je la le les leur lui mais ne nous ou par pas plus pour
    qu que qui sa se ses son sur un une vous
    als am auch auf aus bei bis das dass dem den der die durch ein eine einem einen einer er es für hat ich ihr im ist
    mit nach nicht noch nur oder sein sich sie sind über um und vom von vor war wie wird zu zum zur
    al como con del el ella ellos era esta este fue ha la las lo los más mi muy no o para pero por que se ser si sin
    sobre son su sus también un una y ya
    che di e gli il nel per sono una não uma os as dos da do em het een van niet zijn""".split()
)
_RAW = {"script", "style", "textarea", "title", "noscript", "template", "svg", "iframe", "object", "canvas", "xmp"}
_LEFT_OUT = {"nav", "footer", "aside", "form", "button", "select", "dialog", "menu", "head", "fieldset", "datalist", "audio", "video", "map"}
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
_INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "ins", "kbd", "label", "mark", "q", "rb", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr", "br"}
_WORDS_OUT = {
    "ad", "ads", "advert", "advertisement", "advertising", "adverts", "alert", "banner", "breadcrumb", "breadcrumbs", "comment", "comments", "consent", "cookie", "cookies", "copyright", "disclaimer", "disqus", "footer", "gdpr", "header", "legal", "login", "masthead", "menu", "modal", "nav", "navbar", "navigation", "newsletter", "notice", "notification", "overlay", "pager", "pagination", "popup", "promo", "promoted", "promotion", "recommended", "related", "respond", "replies", "search", "share", "sharing", "sidebar", "signup", "skip", "social", "sponsor", "sponsored", "subscribe", "subscription", "toast", "toolbar", "topbar", "widget", "widgets",
}
_ROLES_OUT = {"alert", "alertdialog", "banner", "complementary", "contentinfo", "dialog", "form", "menu", "menubar", "navigation", "search", "toolbar"}
_MAIN = {"article", "main"}
_TAG = re.compile(r"(/?)([a-zA-Z][^\s/>]*)")
_STOP = re.compile(r"""=\s*+["']|>""")  # the begin of a quoted value, or the end of a tag
_ATTRIBUTE = re.compile(r"""(?<![a-zA-Z-])([a-zA-Z-]++)\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s"'>]++))""")
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|$|=)|display\s*:\s*none|aria-hidden\s*=\s*[\"']?true", re.I)
_NAME = re.compile(r"[A-Za-z][a-z]*|[A-Z]+")
_LETTERS = re.compile(r"[\W\d_]+")
_LATIN = re.compile("[A-Za-z\u00aa\u00ba\u00c0-\u024f\u1e00-\u1eff]+")
_END = {t: re.compile(rf"</{t}(?=[\s/>])", re.I) for t in _RAW}
_OF_TEXT = {"p", "h1", "h2", "h3", "h4", "h5", "h6", "header", "blockquote", "pre", "figure", "figcaption", "li", "dt", "dd", "td", "th", "caption"}
_ABOUT = re.compile(r"^(?:no|has|with|without|is|hide|show)[-_]|[-_](?:no|has|with|without)[-_]", re.I)
_MARKED = re.compile(r"<(?:article|main)(?=[\s/>])", re.I)
_SHUT = {"form", "dialog", "aside"}  # no article begins within


@dataclass
class Block:
    text: str
    link: float
    main: bool
    good: bool | None = None


def _left_out(tag: str, attributes: str, main: bool) -> bool:
    """Within the main part, what holds text by its tag goes only if a whole name of its
    class says so (``advert``), not a part of one (``share-price``)."""
    if tag in _LEFT_OUT:
        return True
    if not attributes.strip() or tag in ("html", "body"):
        return False
    if _HIDDEN.search(attributes):
        return True
    for m in _ATTRIBUTE.finditer(attributes):
        name, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if name == "role" and value.strip().lower() in _ROLES_OUT:
            return True
        value = " ".join(x for x in value.split() if not _ABOUT.search(x))
        words = value.split() if main and tag in _OF_TEXT else _NAME.findall(value)
        if name in ("class", "id") and (tag not in _MAIN or "comment" in value.lower()) and any(w.lower() in _WORDS_OUT for w in words):
            return not (tag == "header" and main)
    return False


def tags(page: str) -> Iterator[tuple[int, int, str, str, str]]:
    """Start, end, slash, name and attributes of each tag; comments and declarations have no
    name. A consumer may send a place to go on at. A quoted value may hold >; once a quote
    or a tag is not closed, tags end at their first >. So the whole page is read once."""
    at, whole = 0, True
    while (start := page.find("<", at)) >= 0:
        slash = name = attributes = ""
        if page.startswith("<!--", start):
            end = page.find("-->", start + 4)
            end = end + 3 if end >= 0 else len(page)
        elif m := _TAG.match(page, start + 1):
            end = -1
            place = m.end()
            while whole:
                stop = _STOP.search(page, place)
                if stop and stop[0] == ">":
                    end = stop.end()
                    break
                close = page.find(stop[0][-1], stop.end()) if stop else -1
                whole = close >= 0
                place = close + 1
            if end < 0:
                end = page.find(">", m.end()) + 1
            if not end:  # no tag from here on
                return
            slash, name, attributes = m[1], m[2].lower(), page[m.end() : end - 1]
        elif page[start + 1 : start + 2] in ("!", "?", "/"):
            end = page.find(">", start) + 1
            if not end:
                return
        else:
            at = start + 1
            continue
        at = (yield start, end, slash, name, attributes) or end


def blocks(page: str, again: bool = False) -> list[Block]:
    """The blocks with text outside of what is left out. ``again``: an article begins also
    within an element that is left out for its class or id."""
    found: list[Block] = []
    texts: list[str] = []
    linked: list[str] = []
    stack: list[tuple[str, bool, bool, bool]] = []  # tag, left out, in the main part, no article within
    out = main = False
    links = breaks = 0

    def flush() -> None:
        nonlocal texts, linked, breaks
        breaks = 0
        if texts:
            text = " ".join(html.unescape("".join(texts)).split())
            if text:
                in_links = len(" ".join(html.unescape("".join(linked)).split()))
                found.append(Block(text, min(1.0, in_links / len(text)), main))
            texts, linked = [], []

    def said(run: str) -> None:
        nonlocal breaks
        if run and not out:
            if run.strip():
                breaks = 0
            texts.append(run)
            if links:
                linked.append(run)

    at, skip, opened, shut = 0, None, Counter(), 0
    scan = tags(page)
    while True:
        try:
            start, end, close, tag, attributes = scan.send(skip)
        except StopIteration:
            break
        said(page[at:start])
        at, skip = end, None
        if not tag:
            continue
        if tag == "br":
            texts.append(" ")
            breaks += 1
            if breaks > 1:
                flush()
            continue
        if tag == "a":
            links = 0 if close else 1
        if tag not in _INLINE:
            flush()
            links = 0 if tag != "a" else links
        if close:
            while opened[tag]:  # all that was opened within
                gone = stack.pop()
                opened[gone[0]] -= 1
                shut -= gone[3]
                if gone[0] == tag:
                    break
            out, main = (stack[-1][1], stack[-1][2]) if stack else (False, False)
        elif tag in _RAW:
            if not attributes.rstrip().endswith("/"):
                ends = _END[tag].search(page, at)
                stop = page.find(">", ends.end()) + 1 if ends else 0
                at = skip = stop or (at if tag in ("title", "noscript", "object") else len(page))
        elif tag not in _VOID and not attributes.rstrip().endswith("/"):
            if tag in _MAIN and out and not shut:
                out = False  # an article ends a header or menu that was never closed
            header = tag == "header" and not main
            leaves = out or header or _left_out(tag, attributes, main)
            if leaves and not out:
                flush()
            closed = tag in _SHUT or tag not in _LEFT_OUT and tag != "header" and leaves and not again
            stack.append((tag, leaves, main or (tag in _MAIN and not leaves), closed))
            opened[tag] += 1
            shut += closed
            out, main = stack[-1][1], stack[-1][2]
    said(page[at:])
    flush()
    return found


def _other_script(text: str) -> bool:
    """Whether most letters are of a script that no language of the stop words has."""
    letters = _LETTERS.sub("", text)
    return 2 * len(_LATIN.sub("", letters)) > len(letters)


def _first(b: Block) -> bool | None:
    if b.link > MUCH_LINK:
        return False
    if len(b.text) < SHORT:
        return False if b.link > SOME_LINK else None
    words = b.text.lower().split()
    stops = sum(w.strip("\"'.,;:!?()[]#*$%&|<>-") in STOP_WORDS for w in words)
    if stops >= STOPS_TEXT * len(words):
        return b.link <= MUCH_LINK
    if b.link <= SOME_LINK:
        return True if not stops and _other_script(b.text) else None
    return None if b.main or stops else False


def classify(found: list[Block]) -> list[Block]:
    """The blocks that are text."""
    if any(b.main for b in found):
        found = [b for b in found if b.main]
    labels = [_first(b) for b in found]
    if True not in labels:
        few = [x is None and b.link <= SOME_LINK for b, x in zip(found, labels, strict=True)]
        long = [x and len(b.text) >= SHORT for b, x in zip(found, few, strict=True)]
        labels = [True if y else x for x, y in zip(labels, long if any(long) else few, strict=True)]
    before, last = [], None
    for i, x in enumerate(labels):
        before.append(last)
        if x is not None:
            last = i
    after, last = [None] * len(labels), None
    for i in range(len(labels) - 1, -1, -1):
        after[i] = last
        if labels[i] is not None:
            last = i
    for i, b in enumerate(found):
        b.good = labels[i]
        if b.good is None:
            p, q = before[i], after[i]
            near = [labels[x] for x in (p, q) if x is not None]
            if b.main:
                b.good = near != [False, False] or (len(b.text) >= SHORT and b.link <= SOME_LINK)
            elif len(near) < 2 or near[0] == near[1]:
                b.good = bool(near) and near[0]
            else:
                b.good = True if i - p == q - i else near[0] if i - p < q - i else near[1]
    return [b for b in found if b.good]


def extract(page: str | None) -> str:
    page = page or ""
    found = blocks(page)
    kept = classify(found)
    if not any(b.main for b in found) and _MARKED.search(page):
        more = blocks(page, again=True)
        article = classify(more) if any(b.main for b in more) else []
        if sum(len(b.text) for b in article) > sum(len(b.text) for b in kept):
            kept = article
    return "\n".join(b.text for b in kept)


def main_text(pages: DataFrame, html: str = "html", name: str = "text") -> DataFrame:
    """The columns of ``pages`` but ``html``, and the text (replacing a column of its name)."""
    kept = [c for c in pages.columns if c not in (html, name)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for rows, _ in pieces(b, len(kept)):
                yield pa.RecordBatch.from_arrays([*rows.columns[:-1], pa.array([extract(x) for x in rows.column(len(kept)).to_pylist()], pa.string())], [*kept, name])

    schema = pages.select(*kept, F.lit("").alias(name)).schema
    return in_batches(pages.select(*kept, html)).mapInArrow(run, schema)
