"""Main text of web pages by tag-path ratios."""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

#: A path is content when its fused, smoothed ratio is above this many standard deviations of the page's nodes.
DEVIATIONS = 0.8
#: Reach of the Gaussian that smooths ratios along the page, in text nodes.
REACH = 2
#: A named part is no side part but a wrapper when it holds this share of the text that is not in other side parts.
WRAPPER_SHARE = 0.8

# Element names of HTML and the usual names of page parts.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea noscript iframe noframes xmp".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol optgroup option p pre search section "
    "summary table tbody td tfoot th thead tr ul".split())
LEAVES = frozenset("p h1 h2 h3 h4 h5 h6 li blockquote pre dd dt td th figcaption summary caption".split())
OTHER_PARTS = frozenset(
    "nav footer aside button select option textarea label fieldset menu dialog template svg canvas head "
    "script style title noscript iframe noframes xmp object audio video search".split())
OTHER_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar toolbar".split())
OTHER_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner cookie cookies "
    "consent gdpr notice notices alert sidebar sidebars rail menu menus nav navbar navigation breadcrumb breadcrumbs "
    "header masthead topbar footer foot comment comments commentlist disqus replies reply respond share sharing social "
    "related recommended recommendations newsletter subscribe subscription signup login popup modal overlay widget "
    "widgets toolbar pagination pager skip tracking form search".split())
WHOLE_NAMES = frozenset("p h1 h2 h3 h4 h5 h6".split())
MAIN_NAMES = frozenset("article main".split())
CLOSES = {"li": ("li", {"ul", "ol", "menu"}), "dt": ("dt dd", {"dl"}), "dd": ("dt dd", {"dl"}), "tr": ("tr td th", {"table"}),
          "td": ("td th", {"tr", "table"}), "th": ("td th", {"tr", "table"}), "option": ("option", {"select"})}

# Names and attributes give nothing back once matched, so no place is looked at twice.
END_TAG = re.compile(r"</([a-zA-Z][^\s/>]*+)[^>]*+>")
START_TAG = re.compile(r"<([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>")
BROKEN_TAG = re.compile(r"<([a-zA-Z][^\s/>]*+)([^>]*+)>")
ATTRIBUTE = re.compile(r"(class|id|role|hidden|style|aria-hidden)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?(?=[\s/]|\Z)", re.I)
NAME_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
MARKS = re.compile(r"[.,;:!?…。、，；：！？¿¡«»“”\"()]")
RAW_END = {name: re.compile(rf"</{name}(?=[\s/>])[^>]*>|\Z", re.I) for name in RAW}


class Element:
    __slots__ = ("name", "path", "other", "main", "number", "parent", "named", "block")

    def __init__(self, name, path, other, main, number, parent, named=None):
        self.name, self.path, self.other, self.main, self.number, self.parent = name, path, other, main, number, parent
        self.named = named  # the innermost element around it, or itself, whose names say that it is a side part
        self.block = self if parent is None or name in BLOCKS else parent.block  # the innermost block it is in


def _described(element: str, attributes: str) -> tuple[bool, bool, str]:
    """Whether an element is hidden; whether names or role say that it is not the article's text; a label for its
    path. Headings and paragraphs are told by whole names only."""
    if not attributes:
        return False, False, ""
    hidden, other, label = False, False, ""
    whole = element in WHOLE_NAMES
    for m in ATTRIBUTE.finditer(attributes):
        name, value = m[1].lower(), html.unescape(m[2] or m[3] or m[4] or "")
        if name in ("class", "id"):
            label += f".{value}"
            other |= any(part.lower() in OTHER_NAMES for part in (value.split() if whole else NAME_PART.findall(value)))
        elif name == "role":
            other |= value.lower() in OTHER_ROLES
        elif name == "style":
            hidden |= re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I) is not None
        else:
            hidden |= name == "hidden" or value.lower() == "true"
    return hidden, other, label


def _keep_wrappers(nodes: list[tuple[int, str, Element, Element]]) -> None:
    """Marks the elements of text in named side parts as other, but for parts that hold nearly all the text
    that is not in side parts: they are wrappers around the article, whatever their names."""
    inside, own, free, total, holds = {}, {}, 0, 0, set()
    for _, value, e, _ in nodes:
        if not e.other:
            score = len(value.strip()) * (1 + len(MARKS.findall(value)))
            total += score
            if e.named is None:
                free += score
            else:
                own[e.named] = own.get(e.named, 0) + score
                if e.main > e.named.number:
                    holds.add(e.named)
    above = lambda e: e.parent.named
    parts = set()
    for part in own:
        while part is not None and part not in parts:
            parts.add(part)
            part = above(part)
    order = sorted(parts, key=lambda e: e.number)
    for part in reversed(order):
        inside[part] = inside.get(part, 0) + own.get(part, 0)
        if above(part) is not None:
            inside[above(part)] = inside.get(above(part), 0) + inside[part]
            if part in holds:
                holds.add(above(part))
    dropped = set()
    for part in order:
        if above(part) in dropped or inside[part] < WRAPPER_SHARE * (inside[part] + free) or (
                part not in holds and 2 * inside[part] < total):
            dropped.add(part)
        else:
            free += own.get(part, 0)
    for _, _, e, _ in nodes:
        e.other = e.other or (e.named is not None and (e.named in dropped or e.named not in parts))


def tags(page: str) -> Iterator[tuple[int, int, str, str, str]]:
    """(start, end, closed name, opened name, attributes) of the tags, comments and declarations of a page in
    order; ``at`` may be sent to go on there. A tag that no ``>`` ends is text. A page is read once: where quotes
    of a tag are never closed, they are plain characters from there on."""
    at, last, quotes = 0, page.rfind(">"), True
    while (start := page.find("<", at)) >= 0:
        mark, found = page[start + 1:start + 2], None
        if page.startswith("<!--", start):
            end = page.find("-->", start + 4) + 3
            found = start, end if end > 2 else len(page), "", "", ""
        elif mark in ("!", "?"):
            found = start, page.find(">", start) + 1 or len(page), "", "", ""
        elif start > last:
            pass
        elif mark == "/":
            tag = END_TAG.match(page, start)
            found = tag and (start, tag.end(), tag[1], "", "")
        elif mark.isascii() and mark.isalpha():
            tag = START_TAG.match(page, start) if quotes else None
            if tag is None:
                quotes, tag = False, BROKEN_TAG.match(page, start)
            found = start, tag.end(), "", tag[1], tag[2]
        at = start + 1
        if found:
            at = found[1]
            sent = yield found
            if sent is not None:
                at = sent
                yield found


def text_nodes(page: str) -> list[tuple[int, str, Element, Element]]:
    """(block number, text, element, block element) of every text node in page order, white space kept.

    Start tags close what HTML says they close; end tags without a start are ignored; a tag that never
    ends is text.
    """
    paths: dict[tuple[int, str], int] = {}
    root = Element("", 0, False, 0, 0, None)
    stack, open_names, found = [root], {}, []
    number, block, at, last, found_tags = 0, 0, 0, page.rfind(">"), tags(page)
    regions = set()  # numbers of main elements; what they hold, articles too, is one region

    def pop_to(names, stops) -> None:
        for k in range(len(stack) - 1, 0, -1):
            if stack[k].name in names:
                for gone in stack[k:]:
                    open_names[gone.name] -= 1
                del stack[k:]
                return
            if stack[k].name in stops:
                return

    def text(value: str) -> None:
        if value:
            found.append((block, html.unescape(value), stack[-1], stack[-1].block))

    for start, stop, closed, name, attributes in found_tags:
        text(page[at:start])
        at, closed, name = stop, closed.lower(), name.lower()
        if closed:
            block += closed in BLOCKS
            if open_names.get(closed):
                pop_to((closed,), ())
        elif name:
            if name in BLOCKS or name == "br":
                block += 1
                if open_names.get("p") and name != "br":
                    pop_to(("p",), ("td", "th", "table", "button", "object", "template"))
            if name in CLOSES:
                same, stops = CLOSES[name]
                if any(open_names.get(s) for s in same.split()):
                    pop_to(same.split(), stops)
            if name in VOID:
                continue
            if name in RAW:
                at = RAW_END[name].search(page, at).end() if at <= last else len(page)
                found_tags.send(at)
                continue
            above = stack[-1]
            hidden, other, label = _described(name, attributes)
            number += 1
            main = above.main
            if name in MAIN_NAMES or re.search(r"\brole\s*=\s*[\"']?main\b", attributes):
                main, hidden, other = (main if main in regions else number), False, False
                if name != "article":
                    regions.add(main)
            elif name in ("html", "body"):
                hidden = other = False
            path = paths.setdefault((above.path, name + label), len(paths) + 1)
            named = other or name == "form"
            other = above.other or hidden or name in OTHER_PARTS or (name == "header" and not above.main)
            if not attributes.endswith("/") or name not in ("svg", "path", "g"):
                stack.append(Element(name, path, other, main, number, above, above.named))
                if named:
                    stack[-1].named = stack[-1]
                open_names[name] = open_names.get(name, 0) + 1
    text(page[at:])
    _keep_wrappers(found)
    return found


def content_paths(nodes: list[tuple[int, str, Element, Element]]) -> np.ndarray:
    """Whether each text node is content by its tag path.

    Text length and punctuation are summed per root-to-leaf path and divided by the path's number of
    nodes; the two ratios are fused by their product, so that a path needs both; the node sequence is
    smoothed; nodes above the threshold, and the best one, are content. Parts that their names mark as
    something else have the ratio 0.
    """
    path = np.array([n[2].path for n in nodes])
    _, at = np.unique(path, return_inverse=True)
    count = np.bincount(at)
    length = np.bincount(at, [len(n[1].strip()) for n in nodes]) / count
    marks = np.bincount(at, [len(MARKS.findall(n[1])) for n in nodes]) / count
    other = np.array([n[2].other for n in nodes])
    fused = np.where(other, 0.0, (length * (1 + marks))[at])
    kernel = np.exp(-0.5 * (np.arange(-REACH, REACH + 1) / 1.0) ** 2)
    smooth = np.convolve(fused, kernel / kernel.sum(), "full")[REACH:REACH + len(fused)]
    smooth[other] = 0.0
    chosen = smooth > DEVIATIONS * smooth.std()
    if smooth.max() > 0:
        chosen[smooth.argmax()] = True
    return chosen & ~other


def main_text(page: str | None) -> str:
    """The article's blocks, one a line. Content paths say which article (or, where the page marks none, which
    parent element) holds the text; every block of it counts, but for parts that are named as something else."""
    nodes = [n for n in text_nodes(page or "") if n[1].strip() or not n[2].other]
    if not nodes:
        return ""
    chosen = content_paths(nodes)
    mains = {n[2].main for n, c in zip(nodes, chosen) if c}
    marked = mains - {0}
    holders = {n[3].parent.number for n, c in zip(nodes, chosen) if c and n[3].name in LEAVES and n[3].parent}
    blocks: dict[int, list[str]] = {}
    for (block, text, element, own), c in zip(nodes, chosen):
        if element.other:
            continue
        if marked:
            inside = element.main in marked
        else:
            inside = c or (own.name in LEAVES and own.parent is not None and own.parent.number in holders)
        if inside or (not text.strip() and block in blocks):
            blocks.setdefault(block, []).append(text)
    joined = (" ".join("".join(parts).split()) for parts in blocks.values())
    return "\n".join(b for b in joined if b)


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url and text of every row of ``pages`` (page_id, url, html), from the whole html.

    Character references are decoded, white space in a block is one space, blocks are joined by one
    newline, a line break is the end of a block. A null or empty page, and one without an article, has an
    empty text. Rows that repeat are rows of the result each; an empty table gives an empty result; other
    columns are not read. Each page is one row of one task, nothing moves.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pa.array([main_text(p) for p in batch.column(2).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), texts], ["page_id", "url", "text"])

    slim = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"))
    return slim.mapInArrow(run, "page_id long, url string, text string")
