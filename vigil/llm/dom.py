"""A tolerant reader of HTML into block nodes and runs of text.

Block-level elements are the nodes of the tree; inline markup only adds to
their text.  A run is the text of one block between two block boundaries, with
character references decoded and white space turned into single blanks.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import defaultdict
from html import unescape

#: Fixed sets of HTML element names.
BLOCKS = frozenset(
    "html body main article section div header footer nav aside p h1 h2 h3 h4 h5 h6 hgroup ul ol li dl dt dd table "
    "caption thead tbody tfoot tr td th blockquote pre figure figcaption address details summary fieldset legend form "
    "dialog menu center search hr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is never text of the page.
SILENT = frozenset("head script style template noscript iframe object svg math canvas textarea select button title "
                   "audio video map datalist".split())
RAW = frozenset("script style textarea title iframe noscript".split())
#: Inline end tags do not reach out of these.
WALLS = frozenset(("table", "article", "body"))
#: A start tag ends these open elements (up to the nearest listed boundary).
_P_ENDS = BLOCKS
_IMPLIED = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
            "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
            "tbody": ({"thead", "tbody", "tr", "td", "th"}, {"table"}), "tfoot": ({"thead", "tbody", "tr", "td", "th"}, {"table"})}
_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>"
                  r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)", re.S)
_ATTR = re.compile(r"""([^\s"'=<>/]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


class Page:
    """Block nodes in document order: parent, tag, attributes, text and link lengths; runs (node, text)."""

    __slots__ = ("parent", "tag", "attrs", "chars", "linked", "runs")

    def __init__(self) -> None:
        self.parent, self.tag, self.attrs = [-1], ["#page"], [{}]
        self.chars, self.linked, self.runs = [0], [0], []


def attributes(text: str) -> dict[str, str]:
    if not text or "=" not in text and not text.strip(" /"):
        return {}
    return {m[1].lower(): unescape(m[2] or m[3] or m[4] or "") for m in _ATTR.finditer(text)}


def read(html: str) -> Page:
    page = Page()
    stack: list[tuple[str, int]] = [("#page", 0)]  # open elements with the block node that they are in
    where: dict[str, list[int]] = defaultdict(list)  # their places in the stack, by name
    blocks: list[int] = [0]  # places of open blocks
    walls: list[int] = [0]   # places of open tables, articles and bodies
    buffer: list[str] = []
    links = linked = silent = 0
    pos, n = 0, len(html)

    def flush() -> None:
        nonlocal linked
        if buffer:
            node = stack[-1][1]
            text = " ".join("".join(buffer).split())
            if text:
                page.runs.append((node, text))
                page.chars[node] += len(text)
                page.linked[node] += linked
            buffer.clear()
        linked = 0

    def close(k: int) -> None:
        """Ends the open elements from place k of the stack on."""
        nonlocal links, silent
        if blocks[-1] >= k:
            flush()
        for t, _ in stack[k:]:
            links -= t == "a"
            silent -= t in SILENT or t == "#hidden"
            where[t].pop()
        del stack[k:]
        for places in (blocks, walls):
            while places[-1] >= k:
                places.pop()

    def push(name: str, node: int) -> None:
        k = len(stack)
        stack.append((name, node))
        where[name].append(k)
        if name in BLOCKS:
            blocks.append(k)
        if name in WALLS:
            walls.append(k)

    def nearest(names) -> int:
        """Place of the innermost open element of these names, or 0."""
        return max((where[t][-1] for t in names if where[t]), default=0)

    for m in _TAG.finditer(html):
        if m.start() < pos:  # inside raw text
            continue
        if m.start() > pos and not silent:
            piece = unescape(html[pos:m.start()])
            buffer.append(piece)
            if links:
                linked += len(piece.strip())
        pos = m.end()
        name = m[2] or m[5]
        if not name:
            continue
        name = name.lower()
        if m[1] or m[4]:
            k = nearest((name,))
            if k and (name in BLOCKS or name in SILENT or walls[-1] <= k):  # a stray inline end tag ends nothing outside
                close(k)
            continue
        attrs = attributes(m[3] or m[6] or "")
        if name in BLOCKS:
            if stack[blocks[-1]][0] == "p":  # a paragraph ends where a block begins
                close(blocks[-1])
            if name in _IMPLIED:
                ends, bounds = _IMPLIED[name]
                bound = nearest(bounds)
                cut = min((where[t][i] for t in ends if (i := bisect_right(where[t], bound)) < len(where[t])), default=0)
                if cut:
                    close(cut)
            flush()
            if name in ("html", "body") and where[name]:
                continue
            page.parent.append(stack[-1][1])
            page.tag.append(name)
            page.attrs.append(attrs)
            page.chars.append(0)
            page.linked.append(0)
            if name in VOID:
                continue
            hidden = "hidden" in attrs or attrs.get("aria-hidden") == "true" or _HIDDEN.search(attrs.get("style", ""))
            push(name, len(page.tag) - 1)
            if hidden:
                push("#hidden", len(page.tag) - 1)
                silent += 1
        elif name in VOID:
            if name == "br":
                buffer.append(" ")
        else:
            push(name, stack[-1][1])
            links += name == "a"
            if name in SILENT:
                silent += 1
                if name in RAW:
                    end = re.compile(rf"</{re.escape(name)}\s*/?>", re.I).search(html, pos)
                    pos = end.end() if end else n
                    close(len(stack) - 1)
    if pos < n and not silent:
        rest = html[pos:]
        buffer.append(unescape(rest))
    flush()
    return page
