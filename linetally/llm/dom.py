"""Block structure of an HTML page: elements that hold blocks of text, and the blocks in page order."""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from html import unescape

# Element names of HTML by their role.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s samp small span strike strong sub sup "
    "time tt u var wbr img br input picture".split()
)
TRANSPARENT = frozenset("html head body".split())
#: Start tags that close an open element of the named kinds.
CLOSES = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
    "thead": ("tr",), "tbody": ("thead", "tr"), "tfoot": ("tbody", "tr"), "option": ("option",),
}
#: Open elements that such closing does not reach beyond.
FENCES = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("table", "tr"), "th": ("table", "tr")}

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>?|</([a-zA-Z][^\s/>]*)[^>]*>?"
    r"|<([a-zA-Z][^\s/>]*)((?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+'|[^\s>]*+))*+)>?",
    re.S,
)
_ATTRIBUTE = re.compile(r"""([^\s=/"']+)\s*(?:=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
_WANTED = ("class", "id", "role", "itemprop", "hidden", "style", "aria-hidden")


@dataclass(slots=True)
class Element:
    """A block element; ``parts`` are its children (elements by number) and blocks of text (complement of their number)."""

    tag: str
    names: dict[str, str]
    parent: int
    parts: list[int] = field(default_factory=list)


@dataclass(slots=True)
class Page:
    elements: list[Element]
    blocks: list[str]
    linked: list[int]  # code points of each block inside links


def _attributes(text: str) -> dict[str, str]:
    found = {}
    for name, *values in _ATTRIBUTE.findall(text):
        name = name.lower()
        if name in _WANTED and name not in found:
            found[name] = unescape(next((v for v in values if v), ""))
    return found


def parsed(html: str) -> Page:
    """The page's elements, parents first, and its blocks: white space as one space, trimmed, references decoded.

    End tags that HTML leaves out are supplied; an end tag without its start is passed over; what is never closed ends with
    the page. Scripts, styles and the like leave nothing behind.
    """
    elements = [Element("body", {}, -1)]
    page = Page(elements, [], [])
    stack = [0]
    pieces: list[tuple[str, bool]] = []
    links = 0

    def flush() -> None:
        nonlocal pieces
        if pieces:
            words = unescape("".join(t for t, _ in pieces)).split()
            if words:
                elements[stack[-1]].parts.append(~len(page.blocks))
                page.blocks.append(" ".join(words))
                page.linked.append(sum(len(unescape(t).strip()) for t, linked in pieces if linked))
            pieces = []

    def close(to: int) -> None:
        """Close open elements until ``to`` are left."""
        flush()
        del stack[to:]

    def open_of(tags: tuple[str, ...], fences: tuple[str, ...]) -> int:
        for k in range(len(stack) - 1, 0, -1):
            tag = elements[stack[k]].tag
            if tag in tags:
                return k
            if tag in fences:
                break
        return 0

    at, end = 0, len(html)
    while at < end:
        mark = html.find("<", at)
        if mark < 0:
            mark = end
        if mark > at:
            pieces.append((html[at:mark], links > 0))
        if mark == end:
            break
        m = _TOKEN.match(html, mark)
        if not m:
            pieces.append(("<", links > 0))
            at = mark + 1
            continue
        at = m.end()
        closing, opening = m.group(1), m.group(2)
        if closing:
            tag = closing.lower()
            if tag == "a":
                links = 0
            elif tag in TRANSPARENT or tag not in INLINE and tag not in VOID:
                k = open_of((tag,), ("table", "td", "th") if tag in ("p", "li") else ()) if tag not in TRANSPARENT else 0
                close(k) if k else flush()
        elif opening:
            tag = opening.lower()
            if tag in RAW:
                stop = re.compile(rf"</{tag}[\s/>]|</{tag}\Z", re.I).search(html, at)
                at = html.find(">", stop.start()) + 1 or end if stop else end
                if tag == "textarea":
                    flush()
            elif tag == "a":
                links = 1
            elif tag in ("br", "wbr", "img"):
                pieces.append((" " if tag == "br" else "", False))
            elif tag in TRANSPARENT or tag in ("hr",):
                flush()
            elif tag not in INLINE and tag not in VOID:
                k = open_of(CLOSES[tag], FENCES.get(tag, ("table",))) if tag in CLOSES else 0
                p = open_of(("p",), ("table", "td", "th", "button", "object"))  # a block ends an open paragraph
                k = min(x for x in (k, p) if x) if k or p else 0
                close(k) if k else flush()
                elements[stack[-1]].parts.append(len(elements))
                elements.append(Element(tag, _attributes(m.group(3)) if m.group(3) else {}, stack[-1]))
                if not m.group(0).endswith("/>") or tag not in ("svg", "path"):
                    stack.append(len(elements) - 1)
    flush()
    return page
