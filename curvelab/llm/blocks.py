"""Leaf blocks of raw HTML: (path names, text) in page order.

Tags are read as the HTML tokenizer reads them: a value is quoted only behind ``=``, a quote
elsewhere is an ordinary character, and a value whose quote never closes ends with the tag.  From the
first tag on that finds no end that way, tags end at their first ``>``; behind the last ``>`` all is
text.  A stack holds the open elements.  A block is the text between two boundaries of block-level
elements; inline elements and line breaks do not end it.  Elements that HTML closes by
implication (paragraphs, list items, cells, options) are closed so, an end tag without its start
is passed over, and what is open at the end ends there.  Text of scripts, styles and the like is
no text, nor is what stands in a drawing, a template or a list of choices (``select``,
``datalist``), which end with their parent if not before; formulas are inline text, and what
stands in ``object`` and ``noscript`` is text like any other.  Character references are decoded, white
space becomes one space, empty blocks are none.

The work is in proportion to the page: positions of open elements are kept by name, so that no
tag walks the stack, and a path holds each name once.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_right

# fixed values: element names of the HTML standard
RAW = frozenset("script style iframe textarea".split())
#: Their text is not shown with the page.
HIDDEN = frozenset("svg template select datalist".split())
#: Starts that end an open drawing or list of choices.
ENDS_HIDDEN = frozenset(
    "address article aside blockquote body center dd dl dt footer form h1 h2 h3 h4 h5 h6 header main menu nav ol p pre section table ul".split()
)
ENDS_DRAWING = ENDS_HIDDEN | {"div", "li"}
ENDS_CHOICES = ENDS_HIDDEN | {"input", "select", "textarea"}
#: Blocks that may stand in a paragraph without ending it.
SOFT = frozenset("object noscript".split())
VOID = frozenset("area base br col embed hr img input link meta source track wbr param".split())
INLINE = frozenset(
    "a abbr b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var"
    " wbr br img picture source svg template select datalist".split()
)
FORMULA = frozenset(
    "math semantics annotation annotation-xml mrow mi mn mo ms mtext mspace mfrac msqrt mroot mstyle merror mpadded mphantom mfenced"
    " menclose msub msup msubsup munder mover munderover mmultiscripts mprescripts none mtable mtr mlabeledtr mtd maction".split()
)
CLOSED_BY = {
    "li": frozenset(["li"]),
    "dt": frozenset(["dt", "dd"]),
    "dd": frozenset(["dt", "dd"]),
    "tr": frozenset(["tr", "td", "th"]),
    "td": frozenset(["td", "th"]),
    "th": frozenset(["td", "th"]),
    "thead": frozenset(["tr", "td", "th", "thead", "tbody"]),
    "tbody": frozenset(["tr", "td", "th", "thead", "tbody"]),
    "option": frozenset(["option"]),
    "optgroup": frozenset(["option", "optgroup"]),
}
PARAGRAPH = frozenset(["p"])
SCOPES = frozenset("ul ol dl table html body article section div main aside nav header footer form td th blockquote".split())

_START = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)")
_ATTRIBUTES = re.compile(
    r"""((?:[\s/]++|[^\s/>][^\s/>=]*+(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|[^\s>"'][^\s>]*+)?+)?+)*+)>"""
)
_COMMENT = re.compile(r"<!--(?:-?>|.*?(?:--!?>|\Z))", re.S)
_RAW_END = {tag: re.compile(rf"</{tag}(?=[\s/>])[^>]*>", re.I) for tag in RAW}
_MARK = re.compile(r"""(?<![\w-])(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.I)
_NAME = re.compile(r"[A-Za-z]+")


def element_names(tag: str, attributes: str) -> tuple[str, ...]:
    """The tag and the words of its class, id and role, as ``tag`` and ``.word``."""
    if "=" not in attributes:
        return (tag,)
    words = (w.lower() for _, v in _MARK.findall(attributes) for w in _NAME.findall(v))
    return (tag, *dict.fromkeys("." + w for w in words))


class _Reader:
    """The open elements, the text since the last boundary, and the blocks so far."""

    def __init__(self):
        self.stack: list[tuple[str, tuple[str, ...]]] = []
        self.where: dict[str, list[int]] = {}  # tag -> its places in the stack
        self.blocks: list[int] = []  # places of block-level elements
        self.hidden: list[int] = []
        self.names: dict[str, int] = {}  # names on the path, and how often
        self.last: list[str] = []
        self.parts: list[str] = []
        self.linked = 0
        self.out: list[tuple[tuple[str, ...], str, float]] = []

    def text(self, text: str) -> None:
        if text and not self.hidden:
            text = html.unescape(text) if "&" in text else text
            self.parts.append(text)
            if self.where.get("a"):
                self.linked += len(text)

    def boundary(self) -> None:
        text = " ".join("".join(self.parts).split())
        if text:
            path, end = list(self.names), self.last[-3:]
            for n in dict.fromkeys(end):
                path.remove(n)
            self.out.append(((*path, *end), text, min(1.0, self.linked / len(text))))
        self.parts.clear()
        self.linked = 0

    def push(self, tag: str, attributes: str) -> None:
        place = len(self.stack)
        names = () if tag in INLINE else element_names(tag, attributes)
        self.stack.append((tag, names))
        self.where.setdefault(tag, []).append(place)
        if names:
            self.blocks.append(place)
        if tag in HIDDEN:
            self.hidden.append(place)
        for n in names:
            self.names[n] = self.names.get(n, 0) + 1
        self.last += names

    def pop_to(self, place: int) -> None:
        while len(self.stack) > place:
            tag, names = self.stack.pop()
            k = len(self.stack)
            for places in (self.where.get(tag), self.blocks, self.hidden):
                if places and places[-1] == k:
                    places.pop()
            for n in names:
                if self.names[n] == 1:
                    del self.names[n]
                else:
                    self.names[n] -= 1
            if names:
                del self.last[-len(names) :]

    def close_implied(self, closes: frozenset[str]) -> None:
        """Close the outermost of these elements inside the nearest scope."""
        if not any(self.where.get(t) for t in closes):
            return
        limit = max((self.where[t][-1] for t in SCOPES - closes if self.where.get(t)), default=-1)
        inside = []
        for t in closes:
            places = self.where.get(t, [])
            k = bisect_right(places, limit)
            if k < len(places):
                inside.append(places[k])
        if inside:
            self.pop_to(min(inside))

    def end(self, tag: str) -> None:
        if tag == "br":
            self.text(" ")
            return
        places = self.where.get(tag)
        if not places:
            return
        place = places[-1]
        if self.hidden and place < self.hidden[-1]:
            within = self.stack[self.hidden[-1]][0]
            if tag in INLINE or within == "template":
                return
        if tag in INLINE:
            if self.blocks and self.blocks[-1] > place:
                places.pop()  # blocks stand above it: it ends, they stay
                return
        else:
            self.boundary()
        self.pop_to(place)

    def start(self, tag: str, attributes: str) -> None:
        whole = attributes.endswith("/")
        if self.hidden:
            place = self.hidden[-1]
            within = self.stack[place][0]
            foreign = self.where.get("foreignobject")
            ends = ENDS_DRAWING if within == "svg" and not (foreign and foreign[-1] > place) else ENDS_CHOICES
            if within == "template" or (within == "svg" and ends is not ENDS_DRAWING) or tag not in ends:
                if tag not in VOID and not whole and (tag in HIDDEN or tag == "foreignobject"):
                    self.push(tag, "")
                return
            self.pop_to(place)
        if tag in FORMULA:
            return
        if tag in VOID:
            if tag not in INLINE:
                self.boundary()
            elif tag == "br":
                self.text(" ")
            return
        if tag not in INLINE:
            self.boundary()
            if tag in CLOSED_BY:
                self.close_implied(CLOSED_BY[tag])
            elif tag not in SOFT:
                self.close_implied(PARAGRAPH)
        if not whole or (tag in INLINE and tag not in HIDDEN):
            self.push(tag, attributes)


def leaf_blocks(page: str | None) -> list[tuple[tuple[str, ...], str, float]]:
    """(names on the path from the root, each once but for the last three; text; share of the text
    inside links) of every block."""
    page = page or ""
    reader = _Reader()
    last_end = page.rfind(">")
    quotes = True
    at = 0
    while True:
        lt = page.find("<", at)
        if lt < 0 or (lt > last_end and not page.startswith("<!--", lt)):
            reader.text(page[at:])
            break
        m = _START.match(page, lt)
        if m is None:
            reader.text(page[at:lt])
            if page.startswith("<!--", lt):
                at = _COMMENT.match(page, lt).end()
            elif page[lt + 1 : lt + 2] in ("!", "?", "/"):
                at = page.index(">", lt) + 1
            else:
                reader.text("<")
                at = lt + 1
            continue
        reader.text(page[at:lt])
        rest = _ATTRIBUTES.match(page, m.end()) if quotes else None
        if rest is None:
            quotes = False
            at = page.index(">", m.end()) + 1
            attributes = page[m.end() : at - 1]
        else:
            at, attributes = rest.end(), rest[1]
        tag = m[2].lower()
        if m[1]:
            reader.end(tag)
        elif tag in RAW:
            reader.start(tag, "/") if tag in ENDS_CHOICES and reader.hidden else None
            close = _RAW_END[tag].search(page, at)
            at = close.end() if close else len(page)
        else:
            reader.start(tag, attributes)
    reader.boundary()
    return reader.out
