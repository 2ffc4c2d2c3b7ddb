"""Layout-aware rendering of HTML pages.

A tolerant tree builder closes tags that HTML implies (a paragraph ends where a
block begins, an item where the next begins, cells and rows likewise), keeps
what is visible and drops scripts, styles, hidden elements and comments.  The
tree is rendered block by block in page order; each block knows the chain of
elements around it.  ``render`` spaces the blocks, marks list items and aligns
the cells of table rows.
"""

from __future__ import annotations

import html
import re
from dataclasses import dataclass, field

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*)(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_SPACE = re.compile(r"\s+")
_HIDING = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is text of another kind and ends at their end tag only.
RAW = frozenset("script style noscript template textarea iframe object svg math canvas audio video title".split())
UNSEEN = RAW | {"head", "select", "datalist"}
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img input ins kbd label mark meter q s samp small span strike strong sub sup time tt u var wbr button output progress ruby rt rp rb link meta base source track area param embed".split()
)
#: What an opening tag closes, as far as the nearest of the fences around it.
_LISTS, _TABLES = frozenset({"ul", "ol", "menu", "dir"}), frozenset({"table"})
_CELL, _ROW = frozenset({"td", "th"}), frozenset({"tr"})
_GROUPS = frozenset({"thead", "tbody", "tfoot"})
CLOSES = (
    {"li": (frozenset({"li"}), _LISTS), "dt": (frozenset({"dt", "dd"}), frozenset({"dl"})), "dd": (frozenset({"dt", "dd"}), frozenset({"dl"}))}
    | {t: (_CELL, _TABLES | _ROW) for t in _CELL}
    | {"tr": (_ROW, _TABLES)}
    | {t: (_GROUPS, _TABLES) for t in _GROUPS}
    | {t: (frozenset({t}), frozenset({"select"})) for t in ("option", "optgroup")}
)
HEADINGS = frozenset(f"h{i}" for i in range(1, 7))


@dataclass(slots=True)
class Element:
    """An open or closed element of the tree."""

    tag: str
    parent: Element | None
    number: int
    shown: bool = True


@dataclass(slots=True)
class Block:
    """A run of visible text between block boundaries."""

    element: Element  # the nearest block element around it
    text: str
    linked: int  # characters of it within links
    links: int
    heading: str = ""


@dataclass
class Page:
    blocks: list[Block] = field(default_factory=list)
    elements: list[Element] = field(default_factory=list)
    title: str = ""

    def chain(self, block: Block) -> list[Element]:
        """The elements around a block, outermost first."""
        out, at = [], block.element
        while at is not None:
            out.append(at)
            at = at.parent
        return out[::-1]


def decode(data: bytes, content_type: str | None) -> str:
    """Text of a payload: by byte order mark, UTF-8 if valid, else the declared or the western charset."""
    for mark, name in ((b"\xef\xbb\xbf", "utf-8"), (b"\xff\xfe", "utf-16-le"), (b"\xfe\xff", "utf-16-be")):
        if data.startswith(mark):
            return data[len(mark) :].decode(name, "replace")
    try:
        return data.decode("utf-8")
    except UnicodeDecodeError:
        pass
    charset = rb"charset\s*=\s*[\"']?\s*([\w.:-]+)"
    declared = re.search(charset, (content_type or "").encode("utf-8", "replace") + b"\n" + data[:4096], re.I)
    # Long scripts or styles may stand before the declaration.
    declared = declared or re.search(rb"<meta\b[^>]*?" + charset, data, re.I)
    name = declared[1].decode("ascii", "replace").lower() if declared else "cp1252"
    if name in ("utf-8", "utf8", "iso-8859-1", "latin-1", "latin1", "ascii", "us-ascii"):
        name = "cp1252"
    try:
        return data.decode(name, "replace")
    except LookupError:
        return data.decode("cp1252", "replace")


class _Builder:
    def __init__(self) -> None:
        self.page = Page()
        self.root = Element("#root", None, 0)
        self.page.elements.append(self.root)
        self.open: list[Element] = [self.root]
        self.text: list[str] = []
        self.linked = self.links = 0
        self.in_link = 0
        self.at: Element | None = None

    def flush(self) -> None:
        if self.text:
            text = _SPACE.sub(" ", "".join(self.text)).strip()
            if text:
                at = self.at or self.root
                heading = next((e.tag for e in self._up(at) if e.tag in HEADINGS), "")
                self.page.blocks.append(Block(at, text, min(self.linked, len(text)), self.links, heading))
            self.text = []
        self.linked = self.links = 0
        self.at = None

    @staticmethod
    def _up(e: Element | None):
        while e is not None:
            yield e
            e = e.parent

    def add(self, raw: str) -> None:
        top = self.open[-1]
        if not top.shown or not raw:
            return
        text = html.unescape(raw) if "&" in raw else raw
        if not self.text and text.isspace():
            return
        if self.at is None:
            self.at = next((e for e in self._up(top) if e.tag not in INLINE), self.root)
        self.text.append(text)
        if self.in_link:
            self.linked += len(_SPACE.sub(" ", text).strip())

    def start(self, tag: str, attributes: str, closed: bool) -> None:
        if tag == "br":
            self.flush()
            return
        if tag not in INLINE:
            self.flush()
            if tag in CLOSES:
                self.close_to(*CLOSES[tag])
            if tag not in VOID:
                # A paragraph (or heading) ends where a block begins.
                self.close_to(HEADINGS | {"p"} if tag in HEADINGS else frozenset({"p"}), frozenset({"td", "th", "li", "div", "button", "table"}))
        if tag in VOID or closed and tag not in RAW:
            return
        top = self.open[-1]
        shown = top.shown and tag not in UNSEEN
        if shown and attributes and not attributes.isspace():
            for m in _ATTRIBUTE.finditer(attributes):
                name = m[1].lower()
                if name == "hidden" or name == "style" and _HIDING.search(m[2] or m[3] or m[4] or ""):
                    shown = False
        element = Element(tag, top, len(self.page.elements), shown)
        self.page.elements.append(element)
        self.open.append(element)
        if tag == "a" and shown:
            self.in_link += 1
            self.links += 1

    def close_to(self, tags: frozenset[str], fences: frozenset[str]) -> None:
        for i in range(len(self.open) - 1, 0, -1):
            tag = self.open[i].tag
            if tag in tags:
                self.cut(i)
                return
            if tag in fences or tag not in INLINE and tag not in ("p", "li", "td", "th", "dt", "dd", "option"):
                return

    def cut(self, i: int) -> None:
        for e in self.open[i:]:
            if e.tag == "a" and e.shown:
                self.in_link -= 1
        del self.open[i:]

    def end(self, tag: str) -> None:
        if tag not in INLINE:
            self.flush()
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].tag == tag:
                self.cut(i)
                return
            if tag in INLINE and self.open[i].tag not in INLINE:
                return


def parse(text: str) -> Page:
    """The tree and visible blocks of a page."""
    builder = _Builder()
    at, n = 0, len(text)
    while at < n:
        m = _TOKEN.search(text, at)
        if m is None:
            builder.add(text[at:])
            break
        if m.start() > at:
            builder.add(text[at : m.start()])
        at = m.end()
        name = m[2]
        if name is None:
            continue
        tag = name.lower()
        if m[1]:
            builder.end(tag)
            continue
        attributes = m[3]
        builder.start(tag, attributes, attributes.endswith("/"))
        if tag in RAW:
            close = re.compile(rf"</{tag}\b[^>]*>", re.I).search(text, at)
            if close is None:
                break
            if tag == "title" and not builder.page.title:
                builder.page.title = text[at : close.start()]
            at = close.end()
            builder.end(tag)
    builder.flush()
    return builder.page


def render(page: Page, kept: set[int] | None = None) -> str:
    """Visible text with blank lines between blocks, list marks and aligned table cells.

    ``kept`` names the blocks to show by their places; all of them if none are named.
    """
    out: list[str] = []
    table: list[list[str]] = []
    row: Element | None = None

    def end_table() -> None:
        width = [max(len(r[i]) for r in table if i < len(r)) for i in range(max((len(r) for r in table), default=0))]
        out.extend("  ".join(c.ljust(width[i]) for i, c in enumerate(r)).rstrip() for r in table)
        table.clear()

    for place, block in enumerate(page.blocks):
        if kept is not None and place not in kept:
            continue
        chain = page.chain(block)
        own = next((e for e in reversed(chain) if e.tag == "tr"), None)
        if own is not None and block.element.tag in _CELL:
            if own is row and table:
                table[-1].append(block.text)
            else:
                table.append([block.text])
            row = own
            continue
        if table:
            end_table()
            row = None
        if block.element.tag == "li":
            out.append("  " * max(0, sum(e.tag in _LISTS for e in chain) - 1) + "- " + block.text)
        else:
            if out:
                out.append("")
            out.append(block.text)
    if table:
        end_table()
    return "\n".join(out)
