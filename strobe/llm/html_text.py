"""HTML extraction by layout-aware rendering.

Tags build a tree, with the end tags that HTML leaves out implied; rules of
visibility drop what a browser does not show (scripts, styles, the head,
comments, hidden elements).  All visible text is rendered: blocks on lines of
their own with the spacing of paragraphs and headings, list items with bullets
or numbers and indentation, preformatted text as it stands, and table cells
padded to columns.

Defined results: null or empty pages render as an empty text; broken markup
never fails; elements nested deeper than DEPTH are laid out at that depth,
with their visible text; all options of a list are shown; of a drawing, its
texts, each on a line; rows that repeat an id are rendered each.
"""

from __future__ import annotations

import functools
import html
import re
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEPTH = 120

#: Fixed values of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
UNSEEN = frozenset("head script style template noscript title iframe object audio video canvas datalist annotation annotation-xml".split())
#: Of a drawing, elements with text, and those that are drawn by reference only.
DRAWN = frozenset("text foreignobject".split())
UNDRAWN = frozenset("defs desc metadata symbol clippath mask pattern marker".split())
RAW = frozenset("script style title textarea xmp iframe noscript template".split())
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup html legend li main menu nav ol p pre section summary table tbody td tfoot th thead "
    "tr ul caption hr".split()
)
#: Besides blocks, elements that end an open drawing.
BREAKOUT = frozenset("b big br code em embed font i img nobr s small span strike strong sub sup tt u var".split())
#: On lines of their own as well, though paragraphs may hold them.
LINES = frozenset("option optgroup".split())
#: Blocks set off by an empty line.
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl pre blockquote table figure hr".split())
#: An opening tag ends these open elements, up to the given scope.
IMPLIED = {
    "option": (frozenset(["option"]), frozenset(["select", "datalist"])),
    "optgroup": (frozenset(["option", "optgroup"]), frozenset(["select", "datalist"])),
    "li": (frozenset(["li"]), frozenset(["ul", "ol", "menu", "dir"])),
    "dt": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "dd": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "tr": (frozenset(["tr", "td", "th"]), frozenset(["table"])),
    "td": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "th": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "tbody": (frozenset(["tbody", "thead", "tfoot", "tr", "td", "th", "caption"]), frozenset(["table"])),
    "thead": (frozenset(["tbody", "thead", "tfoot", "tr", "td", "th", "caption"]), frozenset(["table"])),
    "tfoot": (frozenset(["tbody", "thead", "tfoot", "tr", "td", "th", "caption"]), frozenset(["table"])),
}
SCOPES = frozenset("table td th caption button object html".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[(?P<cdata>.*?)(?:\]\]>|\Z)|<[!?][^>]*>?"
    r"|</(?P<close>[A-Za-z][^\s/>]*)[^>]*>?"
    r"|<(?P<open>[A-Za-z][^\s/>]*)(?P<attrs>(?:[^>\"']++|\"[^\"]*\"|'[^']*'|[\"'])*+)>?"
    r"|(?P<text>[^<]+|<)",
    re.S,
)
_ATTRIBUTE = re.compile(r"([^\s\"'>/=][^\s/>=]*)(?:\s*=\s*(?:\"([^\"]*)\"?|'([^']*)'?|([^\s>]+)))?")
_SPACES = re.compile(r"[ \t\n\r\f]+")
_START = re.compile(r"\s*(\d{1,9})")


def attributes(raw: str) -> dict[str, str]:
    """Values by lower-case name; the first of a name counts."""
    out: dict[str, str] = {}
    for name, double, single, bare in _ATTRIBUTE.findall(raw):
        out.setdefault(name.lower(), html.unescape(double or single or bare))
    return out


def _unseen(tag: str, attrs: dict[str, str]) -> bool:
    """Whether an element's name or attributes hide it."""
    if tag in UNSEEN or "hidden" in attrs or (tag == "input" and attrs.get("type", "").lower() == "hidden"):
        return True
    style = {}
    for part in attrs.get("style", "").lower().split(";"):
        name, _, value = part.partition(":")
        style[name.strip()] = value.replace("!important", "").strip()
    return style.get("display") == "none" or style.get("visibility") == "hidden"


class Node:
    """An element; drawing: whether it is within one, mute: whether its own
    texts are not shown there."""

    __slots__ = ("tag", "attrs", "children", "hidden", "drawing", "mute")

    def __init__(self, tag: str, attrs: dict[str, str] | None = None, hidden: bool = False):
        self.tag, self.attrs, self.hidden, self.children = tag, attrs or {}, hidden, []
        self.drawing = self.mute = False

    def within(self, parent: Node) -> None:
        self.drawing = self.tag == "svg" or (parent.drawing and parent.tag != "foreignobject")
        self.mute = self.drawing and self.tag not in DRAWN and (self.tag == "svg" or parent.mute)
        self.hidden = self.hidden or (self.drawing and self.tag in UNDRAWN)


class Open:
    """The open elements, with the places of each tag, so that a page of any
    depth is read in linear time."""

    def __init__(self) -> None:
        self.nodes = [Node("html")]
        self.places: dict[str, list[int]] = {}

    def push(self, node: Node) -> None:
        self.places.setdefault(node.tag, []).append(len(self.nodes))
        self.nodes.append(node)

    def cut(self, at: int) -> None:
        """End the elements from a place on."""
        while len(self.nodes) > at:
            self.places[self.nodes.pop().tag].pop()

    def last(self, tags) -> int:
        """Place of the innermost element of some tags, 0 for none."""
        return max((self.places[t][-1] for t in tags if self.places.get(t)), default=0)

    def first_after(self, tags, place: int) -> int:
        """Place of the outermost element of some tags beyond a place."""
        found = (own[bisect_right(own, place)] for t in tags if (own := self.places.get(t)) and own[-1] > place)
        return min(found, default=0)


def parse(page: str) -> Node:
    """Tree of a page; children are nodes and texts."""
    stack = Open()
    root = stack.nodes[0]
    at, size = 0, len(page)
    while at < size:
        m = _TOKEN.match(page, at)
        at = m.end()
        kind = m.lastgroup
        top = stack.nodes[-1]
        if kind == "text":
            if not top.mute:
                top.children.append(html.unescape(m["text"]) if "&" in m["text"] else m["text"])
        elif kind == "cdata":
            if not top.mute:
                top.children.append(m["cdata"])
        elif m["open"]:
            tag, raw = m["open"].lower(), m["attrs"] or ""
            if tag in ("html", "body") and len(stack.nodes) > 1 and (tag == "html" or stack.places.get(tag)):
                continue
            _imply(stack, tag)
            top = stack.nodes[-1]
            attrs = attributes(raw) if raw else {}
            node = Node(tag, attrs, _unseen(tag, attrs))
            node.within(top)
            if tag == "optgroup" and attrs.get("label"):
                node.children.append(attrs["label"])
            leaf = tag in RAW or tag in VOID or raw.endswith("/")
            if leaf or len(stack.nodes) < DEPTH:
                top.children.append(node)
            elif not node.hidden:
                # laid out as part of the element at that depth
                if tag in BLOCKS or tag in LINES:
                    top.children.append(Node("div"))
                top.children += node.children
                node.children = top.children
            if tag in RAW and not raw.endswith("/"):
                end = _raw_end(tag).search(page, at)
                if tag == "textarea":
                    node.children.append(html.unescape(page[at : end.start() if end else size]))
                at = end.end() if end else size
            elif not leaf:
                stack.push(node)
        elif m["close"]:
            _close(stack, m["close"].lower())
    return root


@functools.cache
def _raw_end(tag: str) -> re.Pattern:
    return re.compile(rf"</{re.escape(tag)}\s*>?", re.I)


def _imply(stack: Open, tag: str) -> None:
    """End the open elements that an opening tag ends."""
    if stack.nodes[-1].drawing and (tag in BLOCKS or tag in BREAKOUT):
        drawing = stack.first_after(["svg"], stack.last(["foreignobject"]))
        if drawing:
            stack.cut(drawing)
    if tag in BLOCKS:
        p = stack.last(["p"])
        if p > stack.last(SCOPES):
            stack.cut(p)
        # what a page's head cannot hold begins its body
        head = stack.last(["head"])
        if head:
            stack.cut(head)
    if tag in IMPLIED:
        ends, scope = IMPLIED[tag]
        cut = stack.first_after(ends, stack.last(scope))
        if cut:
            stack.cut(cut)


def _close(stack: Open, tag: str) -> None:
    at = stack.last([tag])
    if at and (tag in ("table", "tr", "tbody", "thead", "tfoot", "body", "html") or at >= stack.last(SCOPES)):
        stack.cut(at)


class Layout:
    """Lines of a rendered element."""

    def __init__(self) -> None:
        self.lines: list[str] = []
        self.now = ""
        self.gap = False
        self.lead = ""

    def text(self, s: str, pre: bool) -> None:
        if pre:
            first, *rest = s.replace("\r\n", "\n").split("\n")
            self.now += first
            for line in rest:
                self.lines.append(self.now)
                self.now = line
            return
        s = _SPACES.sub(" ", s)
        if s.startswith(" ") and (not self.now or self.now.endswith(" ")):
            s = s[1:]
        self.now += s

    def end(self, gap: bool = False) -> None:
        """End the line; gap: an empty line follows before more text."""
        line = self.now.rstrip(" ")
        self.now = ""
        if line:
            if self.gap and self.lines:
                self.lines.append("")
            self.gap = False
            self.lines.append(line)
        self.gap = self.gap or gap

    def add(self, lines: list[str], first: str, rest: str) -> None:
        self.end()
        if lines and self.gap and self.lines:
            self.lines.append("")
        if lines:
            self.gap = False
        self.lines += [((first if i == 0 else rest) + line).rstrip(" ") for i, line in enumerate(lines)]


def render(node: Node) -> list[str]:
    out = Layout()
    _inline(node, out, False)
    out.end()
    while out.lines and not out.lines[-1]:
        out.lines.pop()
    return out.lines


def _inline(node: Node, out: Layout, pre: bool) -> None:
    for child in node.children:
        if isinstance(child, str):
            out.text(child, pre)
        elif not child.hidden:
            _element(child, out, pre)


def _element(node: Node, out: Layout, pre: bool) -> None:
    tag = node.tag
    if tag == "br":
        if out.now.strip(" "):
            out.end()
        elif out.lines:
            out.gap = True
    elif tag == "table":
        out.end(True)
        out.add(_table(node), "", "")
        out.end(True)
    elif tag in ("ul", "ol", "menu", "dir"):
        out.end(tag != "menu")
        _list(node, out)
        out.end(True)
    elif tag == "dd":
        out.end()
        out.add(render(node), "    ", "    ")
    elif tag == "blockquote":
        out.end(True)
        out.add(render(node), "> ", "> ")
        out.end(True)
    elif tag == "pre":
        out.end(True)
        inner = Layout()
        _inline(node, inner, True)
        lines = [*inner.lines, inner.now]
        while lines and not lines[0].strip():
            lines.pop(0)
        while lines and not lines[-1].strip():
            lines.pop()
        out.add(lines, "", "")
        out.end(True)
    elif tag in BLOCKS or tag in LINES or (tag == "text" and node.drawing):
        out.end(tag in SPACED)
        _inline(node, out, pre)
        out.end(tag in SPACED)
    else:
        _inline(node, out, pre)


def _list(node: Node, out: Layout) -> None:
    start = _START.match(node.attrs.get("start", "")) if node.tag == "ol" else None
    number = int(start[1]) if start else 1
    for child in node.children:
        if isinstance(child, str):
            out.text(child, False)
        elif not child.hidden:
            if child.tag == "li":
                mark = f"{number}. " if node.tag == "ol" else "- "
                number += 1
                out.add(render(child), mark, " " * len(mark))
            else:
                _element(child, out, False)


def _rows(node: Node) -> Iterator[Node | list]:
    """Rows of a table, and what stands in it outside of cells."""
    for child in node.children:
        if isinstance(child, str):
            if child.strip():
                yield [child]
        elif child.hidden:
            continue
        elif child.tag in ("thead", "tbody", "tfoot"):
            yield from _rows(child)
        elif child.tag == "tr":
            yield child
        else:
            yield [child]


def _table(node: Node) -> list[str]:
    """Cells padded to the width of their column; a cell of several lines
    makes a row of several lines."""
    grid: list[list[list[str]]] = []
    lines: list[str] = []

    def flush() -> None:
        if grid:
            widths = [0] * max(len(r) for r in grid)
            for row in grid:
                for i, cell in enumerate(row):
                    widths[i] = max([widths[i], *(len(x) for x in cell)])
            for row in grid:
                for k in range(max([1, *(len(c) for c in row)])):
                    cells = [c[k] if k < len(c) else "" for c in row]
                    lines.append("  ".join(c.ljust(w) for c, w in zip(cells, widths, strict=False)).rstrip())
            grid.clear()

    for row in _rows(node):
        if isinstance(row, list):
            flush()
            loose = Node("div")
            loose.children = row
            lines.extend(render(loose))
            continue
        cells: list[list[str]] = []
        for child in row.children:
            if isinstance(child, str):
                if child.strip():
                    cells.append([_SPACES.sub(" ", child).strip()])
            elif not child.hidden:
                cells.append(render(child))
        if cells:
            grid.append(cells)
    flush()
    return lines


def page_text(page: str | None) -> str:
    return "\n".join(render(parse(page))) if page else ""


def extract_text(pages: DataFrame) -> DataFrame:
    """page_id, text and n_lines of every page; no shuffle."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [page_text(p.as_py()) for p in batch.column("html")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), pa.array(texts, pa.string()), pa.array([t.count("\n") + 1 if t else 0 for t in texts], pa.int64())],
                ["page_id", "text", "n_lines"],
            )

    return pages.select(F.col("page_id").cast("long").alias("page_id"), "html").mapInArrow(rows, "page_id long, text string, n_lines long")
