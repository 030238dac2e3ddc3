"""HTML extraction by layout-aware rendering.

A small tree builder (implied end tags, void and raw-text elements, stray end tags)
feeds a renderer that knows which elements are blocks, lists, tables or hidden and
emits all visible text: blocks on lines of their own with their spacing, list items
with markers and depth, table cells in aligned columns, preformatted text unchanged.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed values of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes".split())
HIDDEN = frozenset("head script style noscript template iframe noembed noframes object audio video canvas svg math datalist title meta link base param source track".split())
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody td tfoot th thead tr ul".split()
)
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl blockquote pre table figure menu dir".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: opening one of these closes an open paragraph
CLOSES_P = BLOCKS - frozenset("body html dd dt li td th tr tbody thead tfoot option optgroup legend".split())
#: opening the key closes the nearest of these, up to the boundary
IMPLIED = {
    "li": (("li",), ("ul", "ol", "menu", "dir")),
    "dt": (("dt", "dd"), ("dl",)),
    "dd": (("dt", "dd"), ("dl",)),
    "option": (("option",), ("select", "datalist", "optgroup")),
    "optgroup": (("option", "optgroup"), ("select",)),
    "td": (("td", "th"), ("tr", "table")),
    "th": (("td", "th"), ("tr", "table")),
    "tr": (("tr",), ("table", "tbody", "thead", "tfoot")),
    "tbody": (("tbody", "thead", "tfoot"), ("table",)),
    "thead": (("tbody", "thead", "tfoot"), ("table",)),
    "tfoot": (("tbody", "thead", "tfoot"), ("table",)),
}
SCOPE = frozenset("table td th caption button object template html".split())

_TOKEN = re.compile(r"<!--.*?(?:--!?>|$)|<[!?][^>]*(?:>|$)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*(?:\"|$)|'[^']*(?:'|$))*)(?:>|$)", re.S)
_ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(\"[^\"]*\"?|'[^']*'?|[^\s>]+))?")
_SPACE = re.compile(r"[ \t\n\r\f]+")
_UNSEEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*(?:hidden|collapse)", re.I)


class Node:
    __slots__ = ("tag", "attributes", "children")

    def __init__(self, tag: str, attributes: dict[str, str]):
        self.tag, self.attributes, self.children = tag, attributes, []


def _attributes(source: str) -> dict[str, str]:
    found: dict[str, str] = {}
    for name, value in _ATTRIBUTE.findall(source):
        if value[:1] in ("'", '"'):
            value = value[1:-1] if len(value) > 1 and value[-1] == value[0] else value[1:]
        found.setdefault(name.lower(), unescape(value) if "&" in value else value)
    return found


def parse(html: str) -> Node:
    """The document's tree; text nodes are strings. Never fails."""
    root = Node("#root", {})
    stack = [root]
    at, end = 0, len(html)
    while at < end:
        m = _TOKEN.search(html, at)
        if m is None:
            stack[-1].children.append(unescape(html[at:]))
            break
        if m.start() > at:
            text = html[at : m.start()]
            stack[-1].children.append(unescape(text) if "&" in text else text)
        at = m.end()
        tag = m[2]
        if tag is None:
            continue
        tag = tag.lower()
        if m[1]:
            if tag == "br":
                stack[-1].children.append(Node("br", {}))
            elif tag == "p" and not _open(stack, ("p",), SCOPE):
                stack[-1].children.append(Node("p", {}))
            else:
                _close(stack, tag)
            continue
        if tag in CLOSES_P:
            _pop(stack, ("p",), SCOPE)
        if tag in IMPLIED:
            _pop(stack, *IMPLIED[tag])
            if tag in ("td", "th", "tr"):
                _pop(stack, ("caption",), ("table",))
        if tag in HEADINGS and stack[-1].tag in HEADINGS:
            stack.pop()
        node = Node(tag, _attributes(m[3]) if m[3] and not m[3].isspace() else {})
        stack[-1].children.append(node)
        if tag in VOID:
            continue
        if tag == "plaintext":
            node.children.append(html[at:])
            break
        if tag in RAW:
            close = re.compile(rf"</{tag}(?=[\s/>])[^>]*(?:>|$)", re.I).search(html, at)
            text = html[at : close.start() if close else end]
            node.children.append(unescape(text) if tag in ("title", "textarea") else text)
            at = close.end() if close else end
            continue
        stack.append(node)
    return root


def _open(stack: list[Node], tags: tuple[str, ...], boundary) -> int:
    for i in range(len(stack) - 1, 0, -1):
        if stack[i].tag in tags:
            return i
        if stack[i].tag in boundary:
            return 0
    return 0


def _pop(stack: list[Node], tags: tuple[str, ...], boundary) -> None:
    if i := _open(stack, tags, boundary):
        del stack[i:]


def _close(stack: list[Node], tag: str) -> None:
    boundary = ("table", "template") if tag not in ("table", "template", "html", "body") else ("template",)
    if tag not in ("td", "th", "tr", "tbody", "thead", "tfoot", "caption", "table", "template", "html", "body", "div", "section", "article"):
        boundary = ("td", "th", "table", "template")
    if i := _open(stack, (tag,), [b for b in boundary if b != tag]):
        del stack[i:]


def hidden(node: Node) -> bool:
    if node.tag in HIDDEN:
        return True
    a = node.attributes
    if not a:
        return False
    return "hidden" in a or (node.tag == "input") or (node.tag == "dialog" and "open" not in a) or bool("style" in a and _UNSEEN.search(a["style"]))


class _Flow:
    """Lines of one column of text."""

    def __init__(self):
        self.lines: list[str] = []
        self.current: list[str] = []
        self.space = False
        self.gap = 0

    def text(self, value: str) -> None:
        value = _SPACE.sub(" ", value)
        if value[:1] == " ":
            self.space = True
        core = value.strip(" ")
        if core:
            if self.space and self.current and not self.current[-1].endswith("\n"):
                self.current.append(" ")
            self.current.append(core)
            self.space = value[-1:] == " "

    def end(self) -> None:
        if self.current:
            if self.gap and self.lines:
                self.lines.extend([""] * self.gap)
            self.gap = 0
            self.lines.append("".join(self.current))
            self.current = []
        self.space = False

    def block(self, spaced: bool) -> None:
        self.end()
        if spaced and self.lines:
            self.gap = 1

    def put(self, lines: list[str]) -> None:
        self.end()
        if lines:
            if self.gap and self.lines:
                self.lines.extend([""] * self.gap)
            self.gap = 0
            self.lines.extend(lines)


def render(html: str) -> str:
    """All visible text of ``html``, laid out; no trailing white space."""
    flow = _Flow()
    _walk(parse(html), flow)
    flow.end()
    return "\n".join(line.rstrip() for line in flow.lines).strip("\n")


def _walk(node: Node, flow: _Flow) -> None:
    """Depth first, by an own stack: pages may nest deeper than calls may."""
    todo: list = [(node, False)]
    while todo:
        item, done = todo.pop()
        if isinstance(item, str):
            flow.text(item)
            continue
        tag = item.tag
        if done:
            flow.block(tag in SPACED)
            continue
        if hidden(item):
            continue
        if tag == "br":
            if flow.current:
                flow.end()
            else:
                flow.put([""])
        elif tag == "hr":
            flow.block(False)
            flow.put(["---"])
        elif tag == "img":
            if item.attributes.get("alt"):
                flow.text(" " + item.attributes["alt"] + " ")
        elif tag in ("ul", "ol", "menu", "dir"):
            flow.block(_DEPTH == 0)  # a list inside another has no space around it
            flow.put(_list(item))
            flow.block(_DEPTH == 0)
        elif tag == "table":
            flow.block(True)
            flow.put(_table(item))
            flow.block(True)
        elif tag in ("pre", "textarea"):
            flow.block(True)
            flow.put(_plain(item).strip("\n").expandtabs(8).split("\n"))
            flow.block(True)
        else:
            if tag in BLOCKS:
                flow.block(tag in SPACED)
                todo.append((item, True))
            if tag == "q":
                todo.append(("”", False))
            todo.extend((c, False) for c in reversed(item.children))
            if tag == "q":
                todo.append(("“", False))


def _plain(node: Node) -> str:
    out, todo = [], [node]
    while todo:
        item = todo.pop()
        if isinstance(item, str):
            out.append(item)
        elif item.tag == "br":
            out.append("\n")
        elif not hidden(item):
            todo.extend(reversed(item.children))
    return "".join(out)


#: nested lists and tables beyond this depth are set without further layout
DEPTH = 40


def _inner(children: list, depth: int) -> list[str]:
    flow = _Flow()
    holder = Node("#part", {})
    holder.children = children
    if depth >= DEPTH:
        flow.text(_plain(holder))
    else:
        _walk_at(holder, flow, depth)
    flow.end()
    return flow.lines


def _walk_at(node: Node, flow: _Flow, depth: int) -> None:
    global _DEPTH
    before, _DEPTH = _DEPTH, depth
    try:
        _walk(node, flow)
    finally:
        _DEPTH = before


_DEPTH = 0


def _list(node: Node) -> list[str]:
    out: list[str] = []
    number = 1
    if node.tag == "ol" and re.fullmatch(r"\s*-?\d+\s*", node.attributes.get("start", "")):
        number = int(node.attributes["start"])
    loose: list = []

    def flush() -> None:
        if any(not isinstance(c, str) or c.strip() for c in loose):
            out.extend("  " + line for line in _inner(list(loose), _DEPTH + 1))
        loose.clear()

    for child in node.children:
        if isinstance(child, str) or child.tag != "li":
            loose.append(child)
            continue
        flush()
        if hidden(child):
            continue
        mark = f"{number}. " if node.tag == "ol" else "- "
        number += 1
        lines = [x for x in _inner(child.children, _DEPTH + 1)] or [""]
        out.append(mark + lines[0])
        out.extend((" " * len(mark) + line) if line else "" for line in lines[1:])
    flush()
    return out


def _span(node: Node, name: str) -> int:
    value = node.attributes.get(name, "1").strip()
    return min(max(int(value), 1), 1000) if value.isdecimal() and value.isascii() else 1


def _table(node: Node) -> list[str]:
    """Caption, then rows with the cells of a column under each other."""
    captions: list[str] = []
    rows: dict[str, list[list[Node]]] = {"thead": [], "tbody": [], "tfoot": []}
    stray: list = []
    todo = [(c, "tbody") for c in reversed(node.children)]
    loose_row: list[Node] | None = None
    while todo:
        child, part = todo.pop()
        if isinstance(child, str):
            if child.strip():
                stray.append(child)
            continue
        if hidden(child):
            continue
        if child.tag == "caption":
            captions.extend(_inner(child.children, _DEPTH + 1))
        elif child.tag in rows:
            loose_row = None
            todo.extend((c, child.tag) for c in reversed(child.children))
        elif child.tag == "tr":
            loose_row = None
            cells = [c for c in child.children if not isinstance(c, str) and c.tag in ("td", "th") and not hidden(c)]
            stray.extend(c for c in child.children if (c.strip() if isinstance(c, str) else c.tag not in ("td", "th")))
            rows[part].append(cells)
        elif child.tag in ("td", "th"):
            if loose_row is None:
                loose_row = []
                rows[part].append(loose_row)
            loose_row.append(child)
        elif child.tag not in ("col", "colgroup"):
            stray.append(child)
    grid: list[dict[int, list[str]]] = []
    held: dict[int, int] = {}
    wide: list[tuple[int, int, int]] = []
    for cells in [*rows["thead"], *rows["tbody"], *rows["tfoot"]]:
        line: dict[int, list[str]] = {}
        column, after = 0, {k: v - 1 for k, v in held.items() if v > 1}
        for cell in cells:
            while held.get(column, 0) > 0:
                column += 1
            across, down = _span(cell, "colspan"), _span(cell, "rowspan")
            line[column] = _inner(cell.children, _DEPTH + 1)
            if across > 1:
                wide.append((len(grid), column, across))
            if down > 1:
                after |= {column + i: down - 1 for i in range(across)}
            column += across
        held = after
        grid.append(line)
    spanning = {(r, c) for r, c, _ in wide}
    widths: dict[int, int] = {}
    for r, line in enumerate(grid):
        for c, text in line.items():
            if (r, c) not in spanning:
                widths[c] = max(widths.get(c, 0), *(len(x) for x in text), 0) if text else widths.get(c, 0)
    out = captions
    for line in grid:
        if not any(line.values()):
            continue
        for k in range(max(len(t) for t in line.values())):
            row = ""
            for c in sorted(line):
                start = sum(widths.get(i, 0) + 2 for i in range(c))
                row = row.ljust(start) if len(row) <= start else row + "  "
                row += line[c][k] if k < len(line[c]) else ""
            out.append(row.rstrip())
    if stray:  # set before the table, as browsers do
        out = [*_inner(stray, _DEPTH + 1), *out]
    return out


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for low in range(0, len(batch), 64):
            part = batch.slice(low, 64)
            texts = [None if h is None else render(h) for h in part.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(texts, pa.string())], names=["row", "visible_text"])


def extract_text(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """``pages`` with visible_text added (a column of that name is replaced).

    A null html gives null, an empty one an empty text; rows that repeat are rendered
    each; all other columns pass unchanged; no rows give no rows.
    """
    pages = pages.drop("visible_text")
    keyed = pages.select(F.struct(*(F.col(f"`{c}`") for c in pages.columns)).alias("row"), F.col(f"`{html_col}`").alias("html"))
    return keyed.mapInArrow(_extract, f"row {keyed.schema['row'].dataType.simpleString()}, visible_text string").select("row.*", "visible_text")
