"""HTML to text by layout: a tree with implied tags, visibility rules, and a renderer for blocks, lists and tables.

A page becomes a tree: void elements have no content, raw text elements keep theirs, and an opening tag closes what it
ends by HTML's rules (a paragraph by the next block, a list item by the next item, cells and rows by the next ones, and
so on); a closing tag without its opening one is dropped, open elements are closed by what closes their parents. The
renderer leaves out what a browser would not show (scripts, styles, the head, comments, ``hidden``, ``display:none``,
closed dialogs, ``visibility:hidden`` but for parts that are ``visible`` again) and gives all other text. Blocks stand on lines of their own; paragraphs, headings,
lists and tables have an empty line around them; list items carry a bullet or their number, indented by depth; table
cells are padded to columns, and a cell that spans rows keeps its columns free below it; ``br`` breaks a line; ``pre`` keeps its white space.

One page is one row's work: pages are rendered one by one inside tasks, and nothing is shuffled.

Defined results: null HTML gives a null text; an empty page gives an empty text; broken markup gives the text that is
there; equal rows give equal results; an empty table gives an empty result. Input columns called like an output column
are replaced.
"""

from __future__ import annotations

import html
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tallywind.llm import text as X

# HTML's element kinds.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title xmp noembed noframes iframe".split())
NOT_SHOWN = set("head script style title template noscript iframe object audio video canvas datalist noembed noframes area base link meta param source track desc defs metadata annotation annotation-xml".split())
BLOCKS = set(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 header hgroup hr html legend "
    "li main menu nav ol optgroup option p pre section summary table tbody td tfoot th thead tr ul caption".split()
)
SPACED = set("p h1 h2 h3 h4 h5 h6 ul ol dl menu table blockquote pre figure fieldset article section".split())
CLOSES_P = set(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section summary table ul".split()
)
#: Opening tags, what they close, and the elements that shield what is outside of them.
CLOSING = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select", "datalist"}),
    "optgroup": ({"option", "optgroup"}, {"select", "datalist"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tr": ({"tr", "td", "th", "caption", "colgroup"}, {"table"}),
    "tbody": ({"tbody", "thead", "tfoot", "tr", "td", "th", "caption", "colgroup"}, {"table"}),
    "thead": ({"tbody", "thead", "tfoot", "tr", "td", "th", "caption", "colgroup"}, {"table"}),
    "tfoot": ({"tbody", "thead", "tfoot", "tr", "td", "th", "caption", "colgroup"}, {"table"}),
    "body": ({"head"}, set()),
}
HEAD_ONLY = set("base link meta title style script noscript template".split())
# A closing tag does not reach over these.
SCOPES = set("table td th caption html".split())

_TOKEN = re.compile(r"<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?][^>]*(?:>|$)|</([a-zA-Z][^\s/>]*)[^>]*(?:>|$)|<([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^'\">])*)(?:>|$)", re.S)
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
_NO_BOX = re.compile(r"display\s*:\s*none", re.I)
_VISIBILITY = re.compile(r"visibility\s*:\s*(hidden|collapse|visible)", re.I)
_INTEGER = re.compile(r"[ \t\n\f\r]*([+-]?[0-9]{1,9})(?![0-9])")
# The end of a raw element is sought in the page itself: other cases of a letter may be longer or shorter than it.
_RAW_END = {tag: re.compile(rf"</{tag}(?=[\s/>]|\Z)", re.I | re.A) for tag in RAW}
_SPACES = re.compile(r"[ \t\n\r\f]+")


@dataclass
class Node:
    tag: str
    attributes: dict[str, str] = field(default_factory=dict)
    children: list[Node | str] = field(default_factory=list)


def _attributes(raw: str) -> dict[str, str]:
    out: dict[str, str] = {}
    for name, value in _ATTRIBUTE.findall(raw):
        out.setdefault(name.lower(), html.unescape(value.strip("\"'")))
    return out


def parse(page: str) -> Node:
    """The tree of a page."""
    root = Node("html")
    stack = [root]
    open_tags: Counter[str] = Counter()

    def cut(at: int) -> None:
        for node in stack[at:]:
            open_tags[node.tag] -= 1
        del stack[at:]

    def close_any(tags: set[str], shield: set[str]) -> None:
        """Close the outermost open element of ``tags`` this side of the innermost shield."""
        if not any(open_tags[tag] for tag in tags):
            return
        at = None
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag in shield:
                break
            if stack[i].tag in tags:
                at = i
        if at is not None:
            cut(at)

    at = 0
    for token in iter(lambda: _TOKEN.search(page, at), None):
        if token.start() > at:
            stack[-1].children.append(html.unescape(page[at : token.start()]))
        at = max(token.end(), at + 1)
        ending, opening, raw = token.group(1), token.group(2), token.group(3)
        if ending:
            tag = ending.lower()
            if tag == "br" or tag == "p" and not open_tags["p"]:
                stack[-1].children.append(Node(tag))
                continue
            if not open_tags[tag]:
                continue
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == tag:
                    cut(i)
                    break
                if stack[i].tag in SCOPES and tag not in ("table", "tr", "tbody", "thead", "tfoot", "td", "th", "body", "html"):
                    break
        elif opening:
            tag = opening.lower()
            if tag == "html" or tag == "body" and open_tags["body"]:
                continue
            if stack[-1].tag == "head" and tag not in HEAD_ONLY:
                cut(len(stack) - 1)
            if tag in CLOSES_P:
                close_any({"p"}, {"table", "td", "th", "button", "caption"})
            if tag in CLOSING:
                close_any(*CLOSING[tag])
            if tag[0] == "h" and tag[1:] in "123456" and stack[-1].tag in ("h1", "h2", "h3", "h4", "h5", "h6"):
                cut(len(stack) - 1)
            node = Node(tag, _attributes(raw) if raw else {})
            stack[-1].children.append(node)
            if tag in RAW:
                found = _RAW_END[tag].search(page, at)
                end = found.start() if found else len(page)
                inner = page[at:end]
                node.children.append(html.unescape(inner) if tag in ("title", "textarea") else inner)
                close = page.find(">", end)
                at = len(page) if close < 0 else close + 1
            elif tag not in VOID:
                stack.append(node)
                open_tags[tag] += 1
    if at < len(page):
        stack[-1].children.append(html.unescape(page[at:]))
    return root


def hidden(node: Node) -> bool:
    """Whether neither the node nor anything in it is shown."""
    a = node.attributes
    if node.tag in NOT_SHOWN or "hidden" in a or node.tag == "dialog" and "open" not in a:
        return True
    return (node.tag == "input" and a.get("type", "").lower() == "hidden") or bool(_NO_BOX.search(a.get("style", "")))


def _visibility(node: Node) -> str:
    found = _VISIBILITY.findall(node.attributes.get("style", ""))
    return found[-1].lower() if found else ""


def seen(node: Node) -> Node:
    """The node, or where its visibility is off an empty one with the parts that turn it on again; its place remains."""
    if _visibility(node) not in ("hidden", "collapse"):
        return node
    parts: list[Node | str] = []
    open_ = list(reversed(node.children))
    while open_:
        top = open_.pop()
        if isinstance(top, str) or hidden(top):
            continue
        if _visibility(top) == "visible":
            parts.append(top)
        else:
            open_ += reversed(top.children)
    return Node(node.tag if node.tag in ("td", "th", "tr") else "span", {k: v for k, v in node.attributes.items() if k != "style"}, parts)


class Page:
    """Lines under construction: white space collapses, blocks break lines, spaced blocks leave one empty line."""

    def __init__(self):
        self.lines: list[str] = []
        self.line = ""
        self.prefix = ""
        self.gap = False
        self.marker = ""

    def add(self, text: str) -> None:
        text = _SPACES.sub(" ", text)
        if not self.line or self.line.endswith(" "):
            text = text.lstrip(" ")
        self.line += text

    def end_line(self, force: bool = False) -> None:
        line = self.line.rstrip(" ")
        self.line = ""
        if line or (force and not self.gap):
            self.put(line)

    def put(self, line: str) -> None:
        if self.gap and self.lines:
            self.lines.append("")
        self.gap = False
        prefix = self.prefix
        if self.marker:
            prefix, self.marker = prefix[: len(prefix) - len(self.marker)] + self.marker, ""
        self.lines.append((prefix + line).rstrip(" "))

    def space(self) -> None:
        self.end_line()
        self.gap = bool(self.lines)


def width(text: str) -> int:
    """Columns that a text takes: wide characters two, combining ones none."""
    if text.isascii():
        return len(text)
    return sum(0 if unicodedata.combining(c) else 2 if unicodedata.east_asian_width(c) in "WF" else 1 for c in text)


def _rows(node: Node) -> Iterator[tuple[Node, Node]]:
    """(section, row) of a table."""
    for child in node.children:
        if isinstance(child, Node) and not hidden(child):
            if child.tag == "tr":
                yield node, seen(child)
            elif child.tag in ("thead", "tbody", "tfoot"):
                yield from _rows(child)


def _integer(value: str) -> int | None:
    """A whole number as an attribute gives it; what browsers have no room for is none."""
    found = _INTEGER.match(value)
    return int(found.group(1)) if found else None


def _span(cell: Node, name: str, most: int) -> int:
    """Columns or rows of a cell, within the bounds that HTML sets."""
    n = _integer(cell.attributes.get(name, "1"))
    return min(n, most) if n is not None and n > 0 else 1


def table_lines(table: Node, depth: int) -> list[str]:
    """The rows of a table with cells padded to columns; a cell may span columns and rows and have several lines."""
    grid: list[list[tuple[int, list[str], int]]] = []
    section, taken = None, {}  # columns that cells of earlier rows hold, and for how many rows more
    for part, row in _rows(table):
        if part is not section:
            section, taken = part, {}
        cells = [c for c in row.children if isinstance(c, Node) and c.tag in ("td", "th") and not hidden(c)]
        loose = [c for c in row.children if not (isinstance(c, Node) and c.tag in ("td", "th"))]
        made = [(render(seen(c), depth + 1).split("\n"), _span(c, "colspan", 1000), _span(c, "rowspan", 65534)) for c in cells]
        outside = render(Node("div", {}, loose), depth + 1)
        if outside:
            made.append((outside.split("\n"), 1, 1))
        placed, at, held = [], 0, {}
        for cell, span, rows in made:
            while at in taken:
                at += 1
            placed.append((at, cell, span))
            if rows > 1:
                held |= dict.fromkeys(range(at, at + span), rows - 1)
            at += span
        taken = {c: n - 1 for c, n in taken.items() if n > 1} | held
        if placed:
            grid.append(placed)
    widths = [0] * max((at + span for row in grid for at, _, span in row), default=0)
    for row in grid:
        for at, cell, span in row:
            if span == 1:
                widths[at] = max([widths[at], *map(width, cell)])
    out = []
    for row in grid:
        for k in range(max(len(cell) for _, cell, _ in row)):
            line, reached = "", 0
            for at, cell, span in row:
                for column in range(reached, at):
                    line += " " * widths[column] + " | "
                text = cell[k] if k < len(cell) else ""
                room = sum(widths[at : at + span]) + 3 * (span - 1)
                line += text + " " * (room - width(text)) + " | "
                reached = at + span
            out.append(line.rstrip(" |") if not line.strip(" |") else line[:-3].rstrip(" "))
    return out


MAX_DEPTH = 200


def _walk(node: Node, page: Page, pre: bool, depth: int) -> None:
    number = _integer(node.attributes.get("start", "1")) if node.tag == "ol" else 0
    number = 1 if number is None else number
    for child in node.children:
        if isinstance(child, str):
            if pre:
                first, *more = child.split("\n")
                page.line += first
                for line in more:
                    page.put(page.line) if page.line or not page.gap else None
                    page.line = line
            elif node.tag not in ("table", "tr", "tbody", "thead", "tfoot") or child.strip():
                page.add(child)
            continue
        if hidden(child):
            continue
        child = seen(child)
        tag = child.tag
        if depth > MAX_DEPTH:
            # Deeper than a reader could follow: the text stays, its layout goes.
            page.add(" " + _SPACES.sub(" ", _all_text(child)) + " ")
            continue
        if tag == "br":
            page.end_line(force=True)
        elif tag == "hr":
            page.space()
        elif tag == "img":
            if child.attributes.get("alt"):
                page.add(child.attributes["alt"])
        elif tag == "input":
            page.add(child.attributes.get("value", "") if child.attributes.get("type", "text").lower() in ("text", "submit", "button", "reset") else "")
        elif tag == "table":
            page.space()
            for part in child.children:
                if isinstance(part, Node) and part.tag == "caption" and not hidden(part):
                    _walk(part, page, pre, depth + 1)
                    page.end_line()
            loose = [p for p in child.children if isinstance(p, str) or p.tag not in ("tr", "thead", "tbody", "tfoot", "caption", "colgroup", "col")]
            _walk(Node("div", {}, loose), page, pre, depth + 1)
            page.end_line()
            for line in table_lines(child, depth + 1):
                page.put(line)
            page.space()
        elif tag == "li":
            page.end_line()
            own = _integer(child.attributes.get("value", ""))
            number = number if own is None else own
            marker = f"{number}. " if node.tag == "ol" else "- "
            number += 1
            before = page.prefix
            page.prefix += " " * len(marker)
            page.marker = marker
            _walk(child, page, pre, depth + 1)
            page.end_line()
            page.prefix, page.marker = before, ""
        elif tag in BLOCKS or tag == "pre":
            nested = tag in ("ul", "ol", "menu") and page.prefix
            spaced = tag in SPACED and not nested and node.tag != "li"
            page.space() if spaced else page.end_line()
            before = page.prefix
            if tag in ("blockquote", "dd"):
                page.prefix += "  "
            _walk(child, page, pre or tag == "pre", depth + 1)
            if pre or tag == "pre":
                if page.line:
                    page.put(page.line)
                page.line = ""
            page.space() if spaced else page.end_line()
            page.prefix = before
        else:
            _walk(child, page, pre, depth + 1)


def _all_text(node: Node) -> str:
    out, open_ = [], [node]
    while open_:
        top = open_.pop()
        if isinstance(top, str):
            out.append(top)
        elif not hidden(top):
            open_ += reversed(seen(top).children)
    return " ".join(out)


def render(node: Node, depth: int = 0) -> str:
    """The visible text of a tree."""
    page = Page()
    _walk(node, page, node.tag == "pre", depth)
    page.end_line()
    return "\n".join(page.lines).strip("\n")


def page_text(page: str) -> str:
    return render(parse(page))


def extract(df: DataFrame, source: str = "html", target: str = "text") -> DataFrame:
    """``df`` with ``target``: the visible text of the HTML in ``source``."""
    kept, schema = X.added(df.schema, [T.StructField(target, T.StringType())])

    def run(batch: pa.RecordBatch) -> Iterator[dict]:
        # Pages are taken a few megabytes at a time, so that memory follows the longest page.
        at, size = 0, 0
        pages = batch.column(source)
        lengths = [len(p) if p is not None else 0 for p in pages.to_pylist()]
        for i, n in enumerate(lengths + [0]):
            if i == len(lengths) or (size and size + n > 1 << 22):
                part = batch.slice(at, i - at)
                made = [None if p is None else page_text(p) for p in part.column(source).to_pylist()]
                yield {c: part.column(c) for c in kept if c != target} | {target: made}
                at, size = i, 0
            size += n

    return X.map_batches(df, run, schema)
