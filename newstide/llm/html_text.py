"""Visible text of HTML pages, laid out as a reader sees it.

A tolerant tokenizer feeds a tree builder that closes elements the author left open
(paragraphs, list items, cells, rows). The renderer walks the tree, leaves out what is not
shown, and keeps block spacing, list markers, preformatted text and aligned table cells. Both
keep their own stack, so elements may be nested to any depth.
"""

from __future__ import annotations

import re
from collections.abc import Generator, Iterator
from html import unescape
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame

from newstide.llm.common import bounded_batches, row_batches

# A tag, whose quoted attribute values may hold ">"; where quotes do not pair up, the first
# ">" ends it. Comments and declarations are skipped. A "<" that opens nothing is text.
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"<]*+\"|'[^'<]*+')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>",
    re.S,
)
_STYLE_HIDES = re.compile(r"display\s*:\s*none|visibility\s*:\s*(?:hidden|collapse)", re.I)
_HIDDEN_ATTR = re.compile(r"(?:^|\s)hidden(?=[\s=/]|$)|(?:^|\s)type\s*=\s*[\"']?hidden\b", re.I)
_STYLE_ATTR = re.compile(r"(?:^|\s)style\s*=\s*(\"[^\"]*\"|'[^']*'|\S+)", re.I)
_SPAN = re.compile(r"colspan\s*=\s*[\"']?(\d{1,3})", re.I)
_ROWS = re.compile(r"(?:^|\s)rowspan\s*=\s*[\"']?(\d{1,5})", re.I)
_SPACES = re.compile(r"[ \t\n\r\f]+")

# Fixed values of the HTML standard: elements without content, elements whose content is raw,
# elements that are never shown, blocks, and blocks with a blank line around them.
_VOID = set("area base br col embed hr img input link meta param source track wbr".split())
_RAW = set("script style textarea title noscript iframe noembed noframes xmp".split())
_UNSEEN = set("head script style title noscript iframe noembed noframes template object".split())
_UNSEEN |= set("audio video canvas datalist".split())
_BLOCK = set(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset"
    " figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu"
    " nav ol optgroup option p pre search section summary table tbody td tfoot th thead tr ul".split()
)
_SPACED = set("p blockquote dl figure h1 h2 h3 h4 h5 h6 hr ol pre table ul".split())
# A start tag closes the nearest open element of the first set, unless one of the second
# set lies in between.
_LISTS, _TABLE = {"ul", "ol", "menu", "dir"}, {"table"}
_IMPLIED = {
    "li": ({"li"}, _LISTS),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select"}),
    "td": ({"td", "th"}, _TABLE | {"tr"}),
    "th": ({"td", "th"}, _TABLE | {"tr"}),
    "tr": ({"tr"}, _TABLE),
    "tbody": ({"tbody", "thead", "tfoot", "caption", "colgroup"}, _TABLE),
    "thead": ({"tbody", "thead", "tfoot", "caption", "colgroup"}, _TABLE),
    "tfoot": ({"tbody", "thead", "tfoot", "caption", "colgroup"}, _TABLE),
    "body": ({"head"}, set()),
}
_CLOSES_P = (_BLOCK - {"tbody", "td", "tfoot", "th", "thead", "tr", "option", "optgroup", "body", "html"})
_P_SCOPE = {"td", "th", "table", "button", "caption"}


class Node:
    __slots__ = ("tag", "attrs", "children")

    def __init__(self, tag: str, attrs: str = ""):
        self.tag, self.attrs, self.children = tag, attrs, []


class _Open:
    """The open elements, and the places of each tag among them."""

    def __init__(self, root: Node):
        self.nodes, self.places = [root], {}

    def push(self, node: Node) -> None:
        self.places.setdefault(node.tag, []).append(len(self.nodes))
        self.nodes.append(node)

    def last(self, tags: set[str]) -> int:
        return max([places[-1] for t in tags if (places := self.places.get(t))], default=0)

    def close(self, tags: set[str], scope: set[str]) -> None:
        at = self.last(tags)
        if at and self.last(scope) <= at:
            for node in self.nodes[at:]:
                self.places[node.tag].pop()
            del self.nodes[at:]


def build_tree(html: str) -> Node:
    root = Node("#root")
    stack, at, end = _Open(root), 0, html.rfind(">") + 1
    while match := _TOKEN.search(html, at, end):
        if match.start() > at:
            stack.nodes[-1].children.append(unescape(html[at : match.start()]))
        at = match.end()
        name = match[2] or match[5]
        if name is None:
            continue
        tag, attrs = name.lower(), match[3] or match[6] or ""
        if match[1] or match[4]:
            if tag == "br":
                stack.nodes[-1].children.append(Node("br"))
            elif tag != "body" and tag != "html":
                stack.close({tag}, _TABLE if tag not in _TABLE and tag in _IMPLIED else set())
            continue
        if tag in _CLOSES_P:
            stack.close({"p"}, _P_SCOPE)
        if tag in _IMPLIED:
            stack.close(*_IMPLIED[tag])
        node = Node(tag, attrs)
        stack.nodes[-1].children.append(node)
        if tag in _RAW:
            close = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>", re.I).search(html, at)
            inner = html[at : close.start()] if close else html[at:]
            if tag not in _UNSEEN:
                node.children.append(unescape(inner))
            at = close.end() if close else len(html)
        elif tag not in _VOID and not attrs.endswith("/"):
            stack.push(node)
    if at < len(html):
        stack.nodes[-1].children.append(unescape(html[at:]))
    return root


def _hidden(node: Node) -> bool:
    if node.tag in _UNSEEN:
        return True
    if not node.attrs:
        return False
    style = _STYLE_ATTR.search(node.attrs)
    if style and _STYLE_HIDES.search(style[1]):
        return True
    return "hidden" in node.attrs.lower() and bool(_HIDDEN_ATTR.search(node.attrs))


class _Page:
    """Lines so far, the line being filled, and the blank lines due before the next."""

    def __init__(self):
        self.lines: list[str] = []
        self.parts: list[str] = []
        self.gap, self.indent, self.marker = 0, "", ""

    def flush(self, gap: int = 0) -> None:
        if self.parts:
            text = "".join(self.parts)
            self.parts = []
            for line in text.split("\n"):
                if line := _SPACES.sub(" ", line).strip(" "):
                    self.put(line)
        self.gap = max(self.gap, gap)

    def put(self, line: str) -> None:
        if self.lines:
            self.lines += [""] * self.gap
        self.gap = 0
        self.lines.append((self.indent[: len(self.indent) - len(self.marker)] + self.marker + line).rstrip())
        self.marker = ""


def _run(task: Generator):
    """What a generator returns that yields the generators it needs the results of."""
    stack, value = [task], None
    while stack:
        try:
            step, value = stack[-1].send(value), None
        except StopIteration as end:
            stack.pop()
            value = end.value
        else:
            stack.append(step)
    return value


def _render(node: Node, page: _Page, pre: bool = False) -> Generator:
    number = 0
    for child in node.children:
        if isinstance(child, str):
            if pre:
                page.flush()
                for line in child.strip("\n").split("\n"):
                    page.put(line)
            else:
                # Line ends of the source are spaces; a line end in ``parts`` is a break.
                page.parts.append(_SPACES.sub(" ", child))
            continue
        tag = child.tag
        if _hidden(child):
            continue
        if tag == "br":
            page.parts.append("\n")
        elif tag == "table":
            page.flush(1)
            for line in (yield _table(child)):
                page.put(line)
            page.flush(1)
        elif tag == "li" and node.tag in ("ul", "ol", "menu", "dir"):
            number += 1
            page.flush()
            mark = f"{number}. " if node.tag == "ol" else "- "
            outer, page.indent, page.marker = page.indent, page.indent + " " * len(mark), mark
            yield _render(child, page, pre)
            page.flush()
            page.indent, page.marker = outer, ""
        elif tag in _BLOCK:
            nested = tag in ("ul", "ol", "menu") and page.indent
            gap = 1 if tag in _SPACED and not nested and not page.marker else 0
            page.flush(gap)
            outer = page.indent
            if tag in ("blockquote", "dd"):
                page.indent += "  "
            yield _render(child, page, pre or tag == "pre")
            page.flush(0 if nested else gap)
            page.indent = outer
        else:
            if tag in ("img", "input"):
                continue
            yield _render(child, page, pre)


def _number(pattern: re.Pattern, attrs: str, missing: int = 1) -> int:
    found = pattern.search(attrs)
    return int(found[1]) if found else missing


def _cells(table: Node, rows: list) -> Generator:
    """Rows of cells, each as its lines and the columns and rows it spans; captions as plain
    lines; None where a group of rows ends, beyond which no cell spans."""
    for part in table.children:
        if isinstance(part, str):
            if part.strip():
                rows.append([(part.split("\n"), 1, 1)])
        elif not _hidden(part):
            if part.tag == "tr":
                row = []
                for cell in part.children:
                    if isinstance(cell, str):
                        if cell.strip():
                            row.append(([" ".join(cell.split())], 1, 1))
                    elif not _hidden(cell):
                        span = max(1, _number(_SPAN, cell.attrs))
                        row.append(((yield _lines(cell)), span, _number(_ROWS, cell.attrs)))
                rows.append(row)
            elif part.tag in ("tbody", "thead", "tfoot"):
                rows.append(None)
                yield _cells(part, rows)
                rows.append(None)
            else:
                rows.append((yield _lines(part)))


def _placed(rows: list) -> Iterator[list[tuple[int, list[str], int]] | list[str]]:
    """The rows with the column of each cell, past cells that reach down from rows above.

    A cell over 0 rows reaches to the end of its group.
    """
    until: dict[int, float] = {}
    for number, row in enumerate(rows):
        if row is None:
            until = {}
        elif row and isinstance(row[0], str):
            # A line between rows is no row of the grid.
            until = {c: last + 1 for c, last in until.items() if last > number}
            yield row
        else:
            at, placed = 0, []
            for lines, span, down in row:
                while until.get(at, 0) > number:
                    at += 1
                placed.append((at, lines, span))
                if down != 1:
                    for c in range(at, at + span):
                        until[c] = number + down if down else float("inf")
                at += span
            yield placed


def _lines(node: Node) -> Generator:
    page = _Page()
    yield _render(node, page)
    page.flush()
    return page.lines


def _table(table: Node) -> Generator:
    found: list = []
    yield _cells(table, found)
    rows = list(_placed(found))
    widths: list[int] = []
    for row in rows:
        for cell in row:
            if isinstance(cell, str):
                continue
            at, lines, span = cell
            widths += [0] * (at + 1 - len(widths))
            if span == 1:
                widths[at] = max(widths[at], *map(len, lines)) if lines else widths[at]
    for row in rows:  # a cell over several columns widens the last of them if it must
        for cell in row:
            if isinstance(cell, str):
                continue
            at, lines, span = cell
            if span > 1:
                widths += [0] * (at + span - len(widths))
                wide = sum(widths[at : at + span]) + 2 * (span - 1)
                widths[at + span - 1] += max(0, max(map(len, lines), default=0) - wide)
    starts = [0, *accumulate(w + 2 for w in widths)]
    out: list[str] = []
    for row in rows:
        if row and isinstance(row[0], str):
            out += row
            continue
        for i in range(max((len(lines) for _, lines, _ in row), default=0)):
            text = ""
            for at, lines, _ in row:
                text = text.ljust(starts[at]) + (lines[i] if i < len(lines) else "")
            out.append(text.rstrip())
    return out


def visible_text(html: str | None) -> str:
    """The text a reader sees, lines separated by line ends; NULL gives the empty text."""
    return "\n".join(_run(_lines(build_tree(html)))) if html else ""


def extract_text(pages: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """``key`` and ``text`` of every page; reads the two columns it needs.

    NULL or empty html gives the empty text, repeated rows are rendered one by one, an empty
    table gives an empty result. Nothing is shuffled.
    """

    def render(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in row_batches(batches, 500):
            texts = [visible_text(x) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names)

    names = [key, "text"]
    kind = pages.schema[key].dataType.simpleString()
    return bounded_batches(pages).select(key, html).mapInArrow(render, f"`{key}` {kind}, text string")
