"""HTML extraction (operator 3): a small tree builder and a layout-aware text renderer.

The builder closes elements whose end tags are implied (p, li, dt, dd, option, table parts), adds the row or
the list that a stray cell or item implies, and hides what a browser hides: head, scripts, styles, templates,
the hidden attribute, display:none, visibility:hidden unless a descendant turns it visible, closed dialogs, all but
the summary of closed details, and of drawings all but their text elements. A table's foot comes last wherever it stands.
The renderer keeps block spacing (margins collapse to one empty line), numbers and indents lists, keeps white
space in pre, and aligns table cells in columns.

Cases: null and empty html give empty text; unclosed or stray tags never fail; markup that never ends is text;
elements nested deeper than ``MAX_DEPTH`` become siblings there, with their text kept; pages are read whole;
repeated rows each get their row; an empty table gives an empty result.
"""

from __future__ import annotations

import html
import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from streammart.llm.common import slices

MAX_DEPTH = 200
COLUMN = 60  # a cell longer than this does not widen its column

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style xmp iframe noembed noframes noscript".split())
RCDATA = frozenset("title textarea".split())
UNSEEN = frozenset(
    "head script style template noscript iframe noembed noframes datalist object audio video canvas title annotation annotation-xml".split()
)
LOOSE = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl table blockquote pre xmp figure fieldset hr".split())
TIGHT = frozenset(
    "address article aside body caption center dd details dialog div dt figcaption footer form header html legend "
    "li main menu nav option optgroup section summary tbody td tfoot th thead tr".split()
)
# Parts of a drawing that are drawn nowhere, or only where they are referred to.
UNDRAWN = frozenset("defs desc metadata symbol clippath mask marker pattern".split())
# Inside these, markup is that of a page again.
FOREIGN_WALLS = ("foreignobject", "desc", "title", "annotation-xml", "mi", "mo", "mn", "ms", "mtext")
# A start tag on the left ends the nearest open element on the right, unless a wall stands between.
ENDS = {
    "li": (("li",), ("ul", "ol", "menu", "table", "td", "th")),
    "dt": (("dt", "dd"), ("dl", "table", "td", "th")),
    "dd": (("dt", "dd"), ("dl", "table", "td", "th")),
    "option": (("option",), ("select", "datalist")),
    "optgroup": (("option", "optgroup"), ("select",)),
    "td": (("td", "th", "caption", "colgroup"), ("tr", "table")),
    "th": (("td", "th", "caption", "colgroup"), ("tr", "table")),
    "tr": (("tr", "caption", "colgroup"), ("table",)),
    "tbody": (("tbody", "thead", "tfoot", "caption", "colgroup"), ("table",)),
    "thead": (("tbody", "thead", "tfoot", "caption", "colgroup"), ("table",)),
    "tfoot": (("tbody", "thead", "tfoot", "caption", "colgroup"), ("table",)),
    "body": (("head",), ()),
}
P_ENDERS = (LOOSE | TIGHT) - {"body", "html", "option", "optgroup", "caption", "tbody", "td", "tfoot", "th", "thead", "tr"}
# Start tags that end an open drawing or formula.
BREAKOUT = P_ENDERS | frozenset("b big br code em embed head i img nobr ruby s small span strong strike sub sup tt u var".split())
P_WALLS = ("td", "th", "caption", "button", "table")
END_WALLS = ("table", "td", "th", "caption")

_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>|(</?)([A-Za-z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|[^<]++|<""", re.S
)
_RAW_END = {tag: re.compile(f"</{tag}", re.I | re.A) for tag in RAW | RCDATA}
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
_BLANK = re.compile(r"[ \t\n\r\f]+")
_STYLE = re.compile(r"(display|visibility)\s*:\s*([a-z-]+)", re.I)


class Node:
    __slots__ = ("tag", "attributes", "children")

    def __init__(self, tag: str, attributes: dict[str, str]):
        self.tag, self.attributes, self.children = tag, attributes, []


def _attributes(text: str) -> dict[str, str]:
    out: dict[str, str] = {}
    if text and not text.isspace():
        for name, value in _ATTRIBUTE.findall(text):
            out.setdefault(name.lower(), html.unescape(value[1:-1] if value[:1] in "\"'" and value else value))
    return out


class Builder:
    """Open elements and the tree below the root."""

    def __init__(self) -> None:
        self.root = Node("#root", {})
        self.open = [self.root]

    def close_nearest(self, tags: tuple[str, ...], walls: tuple[str, ...]) -> bool:
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].tag in tags:
                del self.open[i:]
                return True
            if self.open[i].tag in walls:
                return False
        return False

    def start(self, tag: str, attributes: dict[str, str], slash: bool = False) -> None:
        """``slash``: the tag ends in one, which counts in drawings and formulas only."""
        if tag in BREAKOUT:
            self.close_nearest(("svg", "math"), FOREIGN_WALLS)
        if tag in P_ENDERS:
            self.close_nearest(("p",), P_WALLS)
        if tag in ENDS:
            tags, walls = ENDS[tag]
            while self.close_nearest(tags, walls):  # a row ends its cell, then the row before it
                pass
        if tag in ("td", "th") and self.open[-1].tag in ("table", "tbody", "thead", "tfoot"):
            self.start("tr", {})
        if tag == "li" and self.open[-1].tag not in ("ul", "ol", "menu"):
            attributes = {"value": "", **attributes}
        node = Node(tag, attributes)
        self.open[-1].children.append(node)
        if slash and (tag in ("svg", "math") or any(n.tag in ("svg", "math") for n in self.open)):
            return
        if tag not in VOID and len(self.open) <= MAX_DEPTH:
            self.open.append(node)

    def end(self, tag: str) -> None:
        if tag in ("body", "html"):
            return
        closed = self.close_nearest((tag,), () if tag in END_WALLS or tag in ("tr", "tbody") else END_WALLS)
        if not closed and tag in ("p", "br"):
            self.open[-1].children.append(Node(tag, {}))

    def text(self, data: str) -> None:
        self.open[-1].children.append(html.unescape(data) if "&" in data else data)


def parse(page: str) -> Node:
    """The tree of a page; script-like content is dropped as it is read, that of ``xmp`` is text as it stands."""
    builder, at = Builder(), 0
    while match := _TOKEN.match(page, at):
        at = match.end()
        if match.lastindex is None:
            if not match.group().startswith(("<!", "<?")):
                builder.text(match.group())
            continue
        tag = match[2].lower()
        if match[1] == "</":
            builder.end(tag)
            continue
        builder.start(tag, _attributes(match[3]), match[3].endswith("/"))
        if tag in RAW or tag in RCDATA:
            ended = _RAW_END[tag].search(page, at)
            stop = ended.start() if ended else len(page)
            if tag in RCDATA:
                builder.text(page[at:stop])
            elif tag == "xmp":
                builder.open[-1].children.append(page[at:stop])
            at = stop
    return builder.root


def _shown(node: Node, visible: bool) -> tuple[bool, bool]:
    """Whether a node has a box at all, and whether its own text can be seen."""
    a = node.attributes
    if node.tag in UNSEEN or "hidden" in a or (node.tag == "dialog" and "open" not in a):
        return False, False
    for name, value in _STYLE.findall(a.get("style", "")):
        if name.lower() == "display" and value.lower() == "none":
            return False, False
        if name.lower() == "visibility":
            visible = value.lower() == "visible" or (visible and value.lower() not in ("hidden", "collapse"))
    return True, visible


class Page:
    """Lines of text; margins wait until text follows."""

    def __init__(self) -> None:
        self.lines: list[str] = []
        self.line: list[str] = []
        self.space = False
        self.gap = 0

    def margin(self, breaks: int) -> None:
        if self.line:
            self.lines.append("".join(self.line).rstrip(" "))
            self.line = []
            self.gap = 0
        self.space = False
        if self.lines:
            self.gap = max(self.gap, breaks - 1)

    def words(self, text: str) -> None:
        body = _BLANK.sub(" ", text)
        before = self.space or body[:1] == " "
        after = body[-1:] == " "
        body = body.strip(" ")
        if body:
            self.raw((" " if before and self.line else "") + body)
        self.space = after if body else before

    def raw(self, text: str) -> None:
        if not self.line and self.gap:
            self.lines.extend([""] * self.gap)
            self.gap = 0
        self.line.append(text)
        self.space = False

    def verbatim(self, text: str) -> None:
        first, *rest = text.split("\n")
        self.raw(first) if first or self.line else None
        for line in rest:
            self.hard_break()
            if line:
                self.raw(line)

    def hard_break(self) -> None:
        if self.line:
            self.lines.append("".join(self.line).rstrip(" "))
            self.line = []
        elif self.lines:
            self.gap = min(self.gap + 1, 1)
        self.space = False

    def block(self, lines: list[str], first: str = "", rest: str = "") -> None:
        for i, line in enumerate(lines):
            self.raw((first if i == 0 else rest) + line if line else "")
            self.margin(1)

    def finish(self) -> list[str]:
        self.margin(1)
        return self.lines


def _opened(node: Node) -> list[Node | str]:
    """The children that are there to be seen: of closed details, the first summary."""
    if node.tag != "details" or "open" in node.attributes:
        return node.children
    return [c for c in node.children if isinstance(c, Node) and c.tag == "summary"][:1]


def _drawing(node: Node, page: Page, visible: bool, depth: int) -> None:
    """The text elements of a drawing, each on a line."""
    for child in node.children:
        if isinstance(child, str) or child.tag in UNDRAWN:
            continue
        boxed, seen = _shown(child, visible)
        if boxed and child.tag in ("text", "foreignobject"):
            page.margin(1)
            _render(child, page, seen, False, depth)
            page.margin(1)
        elif boxed:
            _drawing(child, page, seen, depth)


def _render(node: Node, page: Page, visible: bool, pre: bool, depth: int) -> None:
    """``depth`` counts the lists around the node."""
    for child in _opened(node):
        if isinstance(child, str):
            if visible:
                page.verbatim(child) if pre else page.words(child)
            continue
        boxed, seen = _shown(child, visible)
        if not boxed:
            continue
        tag = child.tag
        if tag == "br":
            page.hard_break()
        elif tag == "svg":
            _drawing(child, page, seen, depth)
        elif tag == "table":
            page.margin(2)
            page.block(_table(child, seen, depth))
            page.margin(2)
        elif tag in ("ul", "ol", "menu"):
            page.margin(1 if depth else 2)
            _list(child, page, seen, depth)
            page.margin(1 if depth else 2)
        elif tag == "li":
            _item(child, page, seen, depth, "- ")
        elif tag in ("dd", "blockquote"):
            loose = 2 if tag in LOOSE else 1
            page.margin(loose)
            page.block(_inner(child, seen, pre, depth), "  ", "  ")
            page.margin(loose)
        elif tag in LOOSE or tag in TIGHT:
            breaks = 2 if tag in LOOSE else 1
            page.margin(breaks)
            _render(child, page, seen, pre or tag in ("pre", "xmp"), depth)
            page.margin(breaks)
        else:
            _render(child, page, seen, pre or tag == "textarea", depth)


def _inner(node: Node, visible: bool, pre: bool, depth: int) -> list[str]:
    page = Page()
    _render(node, page, visible, pre, depth)
    return page.finish()


def _item(node: Node, page: Page, visible: bool, depth: int, mark: str) -> None:
    page.margin(1)
    lines = _inner(node, visible, False, depth + 1)
    if lines:
        page.block(lines, mark, " " * len(mark))


def _number(text: str | None, default: int) -> int:
    return int(text) if text and re.fullmatch(r"[+-]?\d{1,9}", text.strip()) else default


def _list(node: Node, page: Page, visible: bool, depth: int) -> None:
    ordered = node.tag == "ol"
    items = sum(isinstance(c, Node) and c.tag == "li" for c in node.children)
    step = -1 if "reversed" in node.attributes else 1
    number = _number(node.attributes.get("start"), items if step < 0 else 1)
    for child in node.children:
        if isinstance(child, Node) and child.tag == "li":
            number = _number(child.attributes.get("value"), number)
            boxed, seen = _shown(child, visible)
            if boxed:
                _item(child, page, seen, depth, f"{number}. " if ordered else "- ")
            number += step
        else:
            holder = Node("#part", {})
            holder.children.append(child)
            _render(holder, page, visible, False, depth + 1)


def _width(text: str) -> int:
    if text.isascii():
        return len(text)
    return sum(0 if unicodedata.combining(c) else 2 if unicodedata.east_asian_width(c) in "WF" else 1 for c in text)


def _in_row_order(node: Node) -> list[Node | str]:
    """A table's children: its first head, then the others, then its first foot."""
    place = {"thead": 0, "tfoot": 2}
    ends = {t: next((c for c in node.children if isinstance(c, Node) and c.tag == t), None) for t in place}
    return sorted(node.children, key=lambda c: place[c.tag] if isinstance(c, Node) and c is ends.get(c.tag) else 1)


def _table(node: Node, visible: bool, depth: int) -> list[str]:
    """Lines of a table: captions, then rows with aligned columns; spans leave blank cells."""
    captions: list[str] = []
    grid: list[dict[int, list[str]]] = []
    spread: set[tuple[int, int]] = set()  # cells over several columns widen none
    taken: dict[int, int] = {}  # column -> rows that a cell above still covers
    queue: list[tuple[Node | str, bool]] = [(c, visible) for c in reversed(_in_row_order(node))]
    while queue:
        part, seen = queue.pop()
        if isinstance(part, str):
            if seen and part.strip():
                captions.append(_BLANK.sub(" ", part).strip())
            continue
        boxed, seen = _shown(part, seen)
        if not boxed:
            continue
        if part.tag in ("tbody", "thead", "tfoot"):
            queue += [(c, seen) for c in reversed(part.children)]
        elif part.tag != "tr":
            holder = Node("#part", {})
            holder.children.append(part)
            captions += _inner(holder, seen, False, 0)
        else:
            row, column = {}, 0
            covered = {c: n - 1 for c, n in taken.items() if n > 1}
            for cell in part.children:
                if isinstance(cell, str):
                    if not seen or not cell.strip():
                        continue
                    holder = Node("#part", {})
                    holder.children.append(cell)
                    cell = holder
                boxed, cell_seen = _shown(cell, seen)
                if not boxed:
                    continue
                while column in taken:
                    column += 1
                row[column] = _inner(cell, cell_seen, False, 0)
                spread |= {(len(grid), column)} if cell.attributes.get("colspan") else set()
                across = max(1, min(100, _number(cell.attributes.get("colspan"), 1)))
                down = max(1, _number(cell.attributes.get("rowspan"), 1))
                if down > 1:
                    covered.update((column + k, down - 1) for k in range(across))
                column += across
            taken = covered
            grid.append(row)
    widths: dict[int, int] = {}
    for i, row in enumerate(grid):
        for column, lines in row.items():
            fit = [w for w in map(_width, lines) if w <= COLUMN and (i, column) not in spread]
            widths[column] = max([widths.get(column, 0), *fit])
    out = list(captions)
    for row in grid:
        used = sorted(c for c, lines in row.items() if any(lines))
        if not used:
            continue
        for i in range(max(len(row[c]) for c in used)):
            line, places = "", [c for c in sorted(widths) if c <= used[-1]]
            for c in places:
                cell = row[c][i] if c in row and i < len(row[c]) else ""
                line += cell + " " * (max(0, widths[c] - _width(cell)) + 2)
            out.append(line.rstrip(" "))
    return out


def extract(page: str | None) -> str:
    """All visible text of a page, one line per text line, blocks apart by an empty line."""
    return "\n".join(_inner(parse(page or ""), True, False, 0)).strip("\n")


def extracted(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """The id column and ``text``."""
    kept = pages.select(id_col, html_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = [extract(p) for p in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], [id_col, "text"])

    kind = kept.schema[id_col].dataType.simpleString()
    return kept.mapInArrow(run, f"`{id_col}` {kind}, text string")


def rendered(spark: SparkSession, pages: DataFrame) -> DataFrame:
    return extracted(pages)
