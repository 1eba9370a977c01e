"""Text of web pages as a layout shows it.

A tree is built from the tags as browsers would: end tags that authors may leave out are implied,
stray ones are ignored, and elements nested deeper than ``DEPTH`` join the element at that depth.
Elements that are not displayed go with all that they hold, at any depth: by kind, by the ``hidden``
attribute or by inline style (content made visible again inside goes too). The rest is rendered: white space collapses outside ``pre``, blocks start lines and paragraphs keep a
blank line around them, list items carry bullets or numbers and indents, and the cells of a table
stand in aligned columns, each cell rendered on its own. A cell wider than ``CELL`` characters leaves
the grid, as do columns that would start after ``GRID``: they push what follows, so a page of
many rows is not blown up by one wide cell. A comment without an end reaches to the end of the page.
All visible text is emitted; there is no filter for boilerplate.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from spanloom.llm.tables import slices, text_of, values

#: Deepest element of a tree, and the most columns or rows that a cell takes up.
DEPTH = 120
SPAN = 100
#: Widest cell that widens its column, and the last place where an aligned column starts.
CELL = 100
GRID = 1_000

# Fixed values of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INVISIBLE = frozenset(
    "head title script style template noscript iframe object audio video canvas datalist svg math "
    "noframes noembed map frameset".split()
)
PARAGRAPHS = frozenset(
    "p h1 h2 h3 h4 h5 h6 ul ol dl blockquote pre table figure fieldset menu dir listing".split()
)
LINES = frozenset(
    "html body address article aside center dd details dialog div dt figcaption footer form header "
    "hgroup legend li main nav optgroup option search section summary caption tr tbody thead tfoot".split()
)
CLOSES_P = (PARAGRAPHS | LINES | {"hr"}) - frozenset(
    "html body dd dt li optgroup option legend caption tr tbody thead tfoot summary".split()
)
#: A start tag ends open elements of these kinds, up to the nearest element of the scope.
IMPLIED_END = {
    "li": (frozenset({"li"}), frozenset({"ul", "ol", "menu", "dir", "table"})),
    "dt": (frozenset({"dt", "dd"}), frozenset({"dl", "table"})),
    "dd": (frozenset({"dt", "dd"}), frozenset({"dl", "table"})),
    "option": (frozenset({"option"}), frozenset({"select", "datalist"})),
    "optgroup": (frozenset({"option", "optgroup"}), frozenset({"select"})),
    "tr": (frozenset({"tr", "td", "th", "caption"}), frozenset({"table"})),
    "td": (frozenset({"td", "th", "caption"}), frozenset({"table", "tr"})),
    "th": (frozenset({"td", "th", "caption"}), frozenset({"table", "tr"})),
    "tbody": (frozenset({"tr", "td", "th", "tbody", "thead", "tfoot", "caption"}), frozenset({"table"})),
    "thead": (frozenset({"tr", "td", "th", "tbody", "thead", "tfoot", "caption"}), frozenset({"table"})),
    "tfoot": (frozenset({"tr", "td", "th", "tbody", "thead", "tfoot", "caption"}), frozenset({"table"})),
    "body": (frozenset({"head"}), frozenset()),
}
#: An end tag does not reach out of a cell, those of table parts not out of their table.
CELL_BARRIER = frozenset({"td", "th", "caption", "table"})
TABLE_PARTS = frozenset("table td th tr tbody thead tfoot".split())
HEAD_ONLY = frozenset("title base link meta style script template noscript".split())

_NOT_SHOWN = re.compile(r"(?:^|;)\s*(?:display\s*:\s*none|visibility\s*:\s*(?:hidden|collapse))", re.I)
_COMMENT_END = re.compile(r"--!?>")
_SHORT_COMMENT = re.compile(r"-?>")
_BLANKS = re.compile(r"[ \t\n\r\f]+")


class Node:
    __slots__ = ("tag", "attributes", "children")

    def __init__(self, tag: str, attributes: dict[str, str | None]):
        self.tag = tag
        self.attributes = attributes
        self.children: list[Node | str] = []


class TreeBuilder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Node("html", {})
        self.open = [self.root]
        self.joined: Counter[str] = Counter()  # elements below DEPTH, which are not opened
        # The element that is not displayed, if there is one, and what is open in it.
        self.hidden: str | None = None
        self.inside: Counter[str] = Counter()

    def parse_comment(self, i, report=True):
        end = _COMMENT_END.search(self.rawdata, i + 4)
        short = _SHORT_COMMENT.match(self.rawdata, i + 4)
        if short:
            return short.end()
        return end.end() if end else len(self.rawdata)

    def _ends_hidden(self, tag: str) -> bool:
        """Whether a start tag implies the end of the element that is not displayed."""
        if tag in CLOSES_P and self.hidden == "p":
            return not any(self.inside[x] for x in ("table", "td", "th", "button", "caption"))
        kinds, scope = IMPLIED_END.get(tag, (frozenset(), frozenset()))
        return self.hidden in kinds and not any(self.inside[x] for x in scope)

    def _cut(self, at: int) -> None:
        """End the open elements from this one on, and with them all below DEPTH."""
        del self.open[at:]
        self.joined.clear()

    def _close(self, kinds: frozenset, scope: frozenset) -> None:
        """End the outermost open element of ``kinds`` inside the nearest one of ``scope``."""
        end = None
        for i in range(len(self.open) - 1, 0, -1):
            tag = self.open[i].tag
            if tag in scope:
                break
            if tag in kinds:
                end = i
        if end is not None:
            self._cut(end)

    def handle_starttag(self, tag, attributes):
        if tag == "html":
            return
        if self.hidden:
            if not self._ends_hidden(tag):
                self.inside[tag] += tag not in VOID
                return
            self.hidden = None
        if self.open[-1].tag == "head" and tag not in HEAD_ONLY:
            self.open.pop()
        if tag in CLOSES_P:
            self._close(frozenset({"p"}), frozenset({"table", "td", "th", "button", "caption"}))
        if tag in IMPLIED_END:
            self._close(*IMPLIED_END[tag])
        if tag in ("td", "th") and self.open[-1].tag in ("table", "tbody", "thead", "tfoot"):
            self._push(Node("tr", {}))
        node = Node(tag, dict(attributes))
        if tag in VOID:
            self.open[-1].children.append(node)
        else:
            self._push(node)

    def _push(self, node: Node) -> None:
        if node.tag != "head" and not visible(node):
            self.hidden, self.inside = node.tag, Counter()
            return
        self.open[-1].children.append(node)
        if len(self.open) < DEPTH:
            self.open.append(node)
        else:
            self.joined[node.tag] += 1

    def handle_startendtag(self, tag, attributes):
        # A slash in a start tag means nothing, but for void elements, which have no end anyway.
        self.handle_starttag(tag, attributes)
        if self.cdata_elem is None and tag in ("script", "style"):
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if self.hidden:
            if self.inside[tag]:
                self.inside[tag] -= 1
                return
            if tag == self.hidden:
                self.hidden = None
                return
            if not self.joined[tag] and all(node.tag != tag for node in self.open[1:]):
                return
            self.hidden = None
        if self.joined[tag]:
            self.joined[tag] -= 1
            if tag in PARAGRAPHS or tag in LINES:
                self.open[-1].children.append(Node("div", {}))  # what follows starts a line
            return
        if tag == "br":
            self.open[-1].children.append(Node("br", {}))
            return
        if tag in ("html", "body"):
            return
        barrier = CELL_BARRIER
        if tag in TABLE_PARTS:
            barrier = frozenset() if tag == "table" else frozenset({"table"})
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].tag == tag:
                self._cut(i)
                return
            if self.open[i].tag in barrier:
                return

    def handle_data(self, data):
        if self.hidden:
            return
        if self.open[-1].tag == "head" and data.strip():
            self.open.pop()
        self.open[-1].children.append(data)


def parse(html: str) -> Node:
    builder = TreeBuilder()
    builder.feed(html)
    builder.close()
    return builder.root


def visible(node: Node) -> bool:
    return (
        node.tag not in INVISIBLE
        and "hidden" not in node.attributes
        and not _NOT_SHOWN.search(node.attributes.get("style") or "")
    )


class Canvas:
    """Lines of text under way: the open line, blank lines due before it, indents and a bullet."""

    def __init__(self):
        self.lines: list[str] = []
        self.line: list[str] = []
        self.blank = False  # white space is due before the next word
        self.gap = 0
        self.indents: list[str] = []
        self.bullet = ""

    def words(self, text: str) -> None:
        """Text with collapsing white space."""
        parts = _BLANKS.split(text)
        for i, word in enumerate(parts):
            if i:
                self.blank = True
            if word:
                if self.blank and self.line:
                    self.line.append(" ")
                self.line.append(word)
                self.blank = False

    def preformatted(self, text: str) -> None:
        first, *rest = text.replace("\r\n", "\n").split("\n")
        self.line.append(first)
        for part in rest:
            self.end_line(always=True)
            self.line.append(part)

    def end_line(self, always: bool = False) -> None:
        text = "".join(self.line).rstrip()
        self.line, self.blank = [], False
        if not text and not always:
            return
        if self.lines:
            self.lines.extend([""] * self.gap)
        self.gap = 0
        self.lines.append(("".join(self.indents) + self.bullet + text).rstrip())
        if self.bullet:
            self.indents.append(" " * len(self.bullet))
            self.bullet = ""

    def block(self, gap: int) -> None:
        """The next text starts a line, after so many blank ones."""
        self.end_line()
        self.gap = max(self.gap, gap)

    def text_lines(self) -> list[str]:
        self.end_line()
        return self.lines


def _item(node: Node, bullet: str, canvas: Canvas, pre: bool) -> None:
    canvas.block(0)
    depth = len(canvas.indents)
    before, canvas.bullet = canvas.bullet, ""
    if before:  # an item that begins with a list keeps its own bullet on that line
        bullet = before + bullet
    canvas.bullet = bullet
    _children(node, canvas, pre)
    canvas.block(0)
    canvas.bullet = ""
    del canvas.indents[depth:]


def _list(node: Node, canvas: Canvas, pre: bool) -> None:
    start = str(node.attributes.get("start") or "1")
    number = int(start) if re.fullmatch(r"-?\d{1,9}", start) else 1
    for child in node.children:
        if isinstance(child, Node) and child.tag == "li" and visible(child):
            _item(child, f"{number}. " if node.tag == "ol" else "* ", canvas, pre)
            number += 1
        else:
            _render(child, canvas, pre)


def _rows(node: Node) -> Iterator[Node]:
    for child in node.children:
        if isinstance(child, Node) and visible(child):
            if child.tag == "tr":
                yield child
            elif child.tag in ("tbody", "thead", "tfoot"):
                yield from _rows(child)


def _span(node: Node, kind: str) -> int:
    value = node.attributes.get(kind) or "1"
    return min(max(int(value), 1), SPAN) if re.fullmatch(r"\d{1,9}", value) else 1


def _table(node: Node, canvas: Canvas) -> None:
    """Captions and stray text first, then the rows with their cells in aligned columns."""
    def outside(top: Node) -> None:
        for child in top.children:
            if isinstance(child, str) or child.tag not in ("tr", "tbody", "thead", "tfoot"):
                _render(child, canvas, False)
            elif visible(child):
                if child.tag == "tr":
                    for inner in child.children:
                        if isinstance(inner, str) or inner.tag not in ("td", "th"):
                            _render(inner, canvas, False)
                else:
                    outside(child)
        canvas.block(0)

    outside(node)
    table, widths = [], {}
    taken: dict[int, int] = {}  # column -> first row that a cell from above leaves free
    for number, row in enumerate(_rows(node)):
        cells, column = [], 0
        for cell in row.children:
            if isinstance(cell, Node) and cell.tag in ("td", "th") and visible(cell):
                own = Canvas()
                _children(cell, own, False)
                lines, span = own.text_lines(), _span(cell, "colspan")
                while taken.get(column, 0) > number:
                    column += 1
                if span == 1:
                    widths[column] = max([widths.get(column, 0), *(n for n in map(len, lines) if n <= CELL)])
                rows = _span(cell, "rowspan")
                if rows > 1:
                    taken.update((column + i, number + rows) for i in range(span))
                cells.append((column, span, lines))
                column += span
        table.append(cells)
    starts, columns = {}, 1 + max((c + s for cells in table for c, s, _ in cells), default=0)
    at = 0
    for column in range(columns):
        starts[column] = at
        if widths.get(column):
            at = min(at + widths[column] + 2, GRID)
    for cells in table:
        for height in range(max((len(lines) for *_, lines in cells), default=0)):
            line = ""
            for column, _, lines in cells:
                if height < len(lines) and lines[height]:
                    line = line.ljust(starts[column])
                    if len(line) > starts[column] and not line.endswith(" "):
                        line += "  "  # a wide spanning cell pushes what follows
                    line += lines[height]
            canvas.line.append(line)
            canvas.end_line()


def _children(node: Node, canvas: Canvas, pre: bool) -> None:
    for child in node.children:
        _render(child, canvas, pre)


def _render(node: Node | str, canvas: Canvas, pre: bool) -> None:
    if isinstance(node, str):
        canvas.preformatted(node) if pre else canvas.words(node)
        return
    tag = node.tag
    if not visible(node):
        return
    if tag == "br":
        canvas.end_line(always=True)
    elif tag == "hr":
        canvas.block(1)
    elif tag in VOID:
        return
    elif tag in PARAGRAPHS or tag in LINES:
        nested = tag in ("ul", "ol", "menu", "dir") and bool(canvas.indents or canvas.bullet)
        gap = 1 if tag in PARAGRAPHS and not nested else 0
        # The first block of a list item stands on the line of the bullet.
        canvas.block(0 if canvas.bullet else gap)
        depth = len(canvas.indents)
        if tag in ("ul", "ol", "menu", "dir"):
            _list(node, canvas, pre)
        elif tag == "table":
            _table(node, canvas)
        elif tag in ("blockquote", "dd"):
            canvas.indents.append("  ")
            _children(node, canvas, pre)
        elif tag == "li":
            _item(node, "* ", canvas, pre)
        elif tag == "details" and "open" not in node.attributes:
            for child in node.children:
                if isinstance(child, Node) and child.tag == "summary":
                    _render(child, canvas, pre)
        else:
            _children(node, canvas, pre or tag in ("pre", "listing"))
        canvas.block(gap)
        if tag in ("blockquote", "dd"):
            del canvas.indents[depth:]
    elif tag in ("td", "th"):  # outside a table
        canvas.blank = True
        _children(node, canvas, pre)
        canvas.blank = True
    else:
        _children(node, canvas, pre or tag == "textarea")


def render(html: str) -> str:
    """The visible text of a page."""
    canvas = Canvas()
    _children(parse(html), canvas, False)
    return "\n".join(canvas.text_lines()).strip("\n")


def extract_text(
    pages: DataFrame, html: str = "html", out: str = "text", passed: list[str] | None = None
) -> DataFrame:
    """The columns ``passed`` (all by default) and the visible text of each page in ``out``.

    A null or empty page has the empty text; pages are rendered whole, however long; repeated
    rows are rendered each; an empty table gives an empty one. A column named like ``out`` is
    replaced, all others pass through.
    """
    kept = [c for c in passed or pages.columns if c != out]
    schema = pages.select(*kept).schema.add(out, "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = [render(text_of(page)) for page in values(batch.column(0))]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], pa.array(texts, pa.string())], names=[*kept, out]
            )

    return pages.select(F.col(html).alias("_page"), *kept).mapInArrow(run, schema)


def page_texts(pages: DataFrame) -> DataFrame:
    """page_id, text, n_chars, n_lines of every page."""
    texts = extract_text(pages.select("page_id", "html"), passed=["page_id"])
    lines = F.when(F.col("text") == "", 0).otherwise(F.size(F.split("text", "\n"))).cast("bigint")
    return texts.select(
        "page_id", "text", F.length("text").cast("bigint").alias("n_chars"), lines.alias("n_lines")
    )
