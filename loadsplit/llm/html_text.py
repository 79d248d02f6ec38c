"""HTML extraction by layout-aware rendering: a tree builder with implied tags,
visibility rules, and a renderer that emits all visible text with block
spacing, lists and aligned table cells.

The page is read once by the standard tokenizer. The tree builder closes what a
new tag closes by implication (the head, paragraphs before blocks, list items,
table rows and cells, options, definition terms), ignores end tags without a start, and
closes what is open at the end. Below ``MAX_DEPTH`` open elements, further ones
are put side by side, so depth is bounded and no text is lost. Rendering
follows: white space collapses in a line except inside ``pre``; paragraphs,
headings, lists and tables stand apart by an empty line and other blocks by a
line break; list items are marked, numbered as ``start``, ``value`` and ``reversed``
say, and indented; the cells of a table stand in columns, spans over columns and
rows included, and the blanks for that are bounded by the page's length, beyond which
long cells do not widen their column. Formulas stand in the line, the text elements of a drawing are
words of it, and every option of a select is a line.

Defined cases: a null or empty page gives empty text; unclosed, misnested and
unknown tags are read as above; hidden elements (``hidden``, ``display:none``,
``visibility:hidden``, templates, scripts and their noscript, styles, the head,
titles, marked sections, datalists, annotations of formulas, definitions and descriptions of
drawings, what stands in for iframe, object, audio, video and canvas) give no
text; repeated rows and null ids keep their rows; very long pages are read
whole; an empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import bisect
import html
import math
import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import utf8

MAX_DEPTH = 150
#: widths up to which a cell's lines make their column wide, the first that the page has room for
CELL_WIDTHS = (80, 40, 20, 10, 0)

#: fixed values: element classes of HTML
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = frozenset("head script style template noscript title datalist iframe object audio video canvas annotation annotation-xml".split())
APART = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl table pre blockquote figure".split())
BLOCK = APART | frozenset(
    "html body div section article aside header footer main nav address form fieldset legend figcaption li dt dd hr details summary "
    "center dir menu hgroup search caption thead tbody tfoot tr td th option optgroup".split())
#: start tag -> open elements it ends, up to the nearest of the bounding elements
IMPLIED = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select", "datalist"}), "optgroup": ({"option", "optgroup"}, {"select"}),
    "tr": ({"tr", "td", "th", "caption", "colgroup"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "thead": ({"tr", "td", "th", "thead", "tbody", "tfoot", "caption", "colgroup"}, {"table"}),
    "tbody": ({"tr", "td", "th", "thead", "tbody", "tfoot", "caption", "colgroup"}, {"table"}),
    "tfoot": ({"tr", "td", "th", "thead", "tbody", "tfoot", "caption", "colgroup"}, {"table"}),
    "body": ({"head"}, set()),
}
#: all that a head holds; anything else ends it
HEAD = frozenset("html head base basefont bgsound link meta title style script noscript noframes template".split())
#: inside these, a self-closed tag has no content
FOREIGN = frozenset(("svg", "math"))
#: HTML stands in them again
INTEGRATION = frozenset("foreignobject desc title mi mo mn ms mtext annotation-xml".split())
#: HTML tags that end open svg and math elements
BREAKOUT = frozenset(
    "b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li listing menu meta nobr ol p pre ruby s "
    "small span strong strike sub sup table tt u ul var".split())
#: elements of svg that only define or describe, and their text is not drawn
SVG_UNSEEN = frozenset("defs symbol desc metadata clippath mask marker pattern lineargradient radialgradient filter".split())
#: an end tag or implied end does not reach past these
SCOPE = frozenset("table td th caption html template".split())
_SPACE = re.compile(r"[ \t\n\r\f]+")
_UNSEEN = re.compile(r"(?:^|;)\s*display\s*:\s*none\b", re.I)
_VISIBILITY = re.compile(r"(?:^|;)\s*visibility\s*:\s*(hidden|collapse|visible)\b", re.I)


class Node:
    __slots__ = ("tag", "attrs", "children")

    def __init__(self, tag: str, attrs: dict[str, str | None]):
        self.tag, self.attrs, self.children = tag, attrs, []


class TreeBuilder(HTMLParser):
    """The page as a tree of nodes and strings."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Node("#root", {})
        self.open = [self.root]
        #: an svg or math element has come
        self.foreign = False

    def _foreign(self) -> int:
        """Place of the outermost open svg or math that no HTML stands in, or 0."""
        found = 0
        if self.foreign:
            for k in range(len(self.open) - 1, 0, -1):
                if self.open[k].tag in INTEGRATION:
                    break
                if self.open[k].tag in FOREIGN:
                    found = k
        return found

    def _close(self, tags: set[str], bounds: set[str] | frozenset[str]) -> None:
        """End the outermost open element among ``tags`` inside the nearest bound."""
        found = None
        for k in range(len(self.open) - 1, 0, -1):
            tag = self.open[k].tag
            if tag in tags:
                found = k
            elif tag in bounds:
                break
        if found:
            del self.open[found:]

    def _end_head(self) -> None:
        """What cannot be in a head ends one whose end tag is left out."""
        if self.open[-1].tag == "head":
            self._close({"head"}, set())

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self._start(tag, attrs, False)
        if tag == "textarea":  # what looks like tags in it is text
            self.set_cdata_mode(tag)

    def _start(self, tag: str, attrs: list[tuple[str, str | None]], closed: bool) -> None:
        if tag not in HEAD:
            self._end_head()
        if tag in BREAKOUT and (k := self._foreign()):
            del self.open[k:]
        if tag in FOREIGN:
            self.foreign = True
        if closed:
            closed = tag in FOREIGN or self._foreign() > 0
        if tag in IMPLIED:
            self._close(*IMPLIED[tag])
        if tag in BLOCK and tag not in ("option", "optgroup"):
            self._close({"p"}, SCOPE | {"button"})
        if tag in HEADINGS and self.open[-1].tag in HEADINGS:
            self.open.pop()
        node = Node(tag, dict(attrs))
        self.open[-1].children.append(node)
        if tag not in VOID and not closed and len(self.open) < MAX_DEPTH:
            self.open.append(node)

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self._start(tag, attrs, True)

    def parse_html_declaration(self, i: int) -> int:
        """A marked section, of whatever name, is a comment up to the next ``>``;
        in svg and math CDATA is text."""
        if not self.rawdata.startswith("<![", i):
            return super().parse_html_declaration(i)
        if self.rawdata.startswith("<![CDATA[", i) and self._foreign():
            end = self.rawdata.find("]]>", i)
            self.handle_data(self.rawdata[i + 9:end if end >= 0 else None])
            return end + 3 if end >= 0 else len(self.rawdata)
        end = self.rawdata.find(">", i)
        return end + 1 if end >= 0 else len(self.rawdata)

    def handle_endtag(self, tag: str) -> None:
        if tag == "br":
            self._end_head()
            self.open[-1].children.append(Node("br", {}))
        else:
            self._close_last(tag)

    def _close_last(self, tag: str) -> None:
        for k in range(len(self.open) - 1, 0, -1):
            if self.open[k].tag == tag:
                del self.open[k:]
                return
            if self.open[k].tag in SCOPE and tag not in ("table", "tr", "tbody", "thead", "tfoot", "html", "body", "template"):
                return

    def handle_data(self, data: str) -> None:
        if self.open[-1].tag == "textarea":
            data = html.unescape(data)
        if data.strip(" \t\n\r\f"):
            self._end_head()
            if len(self.open) == MAX_DEPTH and self._foreign():  # its text element may not be open
                node = Node("text", {})
                node.children.append(data)
                self.open[-1].children.append(node)
                return
        self.open[-1].children.append(data)


HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())


def parse(page: str) -> Node:
    builder = TreeBuilder()
    builder.feed(page)
    builder.close()
    return builder.root


def visible(node: Node) -> bool:
    a = node.attrs
    return not (node.tag in HIDDEN or "hidden" in a or (a.get("style") and _UNSEEN.search(a["style"])))


class Page:
    """Lines under construction: text with collapsed spaces, and breaks between blocks."""

    def __init__(self, spare: list[int]):
        self.lines: list[str] = []
        self.line, self.gap, self.space = "", 0, False
        self.spare = spare  # blanks that tables of the page may still be padded with

    def text(self, data: str) -> None:
        data = _SPACE.sub(" ", data)
        if data.startswith(" ") and self.line:
            self.space = True
        words = data.strip(" ")
        if words:
            self._open()
            self.line += (" " if self.space and self.line and not self.line.endswith(" ") else "") + words
            self.space = data.endswith(" ")

    def _open(self) -> None:
        if not self.line and self.lines and self.gap > 1:
            self.lines.append("")
        self.gap = 0

    def raw(self, data: str) -> None:
        for k, part in enumerate(data.split("\n")):
            if k:
                self.newline()
            if part:
                self._open()
                self.line += part

    def newline(self) -> None:
        """End the line, also an empty one."""
        self._open()
        self.lines.append(self.line.rstrip(" "))
        self.line, self.space = "", False

    def block(self, apart: bool = False) -> None:
        """End the line if there is one; ``apart`` asks for an empty line before what follows."""
        if self.line:
            self.lines.append(self.line.rstrip(" "))
            self.line = ""
        self.space = False
        self.gap = max(self.gap, 2 if apart else 1)

    def block_of(self, lines: list[str], first: str = "", rest: str = "") -> None:
        """Finished lines as a block, behind a mark and an indent."""
        for k, x in enumerate(lines):
            self._open()
            self.lines.append(((first if k == 0 else rest) + x).rstrip(" "))

    def done(self) -> list[str]:
        self.block()
        while self.lines and not self.lines[-1]:
            self.lines.pop()
        return self.lines


def _number(value: str | None, least: int, most: int) -> int:
    try:
        return min(most, max(least, int(value or least)))
    except ValueError:
        return least


def _whole(value: str | None, default: int) -> int:
    try:
        return min(10**9, max(-10**9, int(value))) if value else default
    except ValueError:
        return default


def _cells(node: Node, row: list[Node]) -> Node:
    """Put the cells under a row into ``row``; returns the row without them.
    Elements around cells (a form) are looked into, other tables are not."""
    rest = Node(node.tag, node.attrs)
    for c in node.children:
        if isinstance(c, str) or c.tag == "table" or not visible(c):
            rest.children.append(c)
        elif c.tag in ("td", "th"):
            row.append(c)
        else:
            rest.children.append(_cells(c, row))
    return rest


def _grid(rows: list[list[tuple[list[str], int, int]]]) -> list[list[tuple[int, int, list[str]]]]:
    """Rows of one section as (column, columns spanned, lines): a cell takes the first
    column that no cell from above still spans."""
    held: dict[int, int] = {}  # column -> last row that a cell from above covers
    out = []
    for r, row in enumerate(rows):
        at, placed = 0, []
        for lines, across, down in row:
            while held.get(at, -1) >= r:
                at += 1
            placed.append((at, across, lines))
            for c in range(at, at + across) if down > 1 else ():
                held[c] = r + down - 1
            at += across
        out.append(placed)
    return out


def _laid(rows: list[list[tuple[int, int, list[str]]]], cap: int) -> Iterator[str]:
    """Lines of placed rows. A column is as wide as its longest line of up to ``cap``
    characters; a longer line pushes its neighbours on in its own line only."""
    width: dict[int, int] = {}
    for row in rows:
        for at, across, lines in row:
            if across == 1:
                width[at] = max(width.get(at, 0), max((len(x) for x in lines if len(x) <= cap), default=0))
    start, x = {}, 0
    for c in sorted(width):
        start[c] = x
        x += width[c] + 2
    starts = sorted(start)
    for row in rows:
        for k in range(max((len(lines) for _, _, lines in row), default=0)):
            line = ""
            for at, _, lines in row:
                if k < len(lines) and lines[k]:
                    place = start[at] if at in start else start[starts[i - 1]] if (i := bisect.bisect(starts, at)) else 0
                    line = line.ljust(max(place, len(line) + 2) if line else place) if cap else line + "  " * bool(line)
                    line += lines[k]
            yield line.rstrip(" ")


def _table(node: Node, spare: list[int]) -> list[str]:
    """Caption, then rows whose cells stand in columns. ``spare`` is how many blanks the
    page's tables may still be padded with; the widest of ``CELL_WIDTHS`` that it
    allows is taken, the last one pads nothing."""
    caption: list[str] = []
    sections: list[list] = [[]]

    def walk(n: Node) -> None:
        for c in n.children:
            if isinstance(c, str) or not visible(c):
                continue
            if c.tag == "tr":
                row: list[Node] = []
                caption.extend(lines_of(_cells(c, row), spare=spare))
                sections[-1].append([(lines_of(x, spare=spare), _number(x.attrs.get("colspan"), 1, 1000),
                                      65534 if x.attrs.get("rowspan") == "0" else _number(x.attrs.get("rowspan"), 1, 65534)) for x in row])
            elif c.tag in ("thead", "tbody", "tfoot"):
                sections.append([])
                walk(c)
                sections.append([])
            else:
                caption.extend(lines_of(c, spare=spare))
        # text beside rows and cells is kept, before the table
        caption.extend(x for x in (_SPACE.sub(" ", c).strip() for c in n.children if isinstance(c, str)) if x)

    walk(node)
    rows = [row for section in sections for row in _grid(section)]
    content = sum(len(x) for row in rows for _, _, lines in row for x in lines)
    for cap in CELL_WIDTHS:
        body, size, most = [], 0, content + spare[0] if cap else math.inf
        for line in _laid(rows, cap):
            body.append(line)
            size += len(line)
            if size > most:
                break
        else:
            spare[0] -= max(size - content, 0)
            break
    return caption + body


def _svg(node: Node, page: Page) -> None:
    """The drawn text: text elements apart from each other, and HTML inside."""
    for c in node.children:
        if isinstance(c, str) or not visible(c) or c.tag in SVG_UNSEEN or (c.attrs.get("display") or "").strip() == "none" \
                or (c.attrs.get("visibility") or "").strip() in ("hidden", "collapse"):
            continue
        if c.tag == "text":
            page.text(" ")
            _render(c, page, False)
            page.text(" ")
        elif c.tag == "foreignobject":
            page.block()
            _render(c, page, False)
            page.block()
        else:
            _svg(c, page)


def lines_of(node: Node, pre: bool = False, spare: list[int] | None = None) -> list[str]:
    """Rendered lines of a node's content."""
    page = Page([0] if spare is None else spare)
    _render(node, page, pre or node.tag == "pre")
    return page.done()


def _render(node: Node, page: Page, pre: bool) -> None:
    back = node.tag == "ol" and "reversed" in node.attrs
    items = sum(isinstance(c, Node) and c.tag == "li" and visible(c) for c in node.children) if back else 1
    number, step = _whole(node.attrs.get("start"), items), -1 if back else 1
    for c in node.children:
        if isinstance(c, str):
            page.raw(c) if pre else page.text(c)
        elif not visible(c):
            continue
        elif c.tag == "br":
            page.newline()
        elif c.tag == "img":
            page.text(c.attrs.get("alt") or "")
        elif c.tag == "svg":
            _svg(c, page)
        elif c.tag in ("option", "optgroup"):
            page.block()
            shown = c
            if c.attrs.get("label"):
                page.text(c.attrs["label"])
                page.block()
                if c.tag == "option":  # its label stands for its text
                    shown = Node(c.tag, c.attrs)
                    shown.children = [x for x in c.children if isinstance(x, Node)]
            _render(shown, page, pre)
            page.block()
        elif c.tag == "table":
            page.block(True)
            page.block_of(_table(c, page.spare))
            page.block(True)
        elif c.tag == "li":
            number = _whole(c.attrs.get("value"), number)
            mark = f"{number}. " if node.tag == "ol" else "- "
            number += step
            page.block()
            page.block_of(lines_of(c, pre, page.spare), mark, " " * len(mark))
            page.block()
        elif c.tag in ("blockquote", "dd"):
            page.block(c.tag in APART)
            page.block_of(lines_of(c, pre, page.spare), "  ", "  ")
            page.block(c.tag in APART)
        elif c.tag in BLOCK:
            page.block(c.tag in APART)
            _render(c, page, pre or c.tag == "pre")
            page.block(c.tag in APART)
        else:
            _render(c, page, pre)


def _drop_unseen(node: Node, unseen: bool = False) -> Node | None:
    """The tree without what ``visibility`` hides: it is inherited, and an element inside
    can be visible again. Cells and rows stay in their place."""
    style = _VISIBILITY.search(node.attrs.get("style") or "")
    if style:
        unseen = style[1].lower() != "visible"
    if node.tag in VOID or node.tag in FOREIGN:
        return None if unseen else node
    found = [c if isinstance(c, str) else _drop_unseen(c, unseen) for c in node.children if not (unseen and isinstance(c, str))]
    node.children = [c for c in found if c is not None]
    return node if node.children or not unseen or node.tag in ("td", "th", "tr") else None


def render(page: str) -> str:
    """The page's visible text; its tables are padded with at most twice its length in blanks."""
    tree = parse(page)
    return "\n".join(lines_of(_drop_unseen(tree) or tree, spare=[2 * len(page)]))


def extract(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """One row per page: id, text, n_lines."""
    rows = pages.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{html_col}`").alias("_html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 1000):
                part = b.slice(at, 1000)
                texts = [render(h.decode()) for h in utf8(part.column(1))]
                lines = [t.count("\n") + 1 if t else 0 for t in texts]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(texts, pa.string()), pa.array(lines, pa.int64())], ["_id", "text", "n_lines"])

    schema = rows.select("_id").schema.add("text", "string").add("n_lines", "long")
    return rows.mapInArrow(run, schema).withColumnRenamed("_id", id_col)
