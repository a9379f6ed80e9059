"""Visible text of web pages: a tree builder, visibility rules and a layout of blocks and tables."""

from __future__ import annotations

import re
from bisect import insort
from collections import Counter
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contrail.llm.common import fresh, small_batches

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
UNSEEN = frozenset(
    "head script style template noscript title iframe object audio video canvas datalist "
    "annotation annotation-xml".split()
)
# Parts of a drawing that are not drawn where they stand.
UNDRAWN = frozenset("desc defs metadata symbol clippath mask pattern marker".split())
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre plaintext xmp ul ol dl table figure hr".split())
BLOCKS = SPACED | frozenset(
    "html body div section article aside header footer main nav address form fieldset figcaption "
    "li dt dd details summary legend center tr caption thead tbody tfoot".split()
)
# All that an open head takes; other tags and text end it.
IN_HEAD = frozenset("title meta link base script style template noscript noframes".split())
# An opening tag ends the open elements on the right, up to the first of those after the bar.
_LIST, _TABLE = {"ul", "ol", "menu"}, {"table"}
ENDS = {
    "li": ({"li"}, _LIST),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "td": ({"td", "th"}, _TABLE),
    "th": ({"td", "th"}, _TABLE),
    "tr": ({"td", "th", "tr", "caption", "colgroup"}, _TABLE),
    "thead": ({"td", "th", "tr", "caption", "colgroup"}, _TABLE),
    "tbody": ({"td", "th", "tr", "thead", "tbody", "caption", "colgroup"}, _TABLE),
    "tfoot": ({"td", "th", "tr", "thead", "tbody"}, _TABLE),
    "body": ({"head"}, set()),
    "option": ({"option"}, {"select", "datalist", "optgroup"}),
    "optgroup": ({"option", "optgroup"}, {"select", "datalist"}),
    "select": ({"select"}, set()),
    "textarea": ({"select"}, set()),
    "input": ({"select"}, set()),
}
_SCOPE = {"table", "td", "th", "caption", "html", "body"}
_HIDING = re.compile(r"display\s*:\s*none", re.I)
_VISIBILITY = re.compile(r"visibility\s*:\s*(visible|hidden|collapse)", re.I)
# Limits of the layout: a cell that is wider takes no part in the width of its column, a table whose
# blanks would be so many times its text is not aligned, and spans are clamped as browsers do.
WIDEST, MOST_BLANKS, MOST_COLUMNS, MOST_ROWS = 120, 8, 1000, 65_534
_SPACE = re.compile(r"[ \t\n\f\r]+")
_VERBATIM = ("pre", "textarea", "plaintext", "xmp")


class Node:
    __slots__ = ("tag", "attrs", "children")

    def __init__(self, tag: str, attrs: dict[str, str]):
        self.tag, self.attrs, self.children = tag, attrs, []


class TreeBuilder(HTMLParser):
    """Builds a tree from any markup: missing end tags are implied, stray ones ignored."""

    CDATA_CONTENT_ELEMENTS = ("script", "style", "plaintext", "xmp")

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Node("html", {})
        self.open = [self.root]
        self.depth = Counter()  # open elements by tag

    def _close_from(self, k: int) -> None:
        self.depth.subtract(node.tag for node in self.open[k:])
        del self.open[k:]

    def _end_up_to(self, ended: set[str], until: set[str]) -> None:
        if not any(self.depth[tag] for tag in ended):
            return
        for k in range(len(self.open) - 1, 0, -1):
            tag = self.open[k].tag
            if tag in until:
                return
            if tag in ended:
                self._close_from(k)
                self._end_up_to(ended, until)
                return

    def _end_head(self) -> None:
        if self.open[-1].tag == "head":
            self._close_from(len(self.open) - 1)

    def close(self):
        super().close()
        if self.cdata_elem in ("plaintext", "xmp"):
            self.handle_data(self.rawdata)  # shown to the end of the page

    def parse_marked_section(self, i, report=1):
        """``<![...`` is a comment up to the next ``>``, and text in a drawing or formula if CDATA."""
        if self.rawdata.startswith("<![CDATA[", i) and (self.depth["svg"] or self.depth["math"]):
            end = self.rawdata.find("]]>", i)
            if end >= 0:
                self.handle_data(self.rawdata[i + 9 : end])
                return end + 3
        return self.parse_bogus_comment(i)

    def handle_starttag(self, tag, attrs):
        if tag == "html":
            self.root.attrs |= {k: v or "" for k, v in attrs}
            return
        if self.open[-1].tag == "title" and not self.depth["svg"]:
            self._close_from(len(self.open) - 1)  # a title that was never ended
        if tag not in IN_HEAD:
            self._end_head()
        if tag in BLOCKS:
            self._end_up_to({"p"}, _SCOPE)
        if tag in ENDS:
            self._end_up_to(*ENDS[tag])
        node = Node(tag, {k: v or "" for k, v in attrs})
        self.open[-1].children.append(node)
        if tag not in VOID:
            self.open.append(node)
            self.depth[tag] += 1

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        foreign = (self.depth["svg"] or self.depth["math"]) and not self.depth["foreignobject"]
        if foreign and tag not in VOID and self.open[-1].tag == tag:
            self._close_from(len(self.open) - 1)

    def handle_endtag(self, tag):
        if tag == "br":
            self.handle_starttag("br", [])
        if not self.depth[tag]:
            return
        fence = _TABLE if tag not in ("table", "html", "body") else set()
        for k in range(len(self.open) - 1, 0, -1):
            if self.open[k].tag == tag:
                self._close_from(k)
                return
            if self.open[k].tag in fence:
                return

    def handle_data(self, data):
        if _SPACE.sub("", data):
            self._end_head()
        self.open[-1].children.append(data)


def hidden(node: Node) -> bool:
    """Whether an element is not displayed, with all that it holds."""
    return (
        node.tag in UNSEEN
        or "hidden" in node.attrs
        or (node.tag == "dialog" and "open" not in node.attrs)
        or (node.tag == "input" and node.attrs.get("type", "").lower() == "hidden")
        or bool(_HIDING.search(node.attrs.get("style", "")))
    )


def visibility(node: Node, inherited: bool) -> bool:
    """Unlike display, visibility is inherited and can be switched on again inside."""
    said = _VISIBILITY.findall(node.attrs.get("style", ""))
    return said[-1].lower() == "visible" if said else inherited


def shown_children(node: Node) -> list:
    """Of closed details only the first summary is shown."""
    if node.tag != "details" or "open" in node.attrs:
        return node.children
    return [c for c in node.children if not isinstance(c, str) and c.tag == "summary"][:1]


class Flow:
    """Lines of one block context: the page or a table cell."""

    def __init__(self):
        self.lines: list[str] = []
        self.line = ""
        self.space = False
        self.gap = False

    def text(self, data: str) -> None:
        collapsed = _SPACE.sub(" ", data)
        if collapsed.startswith(" "):
            self.space = True
        body = collapsed.strip(" ")
        if body:
            self.line += " " + body if self.space and self.line and not self.line.endswith(" ") else body
            self.space = collapsed.endswith(" ")

    def verbatim(self, data: str) -> None:
        first, *rest = data.split("\n")
        self.line += first
        for line in rest:
            self.flush(keep_empty=True)
            self.line = line

    def flush(self, keep_empty: bool = False) -> None:
        if self.line.strip() or keep_empty:
            if self.gap and self.lines:
                self.lines.append("")
            self.gap = False
            self.lines.append(self.line.rstrip())
        self.line, self.space = "", False

    def line_break(self) -> None:
        """Ends the line; an empty one stays as a blank line."""
        if self.line.strip() or not self.lines:
            self.flush()
        elif not self.gap:
            self.flush(keep_empty=True)

    def block(self, spaced: bool) -> None:
        self.flush()
        self.gap |= spaced

    def done(self) -> list[str]:
        self.flush()
        while self.lines and not self.lines[-1]:
            self.lines.pop()
        return self.lines


class Table:
    """Rows of cells, each with its column. ``taken``: columns that cells of rows above hold, as
    first column, end and the number of the last row."""

    def __init__(self):
        self.rows: list[list[tuple[int, list[str]]]] = []
        self.taken: list[tuple[int, int, int]] = []
        self.next = 0

    def row(self) -> None:
        self.rows.append([])
        self.next = 0
        self.taken = [t for t in self.taken if t[2] >= len(self.rows) - 1]

    def cell(self, lines: list[str], columns: int, rows: int) -> None:
        if not self.rows:
            self.row()
        at = len(self.rows) - 1
        for first, end, last in self.taken:
            if first <= self.next < end and last >= at:
                self.next = end
        self.rows[-1].append((self.next, lines))
        if rows > 1 and self.next < MOST_COLUMNS:
            insort(self.taken, (self.next, self.next + columns, at + rows - 1))
        self.next += columns

    def lines(self) -> list[str]:
        """Columns as wide as their widest line and two blanks apart; tall cells take more lines."""
        rows = [r for r in self.rows if any(any(c) for _, c in r)]
        widths: dict[int, int] = {}
        for row in rows:
            for column, cell in row:
                width = max((len(line) for line in cell if len(line) <= WIDEST), default=0)
                widths[column] = max(width, widths.get(column, 0))
        starts, at = {}, 0
        for column in sorted(widths):
            starts[column] = at
            at += widths[column] + 2 if widths[column] else 0
        text = sum(len(line) + 2 for row in rows for _, cell in row for line in cell)
        room = sum(starts[row[-1][0]] * max(len(c) for _, c in row) for row in rows)
        aligned, out = room <= MOST_BLANKS * text, []
        for row in rows:
            for y in range(max(len(c) for _, c in row)):
                line = ""
                for column, cell in row:
                    if y < len(cell) and cell[y]:
                        line = line.ljust(starts[column]) if aligned else line
                        # Where a wide cell reaches into the column, two blanks divide them.
                        gap = "" if not line or line.endswith("  ") else "  "
                        line += gap + cell[y]
                out.append(line.rstrip())
        return out


def _span(node: Node, name: str, most: int, zero: int) -> int:
    """A span as browsers read it: digits at the beginning, 1 if there are none, clamped."""
    digits = re.match(r"[ \t\n\f\r]*\+?([0-9]+)", node.attrs.get(name, ""))
    if not digits:
        return 1
    value = digits[1].lstrip("0")
    return min(int(value[:6]), most) if value else zero


def _content(root: Node) -> str:
    found, todo = [], [root]
    while todo:
        node = todo.pop()
        if isinstance(node, str):
            found.append(node)
        elif not hidden(node):
            todo += reversed(node.children)
    return "".join(found).strip()


def _options(select: Node) -> tuple[list[Node], bool]:
    """The options that a browser shows, and whether they are a list: of a closed select, the last
    that is selected, or else the first that can be."""
    found, todo = [], [select]
    while todo:
        node = todo.pop()
        if isinstance(node, str) or (node is not select and hidden(node)):
            continue
        if node.tag == "option":
            found.append(node)
        else:
            todo += reversed(node.children)
    size = select.attrs.get("size", "")
    if "multiple" in select.attrs or (size.isdecimal() and size.lstrip("0") not in ("", "1")):
        return found, True
    chosen = [o for o in found if "selected" in o.attrs][-1:]
    return chosen or [o for o in found if "disabled" not in o.attrs][:1] or found[:1], False


def render(root: Node) -> str:
    """The visible text of a tree. Walks with a list of its own, so no depth of nesting is too much."""
    flows, tables, lists, pre, drawn, seen = [Flow()], [], [], 0, 0, [True]
    todo: list[tuple[str, object]] = [("in", root)]
    while todo:
        step, node = todo.pop()
        flow = flows[-1]
        if isinstance(node, str):
            if seen[-1]:
                flow.verbatim(node) if pre else flow.text(node)
            continue
        tag = node.tag
        if step == "in":
            if hidden(node) or (drawn and tag in UNDRAWN):
                continue
            if tag == "select":
                options, listed = _options(node)
                for option in options if visibility(node, seen[-1]) else ():
                    flow.block(False) if listed else flow.text(" ")
                    flow.text(option.attrs.get("label") or _content(option))
                flow.block(False) if listed else flow.text(" ")
                continue
            if tag == "br":
                flow.line_break()
            elif tag == "hr":
                flow.block(True)
            elif tag == "table":
                flow.block(True)
                tables.append(Table())
            elif tag == "tr" and tables:
                tables[-1].row()
            elif tag in ("td", "th") and tables:
                flows.append(Flow())
            elif tag in ("ul", "ol", "menu"):
                flow.block(not lists)
                start = node.attrs.get("start", "")
                lists.append(int(start) if tag == "ol" and start.isdecimal() and len(start) < 9 else 1 if tag == "ol" else None)
            elif tag == "li":
                flow.block(False)
                depth = max(len(lists) - 1, 0)
                number = lists[-1] if lists else None
                if visibility(node, seen[-1]):
                    flow.line = "  " * depth + ("- " if number is None else f"{number}. ")
                if number is not None:
                    lists[-1] += 1
            elif tag in BLOCKS:
                flow.block(tag in SPACED)
            elif tag == "textarea" or (drawn and tag == "text"):
                flow.block(False)
            pre += tag in _VERBATIM
            drawn += tag == "svg"
            seen.append(visibility(node, seen[-1]))
            todo.append(("out", node))
            todo += [("in", child) for child in reversed(shown_children(node))]
            continue
        seen.pop()
        pre -= tag in _VERBATIM
        drawn -= tag == "svg"
        if tag in ("td", "th") and tables and len(flows) > 1:
            columns = _span(node, "colspan", MOST_COLUMNS, 1)
            rows = _span(node, "rowspan", MOST_ROWS, MOST_ROWS)
            tables[-1].cell(flows.pop().done() or [""], columns, rows)
        elif tag == "table" and tables:
            for line in tables.pop().lines():
                flow.line = line
                flow.flush(keep_empty=True)
            flow.block(True)
        elif tag in ("ul", "ol", "menu") and lists:
            lists.pop()
            flow.block(not lists)
        elif tag in BLOCKS:
            flow.block(tag in SPACED)
        elif tag == "textarea" or (drawn and tag == "text"):
            flow.block(False)
    return "\n".join(flows[0].done())


def visible_text(html: str | None) -> str:
    """All visible text of a page, whole: blocks on lines of their own, blank lines around paragraphs
    and headings, list marks, tables in aligned columns. Formulas, the text of drawings and of text
    areas, and the options that a select shows are part of it. Null and empty pages give an empty text;
    markup of any kind, broken or deeply nested, gives some text and never an error. Very long pages
    cost time and memory in proportion to their length: a table is aligned only if that takes at most
    ``MOST_BLANKS`` times its text."""
    builder = TreeBuilder()
    builder.feed(html or "")
    builder.close()
    return render(builder.root)


def extract(pages: DataFrame, html: str = "html") -> DataFrame:
    """``pages`` with a text column ``visible`` (a longer name if there is one), in one pass. Repeated
    rows and null ids are rendered like others; an empty table gives an empty result."""
    small_batches(pages.sparkSession)

    @F.pandas_udf("string")
    def texts(found: pd.Series) -> pd.Series:
        return pd.Series([visible_text(h) for h in found], dtype=object)

    return pages.withColumn(fresh(pages, "visible"), texts(F.col(html)))
