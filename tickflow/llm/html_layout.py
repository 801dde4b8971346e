"""Visible text of HTML by layout: a tree builder with implied tags, visibility rules, blocks, lists and aligned tables.

Every step takes time in proportion to the page, whatever is in it: the tokenizer never looks twice at a character, the
tree builder finds open elements by tag, and nested tables are laid out from the innermost on, without recursion.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickflow.llm.common import named

VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
HIDDEN = frozenset("head script style template noscript title textarea select object iframe svg".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details div dl dt fieldset figcaption figure footer form h1 h2 h3 "
    "h4 h5 h6 header hr html li main nav ol p pre section table ul".split()
)
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl table blockquote pre figure".split())
#: An opening tag closes these open ones, up to the nearest ancestor named last.
CLOSES = {
    "li": ({"li"}, {"ul", "ol"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "thead": ({"thead", "tbody", "tfoot"}, {"table"}),
    "tbody": ({"thead", "tbody", "tfoot"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tfoot"}, {"table"}),
}
#: Elements whose content is text up to their own end tag.
RAW = frozenset("script style textarea title iframe noscript xmp noembed noframes".split())
UNSEEN = re.compile(r"display\s*:\s*none", re.I)
VISIBILITY = re.compile(r"visibility\s*:\s*(\w+)", re.I)
WHITE = re.compile(r"[ \t\n\f\r]+")
GAP, NAME, EQUALS, BARE = (re.compile(p) for p in (r"[\s/]*", r"=?[^\s/>=]*", r"\s*=\s*", r"[^\s>]*"))
TAG = re.compile(r"[a-zA-Z][^\s/>]*")
#: Longer cells do not widen their column; deeper lists are not moved further in; cells span so many rows or columns.
WIDEST, DEEPEST, LONGEST_SPAN = 80, 20, 100


class Node:
    __slots__ = ("tag", "attributes", "children", "visible", "lines")

    def __init__(self, tag: str, attributes: dict, visible: bool = True):
        self.tag, self.attributes, self.children, self.visible, self.lines = tag, attributes, [], visible, []


def _attributes(html: str, at: int) -> tuple[dict, int] | None:
    """Attributes from ``at`` on and where the tag ends; none if the page ends first."""
    found: dict[str, str] = {}
    while True:
        at = GAP.match(html, at).end()
        if at >= len(html):
            return None
        if html[at] == ">":
            return found, at + 1
        name = NAME.match(html, at)
        at, value = name.end(), ""
        if equals := EQUALS.match(html, at):
            at = equals.end()
            quote = html[at : at + 1]
            if quote and quote in "\"'":
                end = html.find(quote, at + 1)
                if end < 0:
                    return None
                value, at = html[at + 1 : end], end + 1
            else:
                value = BARE.match(html, at).group()
                at += len(value)
        found.setdefault(name.group().lower(), unescape(value))


def events(html: str) -> Iterator[tuple[str, str, dict]]:
    """("text", text, {}), ("open", tag, attributes) and ("close", tag, {}) of a page, to its end."""
    at, size = 0, len(html)
    while at < size:
        less = html.find("<", at)
        if less < 0:
            yield "text", unescape(html[at:]), {}
            return
        after = html[less + 1 : less + 2]
        closes = after == "/"
        tag = TAG.match(html, less + 1 + closes)
        if not tag and after not in ("!", "?") and not closes:  # a sign like others
            yield "text", unescape(html[at : less + 1]), {}
            at = less + 1
            continue
        if less > at:
            yield "text", unescape(html[at:less]), {}
        if not tag:
            comment = html.startswith("<!--", less)
            if comment and html[less + 4 : less + 6].startswith((">", "->")):
                at = html.index(">", less + 4) + 1
                continue
            end = html.find("-->" if comment else ">", less + 2 + 2 * comment)
            if end < 0:
                return
            at = end + (3 if comment else 1)
            continue
        if (parsed := _attributes(html, tag.end())) is None:
            return
        attributes, at = parsed
        name = tag.group().lower()
        yield ("close", name, {}) if closes else ("open", name, attributes)
        if not closes and name in RAW:
            end = re.compile(f"</{re.escape(name)}(?=[\\s/>])", re.I).search(html, at)
            yield "text", html[at : end.start() if end else size], {}
            at = end.start() if end else size


class Tree:
    """Open elements from the root on; ``at`` tells for each tag how deep its open elements lie."""

    def __init__(self, html: str):
        self.root = Node("#root", {})
        self.open = [self.root]
        self.at: dict[str, list[int]] = defaultdict(list)
        self.tables: list[Node] = []
        for kind, value, attributes in events(html):
            if kind == "text":
                self.open[-1].children.append(value)
            elif kind == "open":
                self._start(value, attributes)
            else:
                self._end(value)

    def _deepest(self, tags: set) -> int:
        return max((self.at[tag][-1] for tag in tags if self.at[tag]), default=0)

    def _cut(self, depth: int) -> None:
        for node in self.open[depth:]:
            self.at[node.tag].pop()
        del self.open[depth:]

    def _close_to(self, tags: set, barriers: set) -> None:
        """Close the open ones of the tags (of a paragraph: one) above the deepest barrier."""
        barrier = self._deepest(barriers)
        while (depth := self._deepest(tags)) > barrier:
            self._cut(depth)
            if tags == {"p"}:
                return

    def _start(self, tag: str, attributes: dict) -> None:
        if tag in CLOSES:
            self._close_to(*CLOSES[tag])
        if tag in BLOCK and tag not in ("html", "body"):
            self._close_to({"p"}, {"td", "th", "table", "button"})
            self._close_to({"head"}, set())
        elif tag == "body":
            self._close_to({"head"}, set())
        said = VISIBILITY.search(attributes.get("style", ""))
        visible = said.group(1).lower() not in ("hidden", "collapse") if said else self.open[-1].visible
        node = Node(tag, attributes, visible)
        self.open[-1].children.append(node)
        if tag == "table":
            self.tables.append(node)
        if tag not in VOID:
            self.at[tag].append(len(self.open))
            self.open.append(node)

    def _end(self, tag: str) -> None:
        barriers = {"td", "th", "table"} - {tag} if tag not in ("table", "tr", "tbody", "thead", "tfoot") else set()
        depth = self._deepest({tag})
        if depth > self._deepest(barriers):
            self._cut(depth)


def _hidden(node: Node) -> bool:
    return node.tag in HIDDEN or "hidden" in node.attributes or bool(UNSEEN.search(node.attributes.get("style", "")))


def _number(text: str | None, otherwise: int) -> int:
    found = re.match(r"\s*(-?\d{1,9})", text or "")
    return int(found.group(1)) if found else otherwise


class Page:
    """Lines of text; blank lines between spaced blocks are single."""

    def __init__(self):
        self.lines, self.parts, self.gap = [], [], False

    def add(self, text: str, keep: bool = False) -> None:
        if keep:
            first, *others = text.split("\n")
            self.parts.append(first)
            for line in others:
                self.line()
                self.parts.append(line)
            return
        text = WHITE.sub(" ", text)
        if not self.parts or self.parts[-1].endswith(" "):
            text = text.lstrip(" ")
        if text:
            self.parts.append(text)

    def line(self) -> None:
        """End the line, be it empty."""
        if self.gap and self.lines:
            self.lines.append("")
        self.gap = False
        self.lines.append("".join(self.parts).rstrip(" "))
        self.parts = []

    def end(self) -> None:
        """End the line if there is anything in it."""
        if any(part.strip() for part in self.parts):
            self.line()
        self.parts = []


def _rows(table: Node) -> Iterator[Node]:
    for child in table.children:
        if isinstance(child, Node) and not _hidden(child):
            if child.tag == "tr":
                yield child
            elif child.tag in ("thead", "tbody", "tfoot"):
                yield from (row for row in child.children if isinstance(row, Node) and row.tag == "tr" and not _hidden(row))


def _placed(table: Node) -> list[list[tuple[int, int, list[str]]]]:
    """Per row the cells with their first column and the one after the last, beside those that reach down from above."""
    rows, taken = [], {}  # taken: the row from which on a column is free again
    for n, row in enumerate(_rows(table)):
        cells, column = [], 0
        for cell in row.children:
            if not isinstance(cell, Node) or _hidden(cell):
                continue
            while taken.get(column, 0) > n:
                column += 1
            across = min(max(1, _number(cell.attributes.get("colspan"), 1)), LONGEST_SPAN)
            down = min(max(1, _number(cell.attributes.get("rowspan"), 1)), LONGEST_SPAN)
            cells.append((column, column + across, [line for line in _render(cell.children, cell.visible) if line]))
            if down > 1:
                taken |= dict.fromkeys(range(column, column + across), n + down)
            column += across
        rows.append(cells)
    return rows


def _table(node: Node) -> list[str]:
    """Cells of a column start at the same place, those of several lines side by side; what stands in a table outside
    cells comes first."""
    loose = [c for c in node.children if not (isinstance(c, Node) and c.tag in ("tr", "thead", "tbody", "tfoot"))]
    lines, rows = _render(loose, node.visible), _placed(node)
    widths = {start: 0 for cells in rows for start, _, _ in cells}  # only columns in which a cell starts have a width
    for cells in rows:
        for start, stop, text in cells:
            if stop == start + 1:
                widths[start] = max([widths[start], *(len(line) for line in text if len(line) <= WIDEST)])
    places, at = {}, 0
    for column in sorted(widths):
        places[column] = at
        at += widths[column] + 2 if widths[column] else 0
    for cells in rows:
        for n in range(max((len(text) for _, _, text in cells), default=0)):
            parts, size = [], 0
            for start, _, text in cells:
                if n < len(text) and text[n]:
                    before = " " * max(places[start] - size, 2 if size else 0)
                    parts += [before, text[n]]
                    size += len(before) + len(text[n])
            if size:
                lines.append("".join(parts).rstrip())
    return lines


def _render(children: list, visible: bool = True) -> list[str]:
    """Lines of what is visible, of children of a visible element or not; tables inside are laid out already."""
    page, lists, pre, mark = Page(), [], 0, ""

    def entering(nodes: list, visible: bool) -> list[tuple[str, Node | str]]:
        return [("open", child) for child in reversed(nodes) if visible or isinstance(child, Node)]

    work = entering(children, visible)
    while work:
        step, node = work.pop()
        if isinstance(node, str):
            page.add(node, pre > 0)
            continue
        tag = node.tag
        if step == "open":
            if _hidden(node):
                continue
            if tag == "br":
                page.line()
                continue
            if tag == "img":
                page.add(node.attributes.get("alt", "") if node.visible else "")
                continue
            if tag in BLOCK:
                if tag == "li" or page.parts != [mark]:  # a block that begins an item stands beside its mark
                    page.end()
                page.gap |= tag in SPACED and not (tag in ("ul", "ol") and lists)
            if tag in ("ul", "ol"):
                lists.append([tag, _number(node.attributes.get("start"), 1) - 1])
            elif tag == "li":
                if lists:
                    lists[-1][1] = _number(node.attributes.get("value"), lists[-1][1] + 1)
                mark = f"{lists[-1][1]}. " if lists and lists[-1][0] == "ol" else "- "
                mark = "  " * min(DEEPEST, max(0, len(lists) - 1)) + mark
                page.parts = [mark]
            elif tag == "pre":
                pre += 1
                if node.children and isinstance(node.children[0], str):
                    node.children[0] = node.children[0].removeprefix("\n")
            elif tag == "table":
                for line in node.lines:
                    page.parts = [line]
                    page.end()
                page.gap = True
                continue
            work.append(("close", node))
            work.extend(entering(node.children, node.visible))
        else:
            if tag in BLOCK:
                page.end()
                page.gap |= tag in SPACED and not (tag in ("ul", "ol") and len(lists) > 1)
            if tag in ("ul", "ol"):
                lists.pop()
            elif tag == "pre":
                pre -= 1
    page.end()
    return page.lines


def visible_text(html: str) -> str:
    tree = Tree(html)
    for table in reversed(tree.tables):  # those inside come after the one around them
        table.lines = _table(table)
    return "\n".join(_render(tree.root.children))


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [visible_text(html.as_py() or "") for html in batch.column("html")]
        yield pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("html"), pa.array(found, pa.string())], ["page_id", "html", "text"]
        )


def rendered(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """page_id, html and text: all visible text of each page, whole.

    NULL and empty pages give an empty text. Repeated rows and NULL ids come out as they come in; other columns are left
    behind. An empty table gives no rows.
    """
    rows = pages.select(named(id_col).alias("page_id"), F.coalesce(named(html_col), F.lit("")).alias("html"))
    kind = rows.schema["page_id"].dataType.simpleString()
    return rows.mapInArrow(_texts, f"page_id {kind}, html string, text string")
