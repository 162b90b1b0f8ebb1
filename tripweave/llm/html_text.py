"""Visible text of HTML pages, laid out as a reader sees it.

A tree builder closes what markup leaves open (paragraphs, list items, cells and rows), and
visibility rules drop what is not shown. The layout keeps blocks apart, marks and indents list
items, keeps preformatted text, and sets the cells of a table in columns. Tree and layout use
explicit stacks, so nesting of any depth is safe.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterable
from html.parser import HTMLParser
from itertools import zip_longest

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripweave.llm.common import bounded

# Fixed values of the HTML standard.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
UNSEEN = set("head script style template noscript title meta link datalist object iframe audio video canvas mphantom annotation annotation-xml".split())
#: Of svg, what is drawn only where something refers to it, or never; text is drawn in text elements alone.
UNDRAWN = set("defs symbol clippath mask marker pattern desc metadata".split())
DRAWN = {"text", "foreignobject"}
#: Elements of formulas whose parts stand above, below or beside each other.
APART = set("mfrac msup msub msubsup munder mover munderover mroot mtable mtr mlabeledtr".split())
BLOCKS = set(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre search section summary table ul caption tr".split()
)
SPACED = set("blockquote dl fieldset figure h1 h2 h3 h4 h5 h6 menu ol p pre table ul hr".split())
CLOSES_P = BLOCKS - {"option", "html", "body", "legend", "caption", "tr"}
#: What an opening tag closes, up to the element that limits the search.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select", "datalist", "optgroup"}),
    "optgroup": ({"option", "optgroup"}, {"select"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tr": ({"tr", "td", "th", "caption"}, {"table"}),
    "thead": ({"tr", "td", "th", "thead", "tbody", "tfoot", "caption"}, {"table"}),
    "tbody": ({"tr", "td", "th", "thead", "tbody", "tfoot", "caption"}, {"table"}),
    "tfoot": ({"tr", "td", "th", "thead", "tbody", "tfoot", "caption"}, {"table"}),
    "body": ({"head"}, {"html"}),
}
SCOPES = {"table", "td", "th", "caption", "html", "template", "object"}

WIDEST = 80  # columns of a table are aligned up to so many characters
_BLANK = re.compile(r"[ \t\n\r\f]+")
_SAID = re.compile(r"(?:^|;)\s*(display|visibility)\s*:\s*([\w -]+?)\s*(!\s*important)?\s*(?=;|$)", re.I)
_SELECTOR = re.compile(r"(\*|[a-z][a-z0-9-]*)?((?:[.#][\w-]+)*)", re.I)
_SCREEN = re.compile(r"((only\s+)?(all|screen)|not\s+(print|speech))?", re.I)


class Node:
    __slots__ = ("tag", "attrs", "children")

    def __init__(self, tag: str, attrs: dict[str, str | None]) -> None:
        self.tag, self.attrs = tag, attrs
        self.children: list[Node | str] = []


class TreeBuilder(HTMLParser):
    """The element tree of a page, and the rules of its style sheets on what is shown, by selectors without combinators.

    The places of the open elements are kept by tag, so a search among them looks at the tags sought and not at all that
    is open: the time is in proportion to the page, however deep it is.
    """

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = Node("html", {})
        self._open = [self.root]
        self._places: dict[str, list[int]] = {}  # of the open elements of each tag, outermost first
        self.rules: dict[str, list[tuple]] = {}  # by one name of the selector: (tag, names, rank, what is said)
        self._read = 0

    def _innermost(self, tags: Iterable[str]) -> int:
        """The place of the nearest open element of ``tags``, 0 if there is none."""
        return max((self._places[t][-1] for t in tags if self._places.get(t)), default=0)

    def _cut(self, place: int) -> None:
        """Close the open elements from a place on."""
        for node in self._open[place:]:
            self._places[node.tag].pop()
        del self._open[place:]

    def _close(self, tags: set[str], limits: set[str]) -> None:
        """Close the outermost open element of ``tags`` inside the nearest of ``limits``."""
        limit = self._innermost(limits)
        inside = [places[bisect_right(places, limit)] for t in tags if (places := self._places.get(t)) and places[-1] > limit]
        if inside:
            self._cut(min(inside))

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag == "html":
            return
        if tag in CLOSES_P:
            self._close({"p"}, SCOPES)
        if tag in CLOSES:
            self._close(*CLOSES[tag])
        if tag == "tr" and self._open[-1].tag not in ("table", "thead", "tbody", "tfoot"):
            self._close({"td", "th"}, {"table"})
        if tag in ("td", "th") and self._open[-1].tag in ("table", "thead", "tbody", "tfoot"):
            self._push("tr", {})
        if tag not in UNSEEN and self._open[-1].tag == "head":
            self._cut(len(self._open) - 1)
        self._push(tag, dict(attrs))
        if tag in VOID:
            self._cut(len(self._open) - 1)

    def parse_marked_section(self, i: int, report: int = 1) -> int:
        return self.parse_bogus_comment(i)  # a page may hold sections that are not HTML

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)  # the slash means nothing in HTML, but closes in drawings and formulas
        here = len(self._open) - 1
        if self._open[here].tag == tag and any(p and p[0] < here for p in map(self._places.get, ("svg", "math"))):
            self._cut(here)

    def _push(self, tag: str, attrs: dict[str, str | None]) -> None:
        node = Node(tag, attrs)
        self._open[-1].children.append(node)
        self._places.setdefault(tag, []).append(len(self._open))
        self._open.append(node)

    def handle_endtag(self, tag: str) -> None:
        if tag == "br":
            self._open[-1].children.append(Node("br", {}))
            return
        limits = set() if tag in SCOPES or tag in ("tr", "thead", "tbody", "tfoot") else SCOPES
        place = self._innermost([tag])
        if place and place >= self._innermost(limits):
            self._cut(place)
        elif tag == "p":
            self._open[-1].children.append(Node("p", {}))

    def handle_data(self, data: str) -> None:
        here = self._open[-1]
        if here.tag == "style":
            if _on_screen(here.attrs.get("media") or ""):
                self._read_rules(re.sub(r"/\*.*?\*/", "", data, flags=re.S))
        elif here.tag == "head" and data.strip():
            self._cut(len(self._open) - 1)
            self._open[-1].children.append(data)
        else:
            here.children.append(data)

    def _read_rules(self, sheet: str) -> None:
        for head, body in _blocks(sheet):
            if said := _said(body):
                for selector in head.split(","):
                    self._add_rule(selector.strip(), said)

    def _add_rule(self, selector: str, said: list[tuple[str, str, bool]]) -> None:
        plain = _SELECTOR.fullmatch(selector)
        if not selector or not plain:
            return
        tag = "" if plain[1] in (None, "*") else plain[1].lower()
        names = re.findall(r"[.#][\w-]+", plain[2])
        ids = sum(name[0] == "#" for name in names)
        self._read += 1
        rank = (ids, len(names) - ids, bool(tag), self._read)
        self.rules.setdefault(names[0] if names else tag, []).append((tag, set(names), rank, said))


def _on_screen(media: str) -> bool:
    """Whether a list of media queries holds on any screen."""
    return any(_SCREEN.fullmatch(query.strip()) for query in media.split(","))


def _holds(head: str) -> bool:
    """Whether the rules in a block that begins with @ hold."""
    name, condition = re.fullmatch(r"(@[\w-]*)(.*)", head, re.S).groups()
    name, condition = name.lower(), condition.strip()
    return name == "@layer" or name == "@media" and _on_screen(condition) or name == "@supports" and not condition.lower().startswith("not")


def _blocks(sheet: str) -> list[tuple[str, str]]:
    """The rules of a style sheet that hold: selectors and declarations."""
    out = []
    todo: list[tuple[str, bool, list[str]]] = []  # of the open blocks: selectors, or empty; whether it holds; declarations
    start = 0
    for mark in re.finditer(r"[{};]", sheet + "}" * (1 + sheet.count("{"))):  # the end of a sheet closes its blocks
        piece, start = sheet[start : mark.start()], mark.end()
        if mark[0] == "{":
            head = piece.strip()
            group = head.startswith("@")
            holds = not todo or not todo[-1][0] and todo[-1][1]
            todo.append(("" if group else head, holds and (not group or _holds(head)), []))
        elif todo:
            todo[-1][2].append(piece)
            if mark[0] == "}":
                head, holds, parts = todo.pop()
                if head and holds:
                    out.append((head, ";".join(parts)))
    return out


def _said(declarations: str) -> list[tuple[str, str, bool]]:
    return [(name.lower(), value.lower(), bool(strong)) for name, value, strong in _SAID.findall(declarations)]


def shown(node: Node, rules: dict[str, list[tuple]], visible: bool) -> bool | None:
    """Whether the text in an element is visible where its parent's is or is not; None if the element and all in it are not shown.

    As in a browser, what is important holds first, then the style of the element, then the more special rule, then the last.
    """
    if node.tag in UNSEEN:
        return None
    best: dict[str, tuple] = {}
    if "hidden" in node.attrs or node.tag == "dialog" and "open" not in node.attrs:
        best["display"] = ((), "none")
    names = {"." + c for c in (node.attrs.get("class") or "").split()} | {"#" + (node.attrs.get("id") or "")} if rules else set()
    found = [rule for key in (*names, node.tag, "") for rule in rules.get(key, ())] if rules else []
    found = [(rank, said) for tag, wanted, rank, said in found if tag in ("", node.tag) and wanted <= names]
    if "style" in node.attrs:
        found.append(((1 << 30,), _said(node.attrs["style"] or "")))
    for rank, said in found:
        for k, (name, value, strong) in enumerate(said):
            best[name] = max(best.get(name, ((), "")), ((strong, *rank, k), value))
    if best.get("display", ((), ""))[1] == "none":
        return None
    said_visible = best.get("visibility", ((), ""))[1]
    return {"hidden": False, "collapse": False, "visible": True, "initial": True}.get(said_visible, visible)


class Page:
    """Lines under construction: words wait for a space, blocks for line ends."""

    def __init__(self) -> None:
        self.lines: list[str] = []
        self._line: list[str] = []
        self._space = False
        self._gap = 0  # line ends wanted before the next text: 1 for a new line, 2 for an empty one between
        self.indent = ""
        self.mark = ""  # of a list item, before its first line

    def text(self, data: str, kept: bool) -> None:
        if kept:
            first, *rest = data.replace("\r\n", "\n").split("\n")
            self._word(first, True)
            for line in rest:
                self._end_line(True)
                self._word(line, True)
            return
        parts = _BLANK.split(data)
        for k, part in enumerate(parts):
            self._space |= k > 0
            self._word(part, False)

    def _word(self, word: str, kept: bool) -> None:
        if not word:
            return
        if self._gap:
            self._break()
        if not self._line:
            self._line.append(self.indent[: len(self.indent) - len(self.mark)] + self.mark)
            self.mark = ""
        elif self._space and not kept:
            self._line.append(" ")
        self._line.append(word)
        self._space = False

    def _break(self) -> None:
        if self._line:
            self._end_line(False)
        if self._gap > 1 and self.lines and self.lines[-1]:
            self.lines.append("")
        self._gap = 0

    def _end_line(self, empty: bool) -> None:
        if self._line or empty:
            self.lines.append("".join(self._line).rstrip())
        self._line, self._space = [], False

    def block(self, gap: int) -> None:
        self._gap = max(self._gap, gap)

    def new_line(self) -> None:
        if self._gap:
            self._break()
        self._end_line(True)

    def put_lines(self, lines: list[str]) -> None:
        self._break()
        for line in lines:
            if self._line:
                self._end_line(False)
            self._word(line, True) if line else self._end_line(True)
        self._end_line(False)

    def done(self) -> list[str]:
        if self._line:
            self._end_line(False)
        lines = self.lines
        while lines and not lines[-1]:
            lines.pop()
        start = 0
        while start < len(lines) and not lines[start]:
            start += 1
        return lines[start:]


def table_lines(rows: list[list[tuple[list[str], int]]]) -> list[str]:
    """Cells (lines, columns they span) set in columns, two blanks apart."""
    widths: dict[int, int] = {}
    for row in rows:
        column = 0
        for lines, span in row:
            if span == 1:
                widths[column] = max([widths.get(column, 0), *(len(x) for x in lines if len(x) <= WIDEST)])
            column += span
    out = []
    for row in rows:
        for parts in zip_longest(*(lines for lines, _ in row), fillvalue=""):
            line, column = [], 0
            for part, (_, span) in zip(parts, row):
                line.append(part.ljust(sum(widths.get(c, 0) for c in range(column, column + span)) + 2 * (span - 1)))
                column += span
            out.append("  ".join(line).rstrip())
    return out


def visible_text(html: str) -> str:
    builder = TreeBuilder()
    builder.feed(html)
    builder.close()
    page, pages = Page(), []
    tables: list[list[list[tuple[list[str], int]]]] = []
    lists: list[list] = []  # (kind, number) of the open lists
    kept = 0
    drawn: list[bool] = []  # of the open svg, text and foreignobject elements: whether text is drawn there
    todo: list[tuple[Node | str, bool, bool]] = [(builder.root, False, True)]  # what, whether it is left, whether text shows
    while todo:
        node, leave, visible = todo.pop()
        if isinstance(node, str):
            if visible and (not drawn or drawn[-1]):
                page.text(node, kept > 0)
            continue
        tag = node.tag
        if not leave:
            inner = shown(node, builder.rules, visible)
            if inner is None or drawn and tag in UNDRAWN:
                continue
            todo.append((node, True, visible))
            for child in reversed(node.children):
                todo.append((child, False, inner))
                if tag in APART:
                    todo.append((" ", False, inner))
            if tag == "svg" or drawn and tag in DRAWN:
                page.block(1)
                drawn.append(tag != "svg")
            if tag == "br":
                if visible:
                    page.new_line()
            elif tag in ("td", "th"):
                pages.append((page, lists, kept))
                page, lists, kept = Page(), [], 0
            elif tag == "table":
                page.block(2)
                tables.append([])
            elif tag == "tr" and tables:
                tables[-1].append([])
            elif tag in ("ul", "ol", "menu", "dir"):
                page.block(1 if lists else 2)
                start = node.attrs.get("start") or ""
                lists.append(["ol" if tag == "ol" else "ul", int(start) if re.fullmatch(r"-?\d{1,9}", start) else 1, page.indent])
            elif tag == "li":
                page.block(1)
                kind, number, indent = lists[-1] if lists else ("ul", 1, page.indent)
                page.mark = f"{number}. " if kind == "ol" else "- "
                page.indent = indent + " " * len(page.mark)
                if lists:
                    lists[-1][1] += 1
            elif tag in BLOCKS:
                page.block(2 if tag in SPACED else 1)
            if tag in ("pre", "textarea"):
                kept += 1
            continue
        if tag == "svg" or drawn and tag in DRAWN:
            page.block(1)
            drawn.pop()
        if tag in ("td", "th"):
            lines = page.done()
            page, lists, kept = pages.pop()
            span = node.attrs.get("colspan") or ""
            cell = (lines, min(100, max(1, int(span))) if re.fullmatch(r"\d{1,9}", span) else 1)
            if tables and tables[-1]:
                tables[-1][-1].append(cell)
            else:
                page.block(1)
                page.put_lines(lines)
                page.block(1)
        elif tag == "table":
            lines = table_lines(tables.pop())
            if lines:
                page.put_lines(lines)
            page.block(2)
        elif tag in ("ul", "ol", "menu", "dir"):
            page.indent = lists.pop()[2]
            page.block(1 if lists else 2)
        elif tag == "li":
            page.mark = ""
            page.indent = lists[-1][2] if lists else ""
            page.block(1)
        elif tag in BLOCKS and tag != "tr":
            page.block(2 if tag in SPACED else 1)
        if tag in ("pre", "textarea"):
            kept -= 1
    return "\n".join(page.done())


@F.arrow_udf(T.StringType())
def extract(pages: pa.Array) -> pa.Array:
    return pa.array([visible_text(p.as_py() or "") for p in pages], pa.string())


def with_text(pages: DataFrame, html: str = "html", into: str = "text") -> DataFrame:
    """``pages`` with the visible text of each in a column ``into``, which is replaced if it exists.

    A null or empty page, and one without visible text, gives an empty text. Rows are never
    merged or dropped; an empty table gives an empty one; all other columns pass through.
    """
    return bounded(pages).withColumn(into, extract(F.coalesce(html, F.lit(""))))


def op7_html_text(pages: DataFrame) -> DataFrame:
    done = with_text(pages.select("page_id", "url", "html"))
    return done.select("page_id", "url", F.octet_length("html").cast("long").alias("n_bytes"), F.length("text").cast("long").alias("n_chars"), "text")
