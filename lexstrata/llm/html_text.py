"""HTML extraction: lays a page out as text and keeps all that a reader would see.

A scanner finds tags, comments and text; a tree builder keeps the stack of open elements, closes what the next tag
implies (paragraphs, list items, cells, rows, options, the head) and ignores end tags without a start. Layout happens as
elements open and close: blocks begin lines, some with an empty line around them; list items get a bullet or number and
an indent; a table's cells are laid out by themselves and set in aligned columns; preformatted text keeps its spaces.
"""

from __future__ import annotations

import re
from html import unescape
from unicodedata import combining, east_asian_width

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import as_bytes

# Element classes of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style xmp iframe noembed noframes textarea title".split())
HEAD_ONLY = frozenset("base basefont bgsound head html link meta noframes noscript script style template title".split())
UNSEEN = frozenset("head script style template noscript iframe noembed noframes title datalist object audio video canvas annotation annotation-xml metadata defs desc".split())
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre dl figure ul ol menu dir table fieldset hr".split())
LINES = frozenset("html body div section article header footer nav main aside address center form details summary dialog figcaption hgroup legend li dt dd caption optgroup option tr".split())
ENDS_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr li main menu nav ol p pre section summary table ul dd dt".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
CELLS = frozenset(("td", "th"))
SECTIONS = frozenset(("thead", "tbody", "tfoot"))
#: An end tag, or an implied end, does not reach beyond these.
WALLS = frozenset("html table td th caption button object template".split())

_TAG = re.compile(r"""<!--(?:>|->|.*?(?:--!?>|\Z))|<[!?/][^a-zA-Z>][^>]*(?:>|\Z)|<![^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?>=\s*(?:"[^"]*"|'[^']*')|[^>])*)(>|\Z)""", re.S)
_SPACES = re.compile(r"[ \t\n\r\f]+")
_HIDDEN = re.compile(r"display\s*:\s*none", re.I)
_VISIBILITY = re.compile(r"visibility\s*:\s*(hidden|collapse|visible)", re.I)
#: Columns that lines are indented by at most; deeper lists stand at this indent.
MOST_INDENT = 80
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
_ENDS = {t: re.compile(rf"</{t}(?=[\s/>])[^>]*(?:>|\Z)", re.I) for t in RAW}


def _attributes(source: str) -> dict[str, str]:
    out: dict[str, str] = {}
    for name, *values in _ATTRIBUTE.findall(source):
        out.setdefault(name.lower(), unescape("".join(values)))
    return out


def _number(value: str | None, default: int, low: int, high: int) -> int:
    m = re.match(r"\s*(-?\d{1,9})", value or "")
    return min(high, max(low, int(m[1]))) if m else default


def width_of(line: str) -> int:
    """Columns that a line takes: two for wide characters, none for combining ones."""
    if line.isascii():
        return len(line)
    return sum(0 if combining(c) else 2 if east_asian_width(c) in "WF" else 1 for c in line)


class Flow:
    """Lines of text under construction."""

    def __init__(self):
        self.lines: list[str] = []
        self.now: list[str] = []
        self.space, self.gap = False, False
        self.indent, self.marker = 0, ""

    def text(self, data: str) -> None:
        words = [w for w in _SPACES.split(data) if w]
        if not words:
            self.space = True
            return
        if self.now and (self.space or data[0] in " \t\n\r\f"):
            self.now.append(" ")
        self.now.append(" ".join(words))
        self.space = data[-1] in " \t\n\r\f"

    def kept(self, data: str) -> None:
        """Preformatted text."""
        first, *rest = data.replace("\r\n", "\n").split("\n")
        self.now.append(first)
        for x in rest:
            self.end(True)
            self.now.append(x)

    def end(self, empty: bool = False) -> None:
        """Ends the line, if it has anything (or empty lines count)."""
        line = "".join(self.now)
        self.now, self.space = [], False
        if not line and not empty:
            return
        if self.gap and self.lines:
            self.lines.append("")
        self.gap = False
        indent = min(self.indent, MOST_INDENT)
        lead = " " * max(0, indent - len(self.marker)) + self.marker if self.marker else " " * indent
        self.marker = ""
        self.lines.append((lead + line).rstrip())

    def apart(self) -> None:
        self.end()
        self.gap = True

    def block(self, lines: list[str]) -> None:
        self.apart()
        for x in lines:
            self.now.append(x)
            self.end(True)
        self.gap = True


class Table:
    def __init__(self):
        self.rows: list[list[list[str]]] = []
        self.held: dict[int, int] = {}  # rows that a cell above still covers, by column

    def row(self) -> None:
        self.rows.append([])
        self.skip()

    def skip(self) -> None:
        row = self.rows[-1]
        while self.held.get(len(row), 0) > 0:
            self.held[len(row)] -= 1
            row.append([])

    def cell(self, lines: list[str], columns: int, rows: int) -> None:
        if not self.rows:
            self.row()
        row = self.rows[-1]
        for i in range(columns):
            if rows > 1:
                self.held[len(row)] = rows - 1
            row.append(lines if i == 0 else [])
        self.skip()

    def lines(self) -> list[str]:
        """Columns as wide as their widest line, two spaces apart; cells of several lines stand side by side."""
        width: dict[int, int] = {}
        for row in self.rows:
            for i, cell in enumerate(row):
                width[i] = max([width.get(i, 0), *map(width_of, cell)])
        used = [i for i in sorted(width) if width[i]]
        out = []
        for row in self.rows:
            for n in range(max([0, *map(len, row)])):
                shown = [row[i][n] if i < len(row) and n < len(row[i]) else "" for i in used]
                out.append("  ".join(x + " " * (width[i] - width_of(x)) for i, x in zip(used, shown, strict=True)).rstrip())
        return out


class Renderer:
    def __init__(self):
        self.open: list[tuple] = []  # (tag, hidden, what closing it needs, what muted text before it)
        self.places: dict[str, list[int]] = {}  # of each tag, its open elements' places
        self.hidden = 0
        self.invisible = self.drawing = False  # by style; inside a drawing, but not in a text of it
        self.flows = [Flow()]
        self.tables: list[Table] = []
        self.pre = 0
        self.items = self.n_tables = 0

    @property
    def flow(self) -> Flow:
        return self.flows[-1]

    # -- tree builder

    def last(self, tags) -> int:
        """Place of the innermost open element among tags, else -1; its cost does not grow with the depth."""
        return max((self.places[t][-1] for t in tags if self.places.get(t)), default=-1)

    def find(self, tags, walls=WALLS) -> int | None:
        """Place of the innermost open element among tags that is not behind a wall."""
        at = self.last(tags)
        return at if at >= 0 and at >= self.last(walls) else None

    def pop(self) -> None:
        tag, hidden, need, muted = self.open.pop()
        self.places[tag].pop()
        self.shut(tag, hidden, need)
        self.invisible, self.drawing = muted

    def close_from(self, i: int | None) -> None:
        while i is not None and len(self.open) > i:
            self.pop()

    def imply(self, tag: str) -> bool:
        """Closes what a start tag ends. False: the tag has no place here."""
        if self.open and tag not in HEAD_ONLY:
            self.close_from(self.find({"head"}, ()))
        if tag in ENDS_P:
            self.close_from(self.find({"p"}))
        if tag in HEADINGS and self.open and self.open[-1][0] in HEADINGS:
            self.close_from(len(self.open) - 1)
        elif tag == "li":
            self.close_from(self.find({"li"}, WALLS | {"ul", "ol", "menu", "dir"}))
        elif tag in ("dt", "dd"):
            self.close_from(self.find({"dt", "dd"}, WALLS | {"dl"}))
        elif tag in ("option", "optgroup"):
            self.close_from(self.find({"option"}, WALLS | {"select"}))
            if tag == "optgroup":
                self.close_from(self.find({"optgroup"}, WALLS | {"select"}))
        elif tag in CELLS or tag in SECTIONS or tag in ("tr", "caption", "colgroup"):
            table = self.find({"table"}, {"template", "html"})
            if table is None:
                return False
            keep = {"td": {"tr"}, "th": {"tr"}, "tr": SECTIONS}.get(tag, set())
            while len(self.open) > table + 1 and self.open[-1][0] not in keep:
                self.pop()
            if tag in CELLS and self.open[-1][0] == "table":
                self.enter("tr", {})
        return True

    def start(self, tag: str, source: str) -> None:
        attributes = _attributes(source) if source.strip(" /\n\t") else {}
        if not self.imply(tag):
            return
        if tag in VOID:
            self.void(tag)
        elif tag in ("html", "body") and self.find({tag}, ()) is not None:
            return
        else:
            self.enter(tag, attributes)

    def end(self, tag: str) -> None:
        if tag == "br":
            self.void("br")
        elif tag == "p" and self.find({"p"}) is None:
            if not self.hidden:
                self.flow.apart()
        elif tag in HEADINGS:
            self.close_from(self.find(HEADINGS))
        elif tag in CELLS or tag in SECTIONS or tag in ("tr", "table"):
            self.close_from(self.find({tag}, {"template", "html"} | ({"table"} if tag != "table" else set())))
        elif tag not in ("html", "body"):
            self.close_from(self.find({tag}, WALLS - {tag}))

    # -- layout

    def unseen(self, tag: str, attributes: dict[str, str]) -> bool:
        if tag in UNSEEN or "hidden" in attributes or _HIDDEN.search(attributes.get("style", "")):
            return True
        closed = self.open and self.open[-1][0] == "details" and self.open[-1][2] == "closed"
        return bool(closed and tag != "summary")

    def enter(self, tag: str, attributes: dict[str, str]) -> None:
        hidden, muted = self.unseen(tag, attributes), (self.invisible, self.drawing)
        self.hidden += hidden
        if styled := _VISIBILITY.search(attributes.get("style", "")):
            self.invisible = styled[1].lower() != "visible"
        if tag == "svg":
            self.drawing = True
        elif muted[1] and tag in ("text", "foreignobject"):
            self.drawing = False
            self.flow.space = True
        need = None
        if not self.hidden:
            f = self.flow
            if tag in ("ul", "ol", "menu", "dir"):
                nested = self.find({"li"}, WALLS) is not None
                f.end() if nested else f.apart()
                need = [f, nested, _number(attributes.get("start"), 1, -(10**9), 10**9) if tag == "ol" else None]
            elif tag == "li":
                f.end()
                at = self.find({"ul", "ol", "menu", "dir"})
                holder = self.open[at][2] if at is not None else None
                marker = "- "
                if holder and holder[2] is not None:
                    number = _number(attributes.get("value"), holder[2], -(10**9), 10**9)
                    marker, holder[2] = f"{number}. ", number + 1
                f.indent += len(marker)
                f.marker, need = marker, (f, len(marker))
                self.items += 1
            elif tag == "table":
                f.apart()
                self.tables.append(Table())
                need = (f, self.tables[-1])
                self.n_tables += 1
            elif tag == "tr" and self.tables:
                self.tables[-1].row()
            elif tag in CELLS and self.tables:
                self.flows.append(Flow())
                need = (self.flows[-1], self.tables[-1], _number(attributes.get("colspan"), 1, 1, 1000), _number(attributes.get("rowspan"), 1, 1, 65534))
            elif tag == "caption":
                self.flows.append(Flow())
                need = self.flows[-1]
            elif tag == "pre":
                f.apart()
                self.pre += 1
                need = "pre"
            elif tag in ("blockquote", "dd"):
                f.apart() if tag == "blockquote" else f.end()
                f.indent += 2
                need = f
            elif tag == "details":
                f.end()
                need = None if "open" in attributes else "closed"
            elif tag in SPACED:
                f.apart()
            elif tag in LINES:
                f.end()
        self.places.setdefault(tag, []).append(len(self.open))
        self.open.append((tag, hidden, need, muted))

    def shut(self, tag: str, hidden: bool, need) -> None:
        if not self.hidden:
            f = self.flow
            if tag in ("ul", "ol", "menu", "dir"):
                f.end() if need[1] else f.apart()
            elif tag == "li":
                f.end()
                f.marker = ""
                need[0].indent -= need[1]
            elif tag == "table":
                table = self.tables.pop()
                need[0].block(table.lines())
            elif tag in CELLS and need:
                f.end()
                self.flows.pop()
                need[1].cell(f.lines, need[2], need[3])
            elif tag == "caption":
                f.end()
                self.flows.pop()
                self.flow.block(f.lines)
            elif need == "pre":
                self.pre -= 1
                f.apart()
            elif tag in ("blockquote", "dd"):
                f.apart() if tag == "blockquote" else f.end()
                need.indent -= 2
            elif tag in SPACED:
                f.apart()
            elif tag in LINES:
                f.end()
        self.hidden -= hidden

    def void(self, tag: str) -> None:
        if self.hidden:
            return
        if tag == "br":
            self.flow.end(True)
        elif tag == "hr":
            self.flow.apart()

    def text(self, data: str) -> None:
        closed = self.open and self.open[-1][2] == "closed"
        if self.hidden or closed or self.invisible or self.drawing or not data:
            return
        if "&" in data:
            data = unescape(data)
        if self.pre:
            self.flow.kept(data)
        elif not self.tables or self.open[-1][0] not in ("table", "tr", "thead", "tbody", "tfoot"):
            self.flow.text(data)
        elif data.strip(" \t\n\r\f"):
            # text between cells is shown before the table
            self.flow.text(data)

    def render(self, html: str) -> str:
        at, n = 0, len(html)
        while at < n:
            m = _TAG.search(html, at)
            self.text(html[at : m.start()] if m else html[at:])
            if not m:
                break
            at = m.end()
            if not m[2] or not m[4]:
                continue
            tag = m[2].lower()
            if m[1]:
                self.end(tag)
                continue
            self.start(tag, m[3])
            if tag in RAW:
                end = _ENDS[tag].search(html, at)
                if tag in ("textarea", "xmp"):
                    self.text(html[at : end.start() if end else n])
                at = end.end() if end else n
                self.end(tag)
        self.close_from(0)
        for f in self.flows:
            f.end()
        return "\n".join(x for f in self.flows for x in f.lines)


def render(html: str | None) -> tuple[str, int, int]:
    """Text of a page, its list items and its tables."""
    r = Renderer()
    text = r.render((html or "").replace("\x00", ""))
    return text.strip("\n"), r.items, r.n_tables


def extract(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """id, text, n_chars, n_lines (lines with text), n_items (list items), n_tables of every page.

    Null and empty pages have empty texts. Repeated ids are pages of their own; other columns are not read, so their names cannot
    clash. Pages are rendered whole, in time that grows with their length and not with their depth; ties do not come up. No
    pages give no rows.
    """

    def run(batches):
        for batch in batches:
            found = [render(h.decode("utf-8", "replace")) for h in as_bytes(batch.column(1))]
            lines = [sum(1 for x in t.split("\n") if x) for t, _, _ in found]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([t for t, _, _ in found], pa.string()), pa.array([len(t) for t, _, _ in found], pa.int64()), pa.array(lines, pa.int64()), pa.array([i for _, i, _ in found], pa.int64()), pa.array([n for _, _, n in found], pa.int64())],
                names=[id_col, "text", "n_chars", "n_lines", "n_items", "n_tables"],
            )

    kind = pages.schema[id_col].dataType.simpleString()
    return pages.select(F.col(id_col), F.col(html_col).cast("binary").alias("html")).mapInArrow(run, f"{id_col} {kind}, text string, n_chars bigint, n_lines bigint, n_items bigint, n_tables bigint")
