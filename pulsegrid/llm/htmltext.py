"""HTML extraction by layout: a tree builder with implied tags, visibility rules, and a renderer of all visible text.

Tags become a stream of openings and closings of well-formed elements: end tags that HTML leaves out are implied
(a paragraph before a block, items, rows and cells before their next sibling, all that is open at an ancestor's end).
Text is rendered as a reader sees it: inline runs collapse blanks, blocks start lines, paragraphs and headings stand
apart, lists are marked and indented, preformatted text keeps its lines, and the cells of a table are padded to
columns. Nothing visible is left out as boilerplate. Invisible are the elements of INVISIBLE, those with the hidden
attribute or with display:none or visibility:hidden, inline or by a style sheet's rule for a tag, class or id, closed
details but for their summary, and comments.

Depth is no recursion but a stack, and a page is held once as text and once as lines, so long pages take memory in
proportion to themselves. Defined results: null and empty pages give an empty text; broken markup never fails.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed values of the HTML standard.
VOID = set("area base br col embed hr img input link meta source track wbr".split())
INVISIBLE = set("head script style template noscript title meta link base datalist param object audio video canvas iframe svg math map colgroup".split())
BLOCKS = set("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset header hgroup html legend li listing main menu nav ol optgroup option p pre section summary table tbody td tfoot th thead tr ul h1 h2 h3 h4 h5 h6 hr caption search".split())
SPACED = set("p blockquote dl figure h1 h2 h3 h4 h5 h6 ol ul menu dir pre table fieldset hr article section".split())
#: An opening of the key closes an open element of the value, up to the nearest element of the last set.
IMPLIED = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "option": ({"option"}, {"select", "datalist"}), "optgroup": ({"option", "optgroup"}, {"select"}),
    "tr": ({"tr", "td", "th", "caption"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "body": ({"head"}, {"html"}),
    **dict.fromkeys(("thead", "tbody", "tfoot"), ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption"}, {"table"})),
}
#: A paragraph is not closed beyond these.
SCOPE = {"table", "td", "th", "caption", "button", "object", "template", "html"}
_BLANKS = re.compile(r"[ \t\n\r\f]+")
_RULE = re.compile(r"([^{}]+)\{([^{}]*)\}")
_HIDING = re.compile(r"(?:^|;)\s*(?:display\s*:\s*none|visibility\s*:\s*(?:hidden|collapse))\b", re.I)
_SIMPLE = re.compile(r"^([a-z][a-z0-9]*)?([.#][\w-]+)?$", re.I)


def width(text: str) -> int:
    """Columns that a text takes: two for wide characters, none for combining ones."""
    if text.isascii():
        return len(text)
    return sum(0 if unicodedata.combining(c) else 2 if unicodedata.east_asian_width(c) in "WF" else 1 for c in text)


class Flow:
    """Lines of a column of text: of the page, or of a table cell."""

    def __init__(self):
        self.lines: list[str] = []
        self.run: list[str] = []
        self.blank_due = False
        self.space_due = False
        self.indents: list[str] = []
        self.marker = ""

    def text(self, data: str) -> None:
        for n, piece in enumerate(_BLANKS.split(data)):
            if n:
                self.space_due = bool(self.run)
            if piece:
                if self.space_due:
                    self.run.append(" ")
                self.run.append(piece.replace("\xa0", " "))
                self.space_due = False

    def preformatted(self, data: str) -> None:
        first, *rest = data.replace("\r\n", "\n").replace("\r", "\n").split("\n")
        if first:
            self.run.append(first)
        for line in rest:
            self.end_line(keep=True)
            if line:
                self.run.append(line)

    def end_line(self, keep: bool = False) -> None:
        """Finish the line; keep: also an empty one (br, preformatted text)."""
        self.space_due = False
        if not self.run and not self.marker and not keep:
            return
        if self.blank_due and self.lines:
            self.lines.append("")
        self.blank_due = False
        body = "".join(self.run)
        indent = "".join(self.indents)
        if self.marker:
            indent = indent[: -len(self.marker)] + self.marker
        self.lines.append((indent + body).rstrip())
        self.run, self.marker = [], ""

    def block(self, spaced: bool) -> None:
        if self.run:
            self.end_line()
        self.blank_due = self.blank_due or spaced

    def item(self, marker: str) -> None:
        self.end_line()
        self.indents.append(" " * len(marker))
        self.marker = marker

    def leave_item(self) -> None:
        self.end_line()
        self.indents.pop()

    def insert(self, lines: list[str]) -> None:
        for line in lines:
            self.run = [line]
            self.end_line(keep=True)

    def done(self) -> list[str]:
        self.end_line()
        lines = self.lines
        while lines and not lines[-1]:
            lines.pop()
        return lines


class Table:
    def __init__(self):
        self.rows: list[list[tuple[list[str], int]]] = []
        self.captions: list[str] = []

    def lines(self) -> list[str]:
        """Cells padded to the widest of their column, two blanks apart; a cell of several lines makes a row of several."""
        widths: list[int] = []
        for row in self.rows:
            at = 0
            for cell, span in row:
                widths += [0] * (at + span - len(widths))
                if span == 1:
                    widths[at] = max(widths[at], *map(width, cell), 0) if cell else widths[at]
                at += span
        for row in self.rows:  # what a spanning cell needs beyond its columns widens the last of them
            at = 0
            for cell, span in row:
                need = max(map(width, cell), default=0) - sum(widths[at : at + span]) - 2 * (span - 1)
                if span > 1 and need > 0:
                    widths[at + span - 1] += need
                at += span
        out = list(self.captions)
        for row in self.rows:
            for k in range(max((len(c) for c, _ in row), default=0)):
                line, at = [], 0
                for cell, span in row:
                    text = cell[k] if k < len(cell) else ""
                    line.append(text + " " * (sum(widths[at : at + span]) + 2 * (span - 1) - width(text)))
                    at += span
                out.append("  ".join(line).rstrip())
        return out


class Renderer(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.open: list[tuple[str, bool]] = []
        self.count: dict[str, int] = {}
        self.flows, self.tables, self.lists = [Flow()], [], []
        self.hidden = self.pre = 0
        self.rules: set[tuple[str, str]] = set()
        self.sheet: list[str] | None = None

    # visibility

    def _learn(self, css: str) -> None:
        for selectors, body in _RULE.findall(re.sub(r"/\*.*?\*/", "", css, flags=re.S)):
            if _HIDING.search(body):
                for s in selectors.split(","):
                    if (m := _SIMPLE.match(s.strip())) and s.strip():
                        self.rules.add(((m[1] or "").lower(), m[2] or ""))

    def _invisible(self, tag: str, attrs: dict[str, str | None]) -> bool:
        if tag in INVISIBLE or "hidden" in attrs or (tag == "input" and (attrs.get("type") or "").lower() == "hidden"):
            return True
        if (tag == "dialog" and "open" not in attrs) or _HIDING.search(attrs.get("style") or ""):
            return True
        if self.open and tag != "summary" and self.open[-1][0] == "details" and self.closed_details:
            return True
        marks = ["", *(f".{c}" for c in (attrs.get("class") or "").split()), *([f"#{attrs['id']}"] if attrs.get("id") else [])]
        return bool(self.rules) and any((t, m) in self.rules for t in (tag, "") for m in marks if t or m)

    @property
    def closed_details(self) -> bool:
        return bool(self.details and not self.details[-1])

    details: list[bool] = []

    # tree

    def _close_within(self, names: set[str], barrier: set[str]) -> None:
        left = sum(self.count.get(n, 0) for n in names)
        outermost, i = None, len(self.open) - 1
        while left and i >= 0 and self.open[i][0] not in barrier:
            if self.open[i][0] in names:
                outermost, left = i, left - 1
            i -= 1
        while outermost is not None and len(self.open) > outermost:
            self._pop()

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in IMPLIED:
            self._close_within(*IMPLIED[tag])
        if tag in BLOCKS and tag not in ("html", "body"):
            self._close_within({"p"}, SCOPE)
        if tag in BLOCKS or tag == "a":
            self._close_within({"head"}, {"html"})
        if re.fullmatch("h[1-6]", tag):
            self._close_within({"h1", "h2", "h3", "h4", "h5", "h6"}, SCOPE | {"div", "section", "article"})
        named = dict(attrs)
        invisible = self._invisible(tag, named)
        if tag in VOID:
            if not self.hidden and not invisible:
                self._void(tag)
            return
        self.open.append((tag, invisible))
        self.count[tag] = self.count.get(tag, 0) + 1
        if tag == "details":
            self.details = [*self.details, "open" in named]
        if tag == "style":
            self.sheet = []
        self.hidden += invisible
        if not self.hidden:
            self._enter(tag, named)

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag: str) -> None:
        if tag == "p" and not self.count.get("p"):
            self.handle_starttag("p", [])
        if not self.count.get(tag):
            return
        barrier = {"table"} if tag in ("li", "p", "div", "ul", "ol") and self.count.get("table") else set()
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i][0] == tag:
                while len(self.open) > i:
                    self._pop()
                return
            if self.open[i][0] in barrier:
                return

    def _pop(self) -> None:
        tag, invisible = self.open.pop()
        self.count[tag] -= 1
        if not self.hidden:
            self._leave(tag)
        self.hidden -= invisible
        if tag == "details":
            self.details = self.details[:-1]
        if tag == "style" and self.sheet is not None:
            self._learn("".join(self.sheet))
            self.sheet = None

    # layout

    def _void(self, tag: str) -> None:
        flow = self.flows[-1]
        if tag == "br":
            flow.end_line(keep=True)
        elif tag == "hr":
            flow.block(True)

    def _enter(self, tag: str, attrs: dict[str, str | None]) -> None:
        flow = self.flows[-1]
        if tag == "table":
            flow.block(True)
            self.tables.append(Table())
        elif tag == "tr" and self.tables:
            self.tables[-1].rows.append([])
        elif tag in ("td", "th", "caption") and self.tables:
            span = attrs.get("colspan") or "1"
            self.flows.append(Flow())
            if tag != "caption":
                if not self.tables[-1].rows:
                    self.tables[-1].rows.append([])
                self.tables[-1].rows[-1].append(([], min(1000, max(1, int(span))) if span.isascii() and span.isdigit() and len(span) < 5 else 1))
        elif tag in ("ul", "ol", "menu", "dir"):
            flow.block(not self.lists)
            start = attrs.get("start") or "1"
            self.lists.append(int(start) if tag == "ol" and re.fullmatch(r"-?[0-9]{1,9}", start) else 1 if tag == "ol" else None)
        elif tag == "li":
            flow.block(False)
            number = self.lists[-1] if self.lists else None
            flow.item("- " if number is None else f"{number}. ")
            if number is not None:
                self.lists[-1] += 1
        elif tag in ("dd", "blockquote"):
            flow.block(tag == "blockquote")
            flow.item("    ")
        elif tag in BLOCKS:
            flow.block(tag in SPACED)
        self.pre += tag in ("pre", "listing", "textarea")

    def _leave(self, tag: str) -> None:
        flow = self.flows[-1]
        self.pre -= tag in ("pre", "listing", "textarea")
        if tag in ("td", "th", "caption") and self.tables and len(self.flows) > 1:
            lines = self.flows.pop().done()
            table = self.tables[-1]
            if tag == "caption":
                table.captions += lines
            else:
                table.rows[-1][-1][0].extend(lines)
        elif tag == "table" and self.tables:
            table = self.tables.pop()
            flow.block(True)
            flow.insert(table.lines())
            flow.block(True)
        elif tag in ("ul", "ol", "menu", "dir"):
            if self.lists:
                self.lists.pop()
            flow.block(not self.lists)
        elif tag in ("li", "dd", "blockquote") and flow.indents:
            flow.leave_item()
            flow.block(tag == "blockquote")
        elif tag in BLOCKS:
            flow.block(tag in SPACED)

    def handle_data(self, data: str) -> None:
        if self.sheet is not None:
            self.sheet.append(data)
        if self.hidden or (self.open and self.open[-1][0] == "details" and self.closed_details):
            return
        flow = self.flows[-1]
        flow.preformatted(data) if self.pre else flow.text(data)

    def result(self) -> str:
        if re.match(r"<[a-zA-Z/!?]", self.rawdata):  # a tag or comment that the page's end cuts off is none
            self.rawdata = ""
        self.close()
        while self.open:
            self._pop()
        return "\n".join(self.flows[0].done())


def visible_text(html: str | None) -> str:
    """The visible text of a page, as it is laid out."""
    if not html:
        return ""
    page = Renderer()
    page.feed(html)
    return page.result()


def extract(pages: DataFrame, html: str = "html", out: str = "text") -> DataFrame:
    """pages with the column out (replaced where there is one)."""
    kept = [c for c in pages.columns if c != out or c == html]
    at = kept.index(html)
    name = out if out not in kept else f"{out}_text"
    shaped = pages.select(*kept).withColumn(name, F.lit(None).cast("string"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [visible_text(h) for h in b[at].to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(texts, pa.string())], schema=b.schema)

    return shaped.mapInArrow(run, shaped.schema)


def report(pages: DataFrame) -> DataFrame:
    """The text of every page with its lengths."""
    out = extract(pages.select("page_id", "url", "html"))
    return out.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"), F.sha2(F.encode("text", "UTF-8"), 256).alias("text_sha256"))
