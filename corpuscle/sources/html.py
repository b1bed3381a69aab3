"""Stored web pages -> blocks, text lines and tables, one pass over the HTML.

Parsing is row-local Python over Arrow batches; everything behind it is plain
DataFrame work on narrow rows.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

# Elements that hold no readable text, and class parts of adverts,
# author boxes and hidden instructions to machines.
JUNK_TAGS = ("script", "style", "ins", "iframe", "noscript")
JUNK_CLASSES = ("advHolder", "viewAds", "ads-", "-ads", "adsbygoogle", "google-auto-placed",
                "ad-label-container", "model_prompt", "related-content", "author")
BLOCK_TAGS = ("p", "li", "tr", "h1", "h2", "h3", "h4")
NESTING_TAGS = ("p", "li", "tr")
ENDS_PARAGRAPH = ("p", "table", "ul", "ol", "dl", "div", "h1", "h2", "h3", "h4", "h5", "h6",
                  "blockquote", "pre", "form", "hr", "article", "section", "footer", "header")
VOID_TAGS = ("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source",
             "track", "wbr")

BLOCK_SCHEMA = "block_no INT, tag STRING, css_class STRING, text STRING, href STRING"
TABLE_SCHEMA = "table_no INT, row_no INT, cells ARRAY<STRING>"
LINE_SCHEMA = "line_no INT, text STRING"


@dataclass(frozen=True)
class PageRules:
    junk_tags: tuple[str, ...] = JUNK_TAGS
    junk_classes: tuple[str, ...] = JUNK_CLASSES
    joiner: str = " "                # put between inline pieces ('' joins them directly)
    # Names of the character references that are decoded, where a semicolon ends them; all that
    # browsers know, cut ones too, when None.
    references: tuple[str, ...] | None = None


class _Open:
    """An open element and where its text and its inner blocks begin."""

    __slots__ = ("tag", "css", "href", "number", "junk", "text_from", "blocks_from")

    def __init__(self, tag: str, css: str, href: str, number: int, junk: bool, text_from: int, blocks_from: int) -> None:
        self.tag, self.css, self.href, self.number, self.junk = tag, css, href, number, junk
        self.text_from, self.blocks_from = text_from, blocks_from


class _Page(HTMLParser):
    """Collects leaf blocks, anchors, text lines and tables of one page.

    Text is kept once, in pieces; an element is the interval of pieces that came while
    it was open.  So the work follows the size of the page, not the depth of it.
    """

    def __init__(self, rules: PageRules) -> None:
        super().__init__(convert_charrefs=True)
        self.rules = rules
        self.stack: list[_Open] = []
        self.open_tags: Counter[str] = Counter()
        self.pieces: list[str] = []
        self.nested = 0                       # blocks that count as nested, opened so far
        self.blocks: list[tuple[int, str, str, str, str]] = []
        self.lines: list[str] = []
        self.tables: list[list[list[str]]] = []
        self.open_tables: list[list] = []
        self.open_rows: list[list] = []
        self.open_cells: list[tuple[list[str], int]] = []
        self.count = 0

    def handle_starttag(self, tag: str, attrs) -> None:
        if tag in ENDS_PARAGRAPH:             # a new block closes an open paragraph
            self._close_open("p", ())
        if tag in VOID_TAGS:
            return
        values = dict(attrs)
        css = values.get("class") or ""
        if tag in ("li", "tr"):               # and these an open sibling of their own kind
            self._close_open(tag, {"li": ("ul", "ol"), "tr": ("table",)}[tag])
        junk = (bool(self.stack) and self.stack[-1].junk) or tag in self.rules.junk_tags or any(
            part in css for part in self.rules.junk_classes)
        self.nested += tag in NESTING_TAGS
        self.stack.append(_Open(tag, css, values.get("href") or "", self.count, junk, len(self.pieces), self.nested))
        self.open_tags[tag] += 1
        self.count += 1
        if junk:
            return
        if tag == "table":
            rows: list = []
            self.tables.append(rows)
            self.open_tables.append(rows)
        elif tag == "tr":
            row: list = []
            for rows in self.open_tables:
                rows.append(row)
            self.open_rows.append(row)
        elif tag in ("td", "th"):
            cell: list[str] = []              # its text, when it is closed
            for row in self.open_rows:
                row.append(cell)
            self.open_cells.append((cell, len(self.pieces)))

    def _close_open(self, tag: str, borders: Sequence[str]) -> None:
        if not self.open_tags[tag]:
            return
        for depth in range(len(self.stack) - 1, -1, -1):
            if self.stack[depth].tag == tag:
                while len(self.stack) > depth:
                    self._finish(self._pop())
                return
            if self.stack[depth].tag in (*borders, "td", "th", "div", "article", "body"):
                return

    def _pop(self) -> _Open:
        element = self.stack.pop()
        self.open_tags[element.tag] -= 1
        return element

    def handle_endtag(self, tag: str) -> None:
        if not self.open_tags[tag]:
            return
        while self.stack:
            element = self._pop()
            self._finish(element)
            if element.tag == tag:
                break

    def _finish(self, element: _Open) -> None:
        if element.junk:
            return
        if element.tag == "table" and self.open_tables:
            self.open_tables.pop()
        elif element.tag == "tr" and self.open_rows:
            self.open_rows.pop()
        elif element.tag in ("td", "th") and self.open_cells:
            cell, begin = self.open_cells.pop()
            cell.append(" ".join(" ".join(self.pieces[begin:]).split()))
        is_block = element.tag in BLOCK_TAGS and element.blocks_from == self.nested
        if is_block or element.tag == "a":
            text = " ".join(self.rules.joiner.join(self.pieces[element.text_from:]).split())
            if text or element.href:
                self.blocks.append((element.number, element.tag, element.css, text, element.href))

    def handle_data(self, data: str) -> None:
        if self.stack and self.stack[-1].junk:
            return
        self.pieces.append(data)
        line = " ".join(data.split())
        if line:
            self.lines.append(line)

    def finish(self) -> "_Page":
        self.close()
        while self.stack:
            self._finish(self._pop())
        return self


PAGES = 64           # pages that are parsed before their rows go out


def _scan(pages: DataFrame, key: str, html: str, rules: PageRules, ddl: str, rows_of) -> DataFrame:
    """Rows of all pages, of ``PAGES`` of them in one Arrow batch."""
    schema = T._parse_datatype_string(f"{key} {pages.schema[key].dataType.simpleString()}, {ddl}")
    arrow = to_arrow_schema(schema)
    # Any other ampersand stands for itself.
    plain = rules.references is not None and re.compile(f"&(?!(?:{'|'.join(rules.references) or '$.'});)")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, PAGES):
                part = batch.slice(start, PAGES)
                out: list[tuple] = []
                for page_key, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    page = _Page(rules)
                    page.feed(plain.sub("&amp;", text or "") if plain else text or "")
                    out += [(page_key, *row) for row in rows_of(page.finish())]
                if out:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, f.type) for c, f in zip(zip(*out), arrow)], schema=arrow)

    return pages.select(key, html).mapInArrow(run, schema)


def extract_blocks(pages: DataFrame, key: str = "page_id", html: str = "html",
                   rules: PageRules = PageRules()) -> DataFrame:
    """(key, block_no, tag, css_class, text, href): leaf blocks and anchors in page order."""
    return _scan(pages, key, html, rules, BLOCK_SCHEMA, lambda page: sorted(page.blocks))


def extract_lines(pages: DataFrame, key: str = "page_id", html: str = "html",
                  rules: PageRules = PageRules(JUNK_TAGS[:2], ())) -> DataFrame:
    """(key, line_no, text): every piece of text on a line of its own."""
    return _scan(pages, key, html, rules, LINE_SCHEMA, lambda page: list(enumerate(page.lines)))


def extract_tables(pages: DataFrame, key: str = "page_id", html: str = "html", minimum: int = 4,
                   rules: PageRules = PageRules(JUNK_TAGS[:2], ())) -> DataFrame:
    """(key, table_no, row_no, cells) of the tables with at least ``minimum`` rows."""
    def rows_of(page: _Page):
        out = []
        kept = [t for t in page.tables if len(t) >= minimum]
        for table_no, rows in enumerate(kept):
            for row_no, row in enumerate(rows):
                out.append((table_no, row_no, ["".join(c) for c in row]))
        return out

    return _scan(pages, key, html, rules, TABLE_SCHEMA, rows_of)
