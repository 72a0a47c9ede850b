"""Tables of HTML pages as grids, by the standard library's parser.

Rows belong to the innermost table that is open; a table that is never closed ends with its page. Spans fill the cells they
cover, within their section of the table. Pages are spread over tasks like any other rows, each parsed on its own.
"""

from __future__ import annotations

import sys
from html.parser import HTMLParser

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import types as T

# the parser runs in tasks and travels by value, so the workers need no copy of the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_SECTIONS = ("thead", "tbody", "tfoot")
#: What HTML allows at most; a row span of 0 reaches the end of the section.
MOST_COLUMNS, MOST_ROWS = 1000, 65534


class _Table:
    def __init__(self):
        self.rows, self.header, self.pending = [], None, {}
        self.row = self.cell = None
        self.in_header = True

    def end_cell(self):
        if self.cell is not None:
            self.row.append(self.cell)
            self.cell = None

    def end_row(self):
        self.end_cell()
        if self.row is None:
            return
        plain = ["".join(parts) for parts, *_ in self.row]
        spread, heads = self._spread([(text, *rest) for text, (_, *rest) in zip(plain, self.row)])
        self.row = None
        if not spread:
            return
        # the first row, and those after it as long as they hold headings alone
        if not self.rows or self.in_header and all(heads):
            names = [text if head else "" for text, head in zip(spread, heads)]
            above = self.header or []
            wide = max(len(above), len(names))
            above, names = (x + [""] * (wide - len(x)) for x in (above, names))
            self.header = [f"{a} | {n}" if a and n and a != n else a or n for a, n in zip(above, names)]
        self.in_header = self.in_header and all(heads)
        self.rows.append({"cells": spread, "plain": plain})

    def _spread(self, cells):
        """The row's grid with what spans from rows above; whether each cell is a heading."""
        out, left, kept = [], list(cells), {}
        while left or any(c >= len(out) for c in self.pending):
            at = len(out)
            if at in self.pending:
                text, head, more = self.pending[at]
                out.append((text, head))
                if more > 1:
                    kept[at] = (text, head, more - 1)
            elif left:
                text, head, columns, rows = left.pop(0)
                for c in range(at, at + columns):
                    if c in self.pending:
                        break  # what spans from above stays where it is
                    out.append((text, head))
                    if rows > 1:
                        kept[c] = (text, head, rows - 1)
            else:
                out.append(("", False))
        self.pending = kept
        return [t for t, _ in out], [h for _, h in out]

    def end_section(self):
        self.end_row()
        self.pending = {}


def _span(attrs, name: str, most: int) -> int:
    digits = (dict(attrs).get(name) or "").strip()
    value = int(digits[:9]) if digits.isascii() and digits.isdigit() else 1
    return most if value > most else value


class _Parser(HTMLParser):
    def __init__(self):
        super().__init__()
        self.found, self.open, self.hidden = [], [], None

    def parse_marked_section(self, i, report=1):
        end = self.rawdata.find(">", i)
        return end + 1 if end >= 0 else -1

    def say(self, text):
        if self.hidden is None:
            for t in self.open:
                if t.cell is not None:
                    t.cell[0].append(text)

    handle_data = say

    def handle_starttag(self, tag, attrs):
        self.say(" ")
        if tag in ("script", "style"):
            self.hidden = tag
        elif tag == "table":
            if self.open and self.open[-1].cell is None:
                self.open.pop().end_section()  # it was never closed; only a cell holds further tables
            self.open.append(_Table())
            self.found.append(self.open[-1])
        elif self.open:
            t = self.open[-1]
            if tag in _SECTIONS:
                t.end_section()
            elif tag == "tr":
                t.end_row()
                t.row = []
            elif tag in ("td", "th"):
                t.end_cell()
                t.row = [] if t.row is None else t.row
                t.cell = ([], tag == "th", max(1, _span(attrs, "colspan", MOST_COLUMNS)), _span(attrs, "rowspan", MOST_ROWS) or MOST_ROWS)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if self.hidden == tag:
            self.hidden = None

    def handle_endtag(self, tag):
        if tag == self.hidden:
            self.hidden = None
        self.say(" ")
        if not self.open:
            return
        t = self.open[-1]
        if tag == "table":
            self.open.pop().end_section()
        elif tag in _SECTIONS:
            t.end_section()
        elif tag == "tr":
            t.end_row()
        elif tag in ("td", "th"):
            t.end_cell()


def tables(page: str | None) -> list[dict]:
    """The tables of a page in order of their start: ``header`` by column, and ``rows`` of ``cells`` (spans filled in) and
    ``plain`` cells (as written)."""
    parser = _Parser()
    parser.feed(page or "")
    parser.close()
    while parser.open:
        parser.open.pop().end_section()
    return [{"header": t.header or [], "rows": t.rows} for t in parser.found]


TABLES = "array<struct<header: array<string>, rows: array<struct<cells: array<string>, plain: array<string>>>>>"


def with_tables(pages: DataFrame, html: str, name: str) -> DataFrame:
    """``pages`` with the tables of the pages in place of their source."""
    others = [c for c in pages.columns if c != html]
    strings = pa.list_(pa.string())
    kind = pa.list_(pa.struct([("header", strings), ("rows", pa.list_(pa.struct([("cells", strings), ("plain", strings)])))]))

    def work(batches):
        for b in batches:
            columns = [b.column(c) for c in others]
            # page by page, so that no more than one page's grids are held as Python objects
            found = [pa.array([tables(page.as_py())], kind) for page in b.column(html)]
            yield pa.RecordBatch.from_arrays([*columns, pa.concat_arrays(found) if found else pa.array([], kind)], names=[*others, name])

    schema = T.StructType([pages.schema[c] for c in others] + T._parse_datatype_string(f"`{name}` {TABLES}").fields)
    return pages.mapInArrow(work, schema)
