"""Spreadsheet workbooks as Arrow batches, from any store that Spark reads.

A workbook is one zip archive that cannot be split, so a task takes it whole, as a file's bytes; its sheet is then walked row by
row, and a task holds those bytes, the shared texts and one batch of rows. Only the first sheet is read, values only. A row of
a table of positions says where each workbook has the wanted columns; other cells leave no task.
"""

from __future__ import annotations

import io
import re
import sys
import zipfile
from collections.abc import Iterator, Mapping, Sequence
from xml.etree import ElementTree

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martkit.sources.tabular import map_headers, require_columns

# the reader travels with its tasks: workers need no copy of the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Days from the first day of one date system to that of the other.
_LATER_SYSTEM = 1462
_MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"
_BATCH = 5_000


def _column_number(reference: str) -> int:
    number = 0
    for letter in re.match(r"[A-Z]+", reference).group():
        number = number * 26 + ord(letter) - 64
    return number - 1


def _first_sheet(book: zipfile.ZipFile) -> str:
    sheets = ElementTree.fromstring(book.read("xl/workbook.xml")).find(f"{_MAIN}sheets")
    wanted = sheets[0].get(_REL)
    for rel in ElementTree.fromstring(book.read("xl/_rels/workbook.xml.rels")):
        if rel.get("Id") == wanted:
            target = rel.get("Target")
            return target.lstrip("/") if target.startswith("/") else f"xl/{target}"
    raise ValueError("workbook without a first sheet")


def _texts(element) -> str:
    return "".join(t.text or "" for t in element.iter(f"{_MAIN}t"))


def _shared_texts(book: zipfile.ZipFile) -> list[str]:
    if "xl/sharedStrings.xml" not in book.namelist():
        return []
    out = []
    with book.open("xl/sharedStrings.xml") as part:
        for _, element in ElementTree.iterparse(part):
            if element.tag == f"{_MAIN}si":
                out.append(_texts(element))
                element.clear()
    return out


def _date_styles(book: zipfile.ZipFile) -> set[int]:
    """Numbers of the cell styles that show a date."""
    if "xl/styles.xml" not in book.namelist():
        return set()
    styles = ElementTree.fromstring(book.read("xl/styles.xml"))
    coded = {int(f.get("numFmtId")): f.get("formatCode", "") for f in styles.iter(f"{_MAIN}numFmt")}
    dates = {*range(14, 18), 22} | {n for n, code in coded.items() if re.search("[dy]", re.sub(r'"[^"]*"|\[[^\]]*\]|\\.', "", code), re.I)}
    cells = styles.find(f"{_MAIN}cellXfs")
    return {k for k, xf in enumerate(cells if cells is not None else ()) if int(xf.get("numFmtId", 0)) in dates}


def _counts_from_1904(book: zipfile.ZipFile) -> bool:
    about = ElementTree.fromstring(book.read("xl/workbook.xml")).find(f"{_MAIN}workbookPr")
    return about is not None and about.get("date1904") in ("1", "true")


def _cell_text(cell, shared: list[str], later: set[int]) -> str | None:
    """A cell as text: booleans in words, dates of either system as day numbers of the usual one, ISO dates as written."""
    kind, value = cell.get("t"), cell.find(f"{_MAIN}v")
    if kind == "inlineStr":
        return _texts(cell)
    if value is None or value.text is None or kind == "e":
        return None
    if kind == "s":
        return shared[int(value.text)]
    if kind == "b":
        return "true" if value.text == "1" else "false"
    if kind == "d":
        return value.text.split("T")[0]
    if kind in (None, "n") and int(cell.get("s", -1)) in later:
        return repr(float(value.text) + _LATER_SYSTEM)
    return value.text


def sheet_rows(file) -> Iterator[list[str | None]]:
    """Cell texts row by row of a path or of an open file; dates stay spreadsheet day numbers."""
    with zipfile.ZipFile(file) as book:
        shared = _shared_texts(book)
        later = _date_styles(book) if _counts_from_1904(book) else set()
        with book.open(_first_sheet(book)) as part:
            for _, element in ElementTree.iterparse(part):
                if element.tag != f"{_MAIN}row":
                    continue
                row: list[str | None] = []
                for cell in element.iter(f"{_MAIN}c"):
                    at = _column_number(cell.get("r")) if cell.get("r") else len(row)
                    row.extend([None] * (at + 1 - len(row)))
                    row[at] = _cell_text(cell, shared, later)
                yield row
                element.clear()


def _headers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, content in zip(batch.column("path"), batch.column("content")):
            first = next(sheet_rows(io.BytesIO(content.as_buffer())), None)
            yield pa.RecordBatch.from_arrays([pa.array([path.as_py()]), pa.array([first], pa.list_(pa.string()))], names=["path", "header"])


def headers(books: DataFrame) -> DataFrame:
    """``path, header``: the first row of each workbook of ``path, content``, null where it has none."""
    return books.select("path", "content").mapInArrow(_headers, "path string, header array<string>")


def _cells(targets: Sequence[str]):
    names = ["path", *targets]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content, at in zip(batch.column("path"), batch.column("content"), batch.column("at").to_pylist()):
                rows = sheet_rows(io.BytesIO(content.as_buffer()))
                next(rows, None)
                columns: list[list] = [[] for _ in targets]

                def full():
                    n = len(columns[0]) if columns else 0
                    return pa.RecordBatch.from_arrays([pa.array([path.as_py()] * n, pa.string()), *[pa.array(c, pa.string()) for c in columns]], names=names)

                for row in rows:
                    for column, k in zip(columns, at):
                        column.append(row[k] if 0 <= k < len(row) else None)
                    if len(columns[0]) >= _BATCH:
                        yield full()
                        columns = [[] for _ in targets]
                if columns[0]:
                    yield full()

    return work


def rows_of(books: DataFrame, aliases: Mapping[str, str], targets: Sequence[str], required: Sequence[str] = (), tag: str = "source_file") -> DataFrame:
    """Workbooks ``path, content`` with differing headers as one table of text columns, like ``read_harmonised``; ``tag`` is the
    last part of the path. Headers are read by tasks; the driver sees one for each workbook, and hands back where its wanted
    columns are, as a table to be joined."""
    positions = []
    for path, header in headers(books).collect():
        if header is None:
            raise ValueError(f"{path} holds no data")
        found = map_headers(header, aliases)
        require_columns(path, found, required, header)
        positions.append((path, [found.get(t, -1) for t in targets]))
    if not positions:
        raise ValueError("no workbooks")
    at = books.sparkSession.createDataFrame(positions, "path string, at array<int>")
    schema = ", ".join(f"`{n}` string" for n in ("path", *targets))
    rows = books.select("path", "content").join(F.broadcast(at), "path").mapInArrow(_cells(targets), schema)
    return rows.select(*targets, F.substring_index("path", "/", -1).alias(tag))


def read_workbooks(
    spark: SparkSession, paths: Sequence[str], aliases: Mapping[str, str], targets: Sequence[str], required: Sequence[str] = (), tag: str = "source_file"
) -> DataFrame:
    """``rows_of`` the workbooks in files, read through the file system of their paths."""
    return rows_of(spark.read.format("binaryFile").load(list(paths)).select("path", "content"), aliases, targets, required, tag)
