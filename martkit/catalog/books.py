"""Sources that lie in whole files: workbooks, expected files and columns, with what is missing."""

from __future__ import annotations

import io
import sys
import zipfile
from collections.abc import Iterator
from xml.sax.saxutils import escape

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import functions as F

from martkit import labels
from martkit.catalog import query
from martkit.functions.casts import lenient_date, lenient_long
from martkit.session import scratch_path
from martkit.sinks.writers import _file_system
from martkit.sources import tabular, workbook

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def book(rows: list[list], later: bool) -> bytes:
    """A workbook of one sheet: texts inline, numbers, and dates as day numbers of the earlier or the later date system."""
    main = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    rel = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    first = pd.Timestamp("1904-01-01" if later else "1899-12-30")

    def cell(value) -> str:
        if value is None:
            return "<c/>"
        if isinstance(value, str):
            return f'<c t="inlineStr"><is><t xml:space="preserve">{escape(value)}</t></is></c>'
        if isinstance(value, pd.Timestamp):
            return f'<c s="1"><v>{(value - first).days}</v></c>'
        return f"<c><v>{value}</v></c>"

    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as file:
        about = '<workbookPr date1904="1"/>' if later else ""
        file.writestr("xl/workbook.xml", f'<workbook {main} xmlns:r="{rel}">{about}<sheets><sheet name="s" sheetId="1" r:id="r1"/></sheets></workbook>')
        file.writestr("xl/_rels/workbook.xml.rels", '<Relationships><Relationship Id="r1" Target="worksheets/sheet1.xml"/></Relationships>')
        file.writestr("xl/styles.xml", f'<styleSheet {main}><cellXfs><xf numFmtId="0"/><xf numFmtId="14"/></cellXfs></styleSheet>')
        lines = "".join(f"<row>{''.join(map(cell, row))}</row>" for row in rows)
        file.writestr("xl/worksheets/sheet1.xml", f"<worksheet {main}><sheetData>{lines}</sheetData></worksheet>")
    return out.getvalue()


def _books(frames: Iterator[pd.DataFrame] | pd.DataFrame) -> pd.DataFrame:
    rows = frames.sort_values("o_orderkey")
    month, status = rows["month"].iloc[0], rows["status"].iloc[0]
    days = rows["o_orderdate"].dt.normalize()
    if status == "F":
        table = [["No.", "announce date", "risk"], *([k, d, p] for k, d, p in zip(rows["o_orderkey"].tolist(), days, rows["o_orderpriority"]))]
    else:
        table = [["Announce  Date", None, "no"], *([d, "x", k] for k, d in zip(rows["o_orderkey"].tolist(), days))]
    return pd.DataFrame({"path": [f"{status}/{month}.xlsx"], "content": [book(table, later=status != "F")]})


@query("workbook_rows", """
    SELECT o_orderkey AS case_no, CAST(o_orderdate AS DATE) AS announce_date, CASE WHEN o_orderstatus = 'F' THEN o_orderpriority END AS risk,
           strftime(o_orderdate, '%Y-%m') || '.xlsx' AS source_file FROM orders""")
def workbook_rows(t):
    """A workbook for each month and kind of status, those of the kinds with the same names: two header layouts, two date
    systems."""
    kind = F.when(F.col("o_orderstatus") == "F", "F").otherwise("other").alias("status")
    orders = t.orders.select("o_orderkey", "o_orderdate", "o_orderpriority", F.date_format("o_orderdate", "yyyy-MM").alias("month"), kind)
    path = scratch_path(t.spark, "books")
    orders.groupBy("month", "status").applyInPandas(_books, "path string, content binary").write.parquet(path)
    found = workbook.rows_of(t.spark.read.parquet(path), labels.CASE_HEADERS, ["case_no", "announce_date", "risk"], labels.CASE_REQUIRED)
    return found.select(lenient_long("case_no").alias("case_no"), lenient_date("announce_date", serial_numbers=True).alias("announce_date"), "risk", "source_file")


@query("expected_files", """
    SELECT n_name || '.csv' AS file_name, c.k IS NOT NULL AS found FROM nation
    LEFT JOIN (SELECT DISTINCT c_nationkey AS k FROM customer WHERE c_nationkey % 5 <> 3) c ON n_nationkey = c.k""")
def expected_files(t):
    """One file is expected for each nation; those of every fifth have not come. The check says which."""
    root = scratch_path(t.spark, "files")
    customers = t.customer.where("c_nationkey % 5 <> 3").join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    customers.select("n_name", "c_custkey").repartition("n_name").write.partitionBy("n_name").option("header", "true").csv(f"{root}/parts")
    fs, target = _file_system(t.spark, f"{root}/landed")
    fs.mkdirs(target)
    for r in tabular.list_files(t.spark, f"{root}/parts", "*.csv").collect():  # each nation's one file, under its name
        nation = r.path.split("n_name=")[1].split("/")[0]
        fs.rename(t.spark._jvm.org.apache.hadoop.fs.Path(r.path), t.spark._jvm.org.apache.hadoop.fs.Path(f"{root}/landed/{nation}.csv"))
    names = t.nation.select(F.concat("n_name", F.lit(".csv")).alias("file_name"))
    return tabular.file_report(t.spark, f"{root}/landed", names).select("file_name", "found")


@query("missing_columns", """
    SELECT DISTINCT CASE WHEN o_orderstatus IS NOT DISTINCT FROM 'P' THEN 'p' WHEN o_orderstatus IS NOT DISTINCT FROM 'F' THEN 'f' ELSE 'rest' END AS layout,
           CASE WHEN o_orderstatus IS NOT DISTINCT FROM 'F' THEN 'case_no' WHEN o_orderstatus IS NOT DISTINCT FROM 'P' THEN '' ELSE 'case_no,announce_date' END AS missing FROM orders""")
def missing_columns(t):
    """What the headers of three layouts lack of the required columns."""
    root, named = scratch_path(t.spark, "columns"), [F.col("o_orderstatus").eqNullSafe(s) for s in ("P", "F")]
    layouts = {"p": (named[0], ["No.", "announce date"]), "f": (named[1], ["Announce Date", "x"]), "rest": (~(named[0] | named[1]), ["number", "risk"])}
    for name, (own, columns) in layouts.items():
        rows = t.orders.where(own).select(F.col("o_orderkey").alias(columns[0]), F.col("o_orderpriority").alias(columns[1]))
        rows.write.option("header", "true").csv(f"{root}/{name}")
    report = tabular.column_report(t.spark, [f"{root}/{name}" for name in layouts], labels.CASE_HEADERS, labels.CASE_REQUIRED)
    layout = F.element_at(F.split("path", "/"), -2)
    return report.select(layout.alias("layout"), F.array_join("missing", ",").alias("missing")).distinct()
