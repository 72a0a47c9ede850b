"""Rows and single values from HTML pages, by JVM regular expressions; tables by a parser.

A page is one row of a ``pages`` table; all its text is searched. Everything but the parser stays an expression
on that row, so pages are spread over tasks like any other rows.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martkit import labels
from martkit.functions.casts import locale_date, number_in_range
from martkit.functions.text import _col, squash, squeeze
from martkit.sources.tables import with_tables

_ROW = r"(?is)<tr\b[^>]*>(.*?)(?=</tr\s*>|<tr\b|$)"
_CELL = r"(?is)<t[hd]\b[^>]*>(.*?)(?=</t[hd]\s*>|<t[hd]\b|$)"
_TAG = r"(?s)<[^>]*>"
_HIDDEN = r"(?is)<(script|style)\b[^>]*>.*?</\1\s*>|<!--.*?-->"
_ENTITIES = (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&"))


def plain_text(c: Column | str) -> Column:
    """Tags become blanks, common entities their characters, whitespace is squeezed."""
    out = F.regexp_replace(_col(c), _TAG, " ")
    for entity, char in _ENTITIES:
        out = F.replace(out, F.lit(entity), F.lit(char))
    return squeeze(out)


def visible(html: Column | str) -> Column:
    """Page source without scripts, styles and comments."""
    return F.regexp_replace(_col(html), _HIDDEN, " ")


def _all(c: Column, pattern: str) -> Column:
    return F.regexp_extract_all(c, F.lit(pattern), F.lit(1))


def element_texts(html: Column | str, tag: str) -> Column:
    """Plain texts of all elements of one kind, in page order."""
    pattern = rf"(?is)<{tag}\b[^>]*>(.*?)</{tag}\s*>"
    return F.transform(_all(visible(html), pattern), plain_text)


def extract_prices(
    pages: DataFrame,
    html: str = "html",
    key: str = labels.FUEL_KEY,
    price_range: tuple[float, float] = labels.PRICE_RANGE,
) -> DataFrame:
    """(date, price) records of price tables with their position on the page.

    Per table: the column whose squashed header holds ``key``, else the second column when the first one has
    at least two dates. A page without any record that way gives every two-cell row that starts with a date.
    Columns are those of the grid, with spans filled in; the two-cell rows are taken as written.
    """
    low, high = price_range

    def price(cell: Column) -> Column:
        return number_in_range(cell, low, high)

    def named_column(header: Column) -> Column:
        return F.array_position(F.transform(header, lambda h: squash(h).contains(key)), True).cast("int")

    def day(cells: Column) -> Column:
        return F.when(F.size(cells) >= 2, locale_date(squeeze(F.get(cells, F.lit(0))), labels.MONTH_NUMBERS))

    def dated_rows(rows: Column) -> Column:
        return F.filter(
            F.transform(rows, lambda row, i: F.struct(
                i.alias("row_no"), day(row["cells"]).alias("date"), day(row["plain"]).alias("plain_date"),
                F.transform(row["cells"], squeeze).alias("cells"), F.transform(row["plain"], squeeze).alias("plain"),
            )),
            lambda r: r["date"].isNotNull() | r["plain_date"].isNotNull(),
        )

    def records(table: Column, table_no: Column) -> Column:
        def record(row: Column) -> Column:
            second = price(F.get(row["cells"], F.lit(1)))
            by_name = price(F.get(row["cells"], table["named_at"] - 1))
            dated = F.size(F.filter(table["rows"], lambda r: r["date"].isNotNull()))
            primary = F.when(row["date"].isNotNull(), F.when(table["named_at"] > 0, by_name).when(dated >= 2, second))
            written = F.when(row["plain_date"].isNotNull(), price(F.get(row["plain"], F.lit(1))))
            return F.struct(
                table_no.alias("table_no"), row["row_no"].alias("row_no"), row["date"].alias("grid_date"), row["plain_date"].alias("plain_date"),
                primary.alias("primary"), written.alias("second"),
            )

        return F.transform(table["rows"], record)

    others = [c for c in pages.columns if c != html]
    tables = F.transform("_tables", lambda t: F.struct(
        named_column(t["header"]).alias("named_at"), dated_rows(t["rows"]).alias("rows")
    ))
    all_records = with_tables(pages, html, "_tables").select(*others, F.flatten(F.transform(tables, records)).alias("records"))
    found = all_records.withColumn("is_found", F.exists("records", lambda r: r["primary"].isNotNull()))
    rows = found.select(*others, "is_found", F.inline("records"))
    rows = rows.withColumn("date", F.when(F.col("is_found"), F.col("grid_date")).otherwise(F.col("plain_date")))
    chosen = F.when(F.col("is_found"), F.col("primary")).otherwise(F.col("second"))
    return rows.select(*others, "table_no", "row_no", "date", chosen.alias("price")).where("price is not null")


def extract_price(
    html: Column | str,
    names: Sequence[str] = labels.FUEL_NAMES,
    price_range: tuple[float, float] = labels.PRICE_RANGE,
) -> Column:
    """Price of the first table row whose name is known and whose price is valid, else from the page text."""
    low, high = price_range
    rows = _all(visible(html), _ROW)
    cells = F.transform(rows, lambda r: F.transform(_all(r, _CELL), plain_text))
    hits = F.transform(
        F.filter(cells, lambda r: (F.size(r) >= 2) & F.lower(F.get(r, F.lit(0))).isin(*names)),
        lambda r: number_in_range(F.get(r, F.lit(1)), low, high),
    )
    first = F.get(F.filter(hits, lambda p: p.isNotNull()), F.lit(0))
    return F.coalesce(first, number_in_range(number_after(plain_text(visible(html)), names), low, high))


def number_after(text: Column, names: Sequence[str]) -> Column:
    """The number that follows the first of the names to be followed by one; blanks or bars stand between."""
    behind = F.slice(F.split(F.lower(text), "|".join(map(re.escape, names))), 2, 1 << 30)
    parted = F.filter(behind, lambda t: F.left(t, F.lit(1)).isin(" ", "|"))
    numbers = F.transform(parted, lambda t: F.regexp_extract(F.ltrim(t, F.lit(" |")), r"^[0-9]+([.][0-9]+)?", 0))
    return F.get(F.filter(numbers, lambda n: n != ""), F.lit(0))
