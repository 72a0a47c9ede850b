"""HTML extraction: items of the test pages, and price tables that Spark renders from daily means."""

from __future__ import annotations

from pyspark.sql import functions as F

from martkit import labels
from martkit.catalog import mean_sql, query
from martkit.functions.numbers import fixed_mean
from martkit.operators.dedupe import keep_last
from martkit.operators.windows import daily_series
from martkit.sources import html


def _no_tags(text: str) -> str:
    """SQL for the plain text of a markup fragment."""
    out = f"regexp_replace({text}, '<[^>]*>', ' ', 'gs')"
    for entity, char in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&amp;", "&")):
        out = f"replace({out}, '{entity}', '{char}')"
    return f"trim(regexp_replace({out}, '[\\s\\x{{00A0}}\\x{{2000}}-\\x{{200A}}\\x{{3000}}]+', ' ', 'g'))"


_VISIBLE = """regexp_replace(regexp_replace(regexp_replace(html, '<script\\b[^>]*>.*?</script\\s*>', ' ', 'gsi'),
    '<style\\b[^>]*>.*?</style\\s*>', ' ', 'gsi'), '<!--.*?-->', ' ', 'gs')"""


@query("html_items", f"""
    WITH i AS (SELECT page_id, regexp_extract_all({_VISIBLE}, '(?is)<li\\b[^>]*>(.*?)</li\\s*>', 1) AS items FROM pages),
    u AS (SELECT page_id, unnest(items) AS item, generate_subscripts(items, 1) - 1 AS position FROM i)
    SELECT page_id, CAST(position AS INTEGER) AS position, {_no_tags('item')} AS item FROM u""")
def html_items(t):
    return t.pages.select("page_id", F.posexplode(html.element_texts("html", "li")).alias("position", "item"))


@query("html_titles", f"""
    SELECT page_id, {_no_tags("regexp_extract(html, '(?is)<title\\b[^>]*>(.*?)</title\\s*>', 1)")} AS title FROM pages""")
def html_titles(t):
    return t.pages.select("page_id", F.get(html.element_texts("html", "title"), F.lit(0)).alias("title"))


_DAILY = f"""SELECT event_type, CAST(ts AS DATE) AS date, {mean_sql('value', 2)} AS mean FROM events GROUP BY 1, 2"""


def _daily(t):
    price = fixed_mean("value", 2).cast("double")
    return daily_series(t.events, "ts", ["event_type"], measures={"mean": price}, name="date")


def _era_date(date):
    return F.concat_ws("/", F.date_format(date, "dd/MM"), (F.year(date) + 543).cast("string"))


def _row(*cells):
    return F.concat(F.lit("<tr>"), *[F.concat(F.lit("<td> "), c, F.lit(" </td>")) for c in cells], F.lit("</tr>\n"))


def _price_pages(t):
    """One page per event type and month of days. Two types name the price column, two have no header, one
    puts every day in a table of its own, which only the fallback reads."""
    price = F.col("mean").cast("decimal(12,2)").cast("string")
    named = F.col("event_type").isin("click", "view")
    single = F.col("event_type") == "error"
    row = F.when(named, _row(_era_date("date"), F.lit("note"), F.concat(price, F.lit(" baht")))).otherwise(
        _row(_era_date("date"), price, F.lit("note"))
    )
    row = F.when(single, F.concat(F.lit("<table>"), row, F.lit("</table>"))).otherwise(row)
    # at most one row per calendar day of a month is put together on a page
    pages = _daily(t).groupBy("event_type", F.trunc("date", "MM").alias("month")).agg(
        F.concat_ws("", F.transform(F.array_sort(F.collect_list(F.struct("date", row.alias("row")))), lambda r: r["row"])).alias("rows"),
    )
    head = F.lit("<tr><th>Date</th><th>Note</th><th>Gasohol <b>95</b></th></tr>")
    body = F.when(single, F.col("rows")).when(
        named, F.concat(F.lit('<table class="p">'), head, "rows", F.lit("</table>"))
    ).otherwise(F.concat(F.lit("<TABLE><tbody>"), "rows", F.lit("</tbody></TABLE>")))
    page = F.concat(F.lit("<html><body><script>var t='<table>';</script><p>20</p>"), body, F.lit("</body></html>"))
    return pages.select("event_type", "month", page.alias("html"))


@query("html_price_tables", f"""
    SELECT event_type, date, mean AS price FROM ({_DAILY}) WHERE mean BETWEEN 20 AND 80""")
def html_price_tables(t):
    records = html.extract_prices(_price_pages(t))
    return keep_last(records, ["event_type", "date"], ["table_no", "row_no"]).select("event_type", "date", "price")


@query("html_single_price", f"""
    SELECT event_type, date, CASE WHEN mean BETWEEN 20 AND 80 THEN mean END AS price FROM ({_DAILY})""")
def html_single_price(t):
    """One page per day: a known name in a table row, or only in the text."""
    price = F.col("mean").cast("decimal(12,2)").cast("string")
    table = F.concat(
        F.lit("<table><tr><th>fuel</th><th>price</th></tr><tr><td>Gasohol 91</td><td>30.00</td></tr><tr><td> GASOHOL&nbsp; 95 </td><td>"),
        price, F.lit("</td></tr></table>"),
    )
    text = F.concat(F.lit(f"<p>{labels.FUEL_NAMES[0]} | "), price, F.lit(" </p>"))
    page = F.when(F.col("event_type").isin("click", "view"), table).otherwise(text)
    return _daily(t).select("event_type", "date", html.extract_price(page).alias("price"))
