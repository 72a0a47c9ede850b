"""Measures and visuals over star schemas built from the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from martkit.catalog import half_up_sql, query
from martkit.catalog.marts import ITEM_FACT_SQL, QUANTITY_BANDS, item_fact, order_fact, order_sql
from martkit.operators import star
from martkit.operators.calendar import calendar_dimension, month_dimension
from martkit.operators.marts import with_share
from martkit.operators.windows import calendar_average
from martkit.operators.star import Dimension, Star
from martkit.session import scratch_path

_ORDERS = """SELECT CAST(o_orderdate AS DATE) AS day, n_name AS nation, c_mktsegment AS segment, o_orderstatus AS status,
    o_orderpriority AS priority, count(*) AS n
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY ALL"""


def order_star(t) -> Star:
    nations = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.lower("n_name").alias("nation"), F.col("r_name").alias("region")
    )
    return Star(order_fact(t), {
        "calendar": Dimension(calendar_dimension(t.orders, "o_orderdate"), "day", "day"),
        "nation": Dimension(nations, "nation", "nation", fold_case=True),
    })


def item_star(t) -> Star:
    return Star(item_fact(t), {
        "month": Dimension(month_dimension(t.lineitem, "l_shipdate"), "month", "month"),
        "band": Dimension(QUANTITY_BANDS.table(t.spark, "band"), "band", "band"),
    })


@query("star_totals", f"""
    WITH f AS ({_ORDERS}), d AS (SELECT day, sum(n) AS s FROM f GROUP BY 1)
    SELECT CAST(sum(n) AS BIGINT) AS total, count(DISTINCT nation) AS nations,
           (SELECT day FROM d ORDER BY s DESC, day DESC LIMIT 1) AS peak_day FROM f""")
def star_totals(t):
    model = order_star(t)
    cards = model.query({"total": star.total("n"), "nations": star.distinct_labels("nation", fold_case=True)})
    return cards.withColumn("peak_day", star.peak_day(model.fact, "day", "n").select("peak_day").scalar())


_ITEMS = f"""
    WITH f AS ({ITEM_FACT_SQL})
    SELECT {{keys}} CAST(sum(n) AS BIGINT) AS total, max(max_price) AS max_price, count(DISTINCT flag) AS flags,
           CAST(sum(n) FILTER (band IN ('30-39', '40+')) AS BIGINT) AS strong,
           CAST(sum(CAST(round(avg_quantity * 10) AS BIGINT) * n) AS DOUBLE) / 10 / sum(n) AS weighted_quantity,
           CAST(sum(n) FILTER (band IN ('30-39', '40+')) AS DOUBLE) / sum(n) AS strong_share FROM f {{group}}"""


def _item_measures():
    strong, all_rows = star.total_in("n", "band", QUANTITY_BANDS.labels[-2:]), star.total("n")
    return {
        "total": all_rows, "max_price": star.largest("max_price"), "flags": star.distinct_labels("flag", fold_case=True),
        "strong": strong, "weighted_quantity": star.weighted_mean("avg_quantity", "n"),
        "strong_share": star.safe_share(strong, all_rows),
    }


@query("star_measures", _ITEMS.format(keys="", group=""))
def star_measures(t):
    return item_star(t).query(_item_measures())


@query("star_measures_by_year", _ITEMS.format(keys="CAST(year(month) + 543 AS INTEGER) AS year_be,", group="GROUP BY 1"))
def star_measures_by_year(t):
    return item_star(t).query(_item_measures(), by={"year_be": ("month", "year_be")})


@query("slicer_years", f"""
    WITH f AS ({_ORDERS})
    SELECT nation, CAST(sum(n) AS BIGINT) AS total FROM f WHERE year(day) + 543 IN (2540, 2541) GROUP BY 1""")
def slicer_years(t):
    return order_star(t).query(
        {"total": star.total("n")}, by={"nation": ("", "nation")},
        slicers={"calendar": F.col("year_be").isin(2540, 2541)},
    )


def stored_order_star(t) -> Star:
    """The order star over a fact stored by month: its calendar is made of the fact's own days."""
    fact = star.store_by_month(order_fact(t), scratch_path(t.spark, "order-fact"), "day")
    calendar = Dimension(calendar_dimension(fact.select("day"), "day"), "day", "day", part=("month", "year_month"))
    return Star(fact, order_star(t).relations | {"calendar": calendar})


@query("slicer_stored", f"""
    WITH f AS ({_ORDERS})
    SELECT nation, CAST(sum(n) AS BIGINT) AS total FROM f WHERE year(day) + 543 IN (2540, 2541) GROUP BY 1""")
def slicer_stored(t):
    """The slicer of ``slicer_years`` on the stored fact, of which it only reads the months that it chooses."""
    return stored_order_star(t).query(
        {"total": star.total("n")}, by={"nation": ("", "nation")}, slicers={"calendar": F.col("year_be").isin(2540, 2541)}
    )


@query("visual_line_daily", f"""
    WITH f AS ({_ORDERS}), d AS (SELECT day, sum(n) AS total FROM f GROUP BY 1),
    s AS (SELECT CAST(unnest(generate_series(min(o_orderdate), max(o_orderdate), INTERVAL 1 DAY)) AS DATE) AS day FROM orders)
    SELECT s.day, CAST(d.total AS BIGINT) AS total,
           CAST(coalesce(sum(d.total) OVER (ORDER BY s.day RANGE BETWEEN INTERVAL 6 DAY PRECEDING AND CURRENT ROW), 0) AS DOUBLE) / 7 AS avg_7d
    FROM s LEFT JOIN d ON s.day = d.day""")
def visual_line_daily(t):
    model = order_star(t)
    daily = model.query({"total": star.total("n")}, by={"day": ("calendar", "day")})
    spine = model.relations["calendar"].table.select("day")
    return calendar_average(daily, spine, "total", name="avg_7d").join(daily, "day", "left").orderBy("day")


@query("visual_line_monthly", f"""
    WITH f AS ({ITEM_FACT_SQL}) SELECT strftime(month, '%Y-%m') AS year_month, CAST(sum(n) AS BIGINT) AS total FROM f GROUP BY 1""")
def visual_line_monthly(t):
    return item_star(t).query(
        {"total": star.total("n")}, by={"year_month": ("month", "year_month")}, order=[F.col("year_month")]
    )


@query("visual_bar_region", f"""
    WITH f AS ({_ORDERS})
    SELECT r_name AS region, CAST(sum(n) AS BIGINT) AS total FROM f JOIN nation ON nation = n_name
    JOIN region ON n_regionkey = r_regionkey GROUP BY 1""")
def visual_bar_region(t):
    return order_star(t).query({"total": star.total("n")}, by={"region": ("nation", "region")}, order=[F.desc("total")])


@query("visual_column_band", f"""
    WITH f AS ({ITEM_FACT_SQL})
    SELECT band, {order_sql('band', QUANTITY_BANDS)} AS sort_order, CAST(sum(n) AS BIGINT) AS total FROM f GROUP BY 1""")
def visual_column_band(t):
    by = {"band": ("band", "band"), "sort_order": ("band", "sort_order")}
    return item_star(t).query({"total": star.total("n")}, by=by, order=[F.col("sort_order")])


@query("visual_donut_status", f"""
    WITH f AS ({_ORDERS}), m AS (SELECT status, CAST(sum(n) AS BIGINT) AS total FROM f GROUP BY 1)
    SELECT status, total, {half_up_sql('100 * total', 'sum(total) OVER ()', 0, 2)} AS share_pct FROM m""")
def visual_donut_status(t):
    parts = order_star(t).query({"total": star.total("n")}, by={"status": ("", "status")})
    return with_share(parts, "total", 2)
