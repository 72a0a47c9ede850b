"""Queries over daily and monthly series."""

from __future__ import annotations

from pyspark.sql import functions as F

from martkit.catalog import half_up_sql, mean_sql, query
from martkit.functions.numbers import fixed_mean
from martkit.operators import calendar, windows
from martkit.operators.calendar import day_spine

_DAILY = "SELECT CAST(ts AS DATE) AS day, count(*) AS n FROM events GROUP BY 1"
_ROWS7 = "ROWS BETWEEN 6 PRECEDING AND CURRENT ROW"
_DAYS7 = "RANGE BETWEEN INTERVAL 6 DAY PRECEDING AND CURRENT ROW"


@query("daily_moving_avg", f"""
    WITH d AS ({_DAILY})
    SELECT day, n, {half_up_sql('sum(n) OVER w', 'count(n) OVER w', 0, 1)} AS moving_avg
    FROM d WINDOW w AS (ORDER BY day {_ROWS7})""")
def daily_moving_avg(t):
    return windows.moving_average_rows(windows.daily_series(t.events, "ts"), "n").orderBy("day")


@query("daily_moving_avg_by_type", f"""
    WITH d AS (SELECT event_type, CAST(ts AS DATE) AS day, count(*) AS n FROM events GROUP BY 1, 2)
    SELECT event_type, day, n, {half_up_sql('sum(n) OVER w', 'count(n) OVER w', 0, 1)} AS moving_avg
    FROM d WINDOW w AS (PARTITION BY event_type ORDER BY day {_ROWS7})""")
def daily_moving_avg_by_type(t):
    daily = windows.daily_series(t.events, "ts", ["event_type"])
    return windows.moving_average_rows(daily, "n", series=["event_type"])


_ORDER_DAYS = "SELECT CAST(o_orderdate AS DATE) AS day, count(*) AS n FROM orders GROUP BY 1"
_ORDER_SPINE = """SELECT CAST(unnest(generate_series(min(o_orderdate), max(o_orderdate), INTERVAL 1 DAY)) AS DATE) AS day
    FROM orders"""
_CALENDAR_AVG = f"""
    WITH d AS ({_ORDER_DAYS}), s AS ({_ORDER_SPINE})
    SELECT s.day, CAST(coalesce(sum(n) OVER (ORDER BY s.day {_DAYS7}), 0) AS DOUBLE) / 7 AS calendar_avg
    FROM s LEFT JOIN d ON s.day = d.day"""


def _order_days(t):
    return windows.daily_series(t.orders, "o_orderdate")


@query("calendar_7d_avg", _CALENDAR_AVG)
def calendar_7d_avg(t):
    daily = _order_days(t)  # the bounds come from the days, whose exchange is used again, not from the raw rows
    return windows.calendar_average(daily, day_spine(daily, "day"), "n")


@query("calendar_7d_avg_in_year", f"SELECT * FROM ({_CALENDAR_AVG}) WHERE year(day) + 543 = 2540")
def calendar_7d_avg_in_year(t):
    daily = _order_days(t)
    full = windows.calendar_average(daily, day_spine(daily, "day"), "n")
    return full.where(F.year("day") + 543 == 2540)


@query("seven_day_avg_present", f"""
    WITH d AS (SELECT o_orderpriority AS priority, CAST(o_orderdate AS DATE) AS day, count(*) AS n FROM orders GROUP BY 1, 2)
    SELECT priority, day, n, {half_up_sql('sum(n) OVER w', 'count(n) OVER w', 0, 6)} AS present_avg
    FROM d WINDOW w AS (PARTITION BY priority ORDER BY day {_DAYS7})""")
def seven_day_avg_present(t):
    orders = t.orders.withColumnRenamed("o_orderpriority", "priority")
    daily = windows.daily_series(orders, "o_orderdate", ["priority"])
    return windows.present_average(daily, "n", series=["priority"])


_PRICES = f"""SELECT event_type, CAST(ts AS DATE) AS day, {mean_sql('value', 4)} AS price FROM events GROUP BY 1, 2"""
_LAGS = ", ".join(f"lag(price, {k}) OVER w AS lag_{k}" for k in range(1, 6))
_LAG_MEAN = "(lag_1 + lag_2 + lag_3 + lag_4 + lag_5) / 5"
LAG_SQL = f"""
    WITH p AS ({_PRICES}), l AS (SELECT *, {_LAGS} FROM p WINDOW w AS (PARTITION BY event_type ORDER BY day))
    SELECT *, {_LAG_MEAN} AS lag_mean FROM l WHERE lag_5 IS NOT NULL"""


def daily_prices(t):
    """Daily mean value per event type: the price history of the test tables."""
    price = fixed_mean("value", 4).cast("double")
    return windows.daily_series(t.events, "ts", ["event_type"], measures={"price": price})


@query("lag_features", LAG_SQL)
def lag_features(t):
    return windows.lag_features(daily_prices(t), "price", series=["event_type"])


@query("latest_features", f"""
    WITH p AS ({_PRICES}), r AS (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY day DESC) AS k FROM p),
    w AS (SELECT event_type, max(day) AS latest_day, count(*) AS c,
          {', '.join(f'max(price) FILTER (k = {k}) AS lag_{k}' for k in range(1, 6))}
          FROM r WHERE k <= 5 GROUP BY 1)
    SELECT * EXCLUDE (c), {_LAG_MEAN} AS lag_mean FROM w WHERE c = 5""")
def latest_features(t):
    return windows.latest_features(daily_prices(t), "price", series=["event_type"])


@query("ordered_holdout", f"""
    WITH f AS ({LAG_SQL})
    SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY day DESC) <= 5 AS is_holdout FROM f""")
def ordered_holdout(t):
    return windows.ordered_holdout(lag_features(t), series=["event_type"])


_MARKERS = f"""
    WITH d AS ({_ORDER_DAYS}),
    p AS (SELECT day, year(day) AS y, row_number() OVER (ORDER BY day) - 1 AS position,
          lag(year(day)) OVER (ORDER BY day) AS prev FROM d)
    SELECT day, CAST(y AS INTEGER) AS year_ce, CAST(position AS INTEGER) AS position,
           CAST(y + 543 AS INTEGER) AS year_be
    FROM p WHERE y IS DISTINCT FROM prev"""


@query("year_markers", _MARKERS)
def year_markers(t):
    return windows.year_markers(_order_days(t))


@query("year_markers_alternate", f"""
    WITH m AS ({_MARKERS})
    SELECT * FROM m QUALIFY (row_number() OVER (ORDER BY day) - 1) % 2 = 0""")
def year_markers_alternate(t):
    return windows.year_markers(_order_days(t), every=2)


def _peaks_sql(placed: str, key: str, order: str, apart: int) -> str:
    """Three rounds of "largest remaining", written out."""
    pick = f"QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY n DESC, position) = 1"
    far = f"abs(d.position - {{0}}.position) > {apart}"
    return f"""
    WITH d AS ({placed}),
    p1 AS (SELECT * FROM d {pick}),
    p2 AS (SELECT d.* FROM d JOIN p1 USING ({key}) WHERE {far.format('p1')}
           QUALIFY row_number() OVER (PARTITION BY d.{key} ORDER BY d.n DESC, d.position) = 1),
    p3 AS (SELECT d.* FROM d JOIN p1 USING ({key}) JOIN p2 USING ({key})
           WHERE {far.format('p1')} AND {far.format('p2')}
           QUALIFY row_number() OVER (PARTITION BY d.{key} ORDER BY d.n DESC, d.position) = 1)
    SELECT {key}, {order}, n, CAST(position AS INTEGER) AS position
    FROM (FROM p1 UNION ALL FROM p2 UNION ALL FROM p3)"""


@query("peak_days", _peaks_sql("""
    SELECT *, row_number() OVER (PARTITION BY status ORDER BY day) - 1 AS position FROM (
    SELECT o_orderstatus AS status, CAST(o_orderdate AS DATE) AS day, count(*) AS n FROM orders GROUP BY 1, 2)""",
    "status", "day", 45))
def peak_days(t):
    orders = t.orders.withColumnRenamed("o_orderstatus", "status")
    return windows.peaks(windows.daily_series(orders, "o_orderdate", ["status"]), "n", series=["status"])


@query("peak_months", _peaks_sql("""
    SELECT *, row_number() OVER (PARTITION BY flag ORDER BY month) - 1 AS position FROM (
    SELECT l_returnflag AS flag, CAST(date_trunc('month', l_shipdate) AS DATE) AS month, count(*) AS n
    FROM lineitem GROUP BY 1, 2)""", "flag", "month", 10))
def peak_months(t):
    items = t.lineitem.withColumnRenamed("l_returnflag", "flag")
    monthly = windows.monthly_series(items, "l_shipdate", ["flag"])
    return windows.peaks(monthly, "n", "month", ["flag"], apart=10)


# Rows of every fifth day (fourth month) are dated a day (month) earlier: gaps in series of all rows.
@query("missing_days", """
    WITH d AS (SELECT DISTINCT CASE WHEN day(o_orderdate) % 5 = 0 THEN CAST(o_orderdate AS DATE) - 1 ELSE CAST(o_orderdate AS DATE) END AS day FROM orders),
    s AS (SELECT CAST(unnest(generate_series(min(day), max(day), INTERVAL 1 DAY)) AS DATE) AS day FROM d)
    SELECT day FROM s WHERE day NOT IN (SELECT day FROM d)""")
def missing_days(t):
    day = F.to_date("o_orderdate")
    moved = F.when(F.dayofmonth(day) % 5 == 0, F.date_sub(day, 1)).otherwise(day)
    return calendar.missing_days(windows.daily_series(t.orders.select(moved.alias("day")), "day"))


@query("missing_months", """
    WITH m AS (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month FROM orders),
    d AS (SELECT DISTINCT CASE WHEN month(month) % 4 = 0 THEN CAST(month - INTERVAL 1 MONTH AS DATE) ELSE month END AS month FROM m),
    s AS (SELECT CAST(unnest(generate_series(min(month), max(month), INTERVAL 1 MONTH)) AS DATE) AS month FROM d)
    SELECT month FROM s WHERE month NOT IN (SELECT month FROM d)""")
def missing_months(t):
    month = F.trunc(F.to_date("o_orderdate"), "MM")
    moved = F.when(F.month(month) % 4 == 0, F.add_months(month, -1)).otherwise(month)
    return calendar.missing_months(windows.monthly_series(t.orders.select(moved.alias("day")), "day"))


_MONTH_NAMES = "['ม.ค.','ก.พ.','มี.ค.','เม.ย.','พ.ค.','มิ.ย.','ก.ค.','ส.ค.','ก.ย.','ต.ค.','พ.ย.','ธ.ค.']"
_DAY_NAMES = "['จันทร์','อังคาร','พุธ','พฤหัสบดี','ศุกร์','เสาร์','อาทิตย์']"


def _attributes_sql(day: str) -> str:
    return f"""CAST(year({day}) AS INTEGER) AS year_ce, CAST(year({day}) + 543 AS INTEGER) AS year_be,
    CAST(month({day}) AS INTEGER) AS month_no, {_MONTH_NAMES}[month({day})] AS month_name,
    strftime({day}, '%Y-%m') AS year_month, CAST(quarter({day}) AS INTEGER) AS quarter"""


@query("calendar_dim", f"""
    WITH s AS ({_ORDER_SPINE})
    SELECT day, {_attributes_sql('day')}, {_DAY_NAMES}[isodow(day)] AS weekday,
           CASE WHEN isodow(day) >= 6 THEN 'TRUE' ELSE 'FALSE' END AS is_weekend FROM s""")
def calendar_dim(t):
    return calendar.calendar_dimension(t.orders, "o_orderdate")


@query("month_dim", f"""
    WITH s AS (SELECT CAST(unnest(generate_series(date_trunc('month', min(l_shipdate)),
               date_trunc('month', max(l_shipdate)), INTERVAL 1 MONTH)) AS DATE) AS month FROM lineitem)
    SELECT month, {_attributes_sql('month')} FROM s""")
def month_dim(t):
    return calendar.month_dimension(t.lineitem, "l_shipdate")
