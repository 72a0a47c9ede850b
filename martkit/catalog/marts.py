"""Roll-up, share, ranking and filter queries."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from martkit.catalog import half_up_sql, mean_sql, query, units_sql
from martkit.functions.bands import Bands
from martkit.functions.dates import month_start, wall_time
from martkit.functions.numbers import fixed_mean, fixed_sum
from martkit.operators import distinct, marts, ranking, windows
from martkit.operators.calendar import band_dimension, entity_dimension
from martkit.session import scratch_path
from martkit.sources.tabular import read_table
from martkit.streaming.incremental import ingest_totals


VALUE_BANDS = Bands((2, 5, 10, 50, 100, 300), ("<2", "2-5", "5-10", "10-50", "50-100", "100-300", "300+"), "unspecified")
SIZE_BANDS = Bands((10, 20, 30, 40), ("0-9", "10-19", "20-29", "30-39", "40+"), "unspecified")
DEPTH_LIKE = Bands((70, 300), ("shallow", "middle", "deep"), "unspecified")


def bands_sql(column: str, bands: Bands) -> str:
    arms = " ".join(f"WHEN {column} < {e} THEN '{n}'" for e, n in zip(bands.edges, bands.labels))
    return f"CASE WHEN {column} IS NULL THEN '{bands.null_label}' {arms} ELSE '{bands.labels[-1]}' END"


def order_sql(column: str, bands: Bands) -> str:
    arms = " ".join(f"WHEN '{n}' THEN {i}" for i, n in enumerate(bands.labels, 1))
    return f"CASE {column} {arms} ELSE {len(bands.labels) + 1} END"


@query("order_summary", f"""
    SELECT count(*) AS total, CAST(min(o_orderdate) AS DATE) AS first_date, CAST(max(o_orderdate) AS DATE) AS last_date,
           {mean_sql('o_totalprice', 1)} AS avg_price, count(DISTINCT o_custkey) AS customers FROM orders""")
def order_summary(t):
    day = F.to_date("o_orderdate")
    return marts.summarise(t.orders, {
        "total": marts.n_rows(), "first_date": F.min(day), "last_date": F.max(day),
        "avg_price": fixed_mean("o_totalprice", 1), "customers": F.count_distinct("o_custkey"),
    }).drop("refreshed_at")


_EVENT_SUMMARY = f"""
    SELECT count(*) AS total, min(ts) AS first_event, max(ts) AS last_event, max(value) AS max_value,
           {mean_sql('value', 2)} AS avg_value, count(DISTINCT user_id) AS users,
           count(*) FILTER (value >= 100) AS strong FROM events"""


def _event_summary(t):
    return marts.summarise(t.events, {
        "total": marts.n_rows(), "first_event": F.min("ts"), "last_event": F.max("ts"), "max_value": F.max("value"),
        "avg_value": fixed_mean("value", 2), "users": F.count_distinct("user_id"),
        "strong": F.count_if(F.col("value") >= 100),
    }).drop("refreshed_at")


@query("event_summary", _EVENT_SUMMARY)
def event_summary(t):
    return _event_summary(t)


@query("ingest_totals", "SELECT count(*) AS total, min(ts) AS first_event, max(ts) AS last_event FROM events")
def ingest_total(t):
    return ingest_totals(t.events.withColumnRenamed("ts", "occurred_at"))


@query("distinct_users_by_type", "SELECT event_type, count(DISTINCT user_id) AS users FROM events GROUP BY 1")
def distinct_users_by_type(t):
    return marts.rollup_by(t.events, ["event_type"], {"users": F.count_distinct("user_id")})


@query("distinct_users_merged", """
    SELECT event_type, CAST(date_trunc('week', ts) AS DATE) AS week, count(DISTINCT user_id) AS users FROM events GROUP BY 1, 2
    UNION ALL SELECT event_type, NULL, count(DISTINCT user_id) FROM events GROUP BY 1""")
def distinct_users_merged(t):
    """Bitmaps of single days, stored in two loads, merged to weeks and to the whole span."""
    path, day = scratch_path(t.spark, "bitmaps"), F.to_date("ts")
    for rest in (0, 1):
        load = t.events.where(F.dayofmonth("ts") % 2 == rest).withColumn("day", day)
        distinct.distinct_bitmaps(load, ["event_type", "day"], "user_id").write.mode("append").parquet(path)
    stored = t.spark.read.parquet(path).withColumn("week", F.to_date(F.date_trunc("week", "day")))
    whole = distinct.count_bitmaps(stored, ["event_type"], "users").withColumn("week", F.lit(None).cast("date"))
    return distinct.count_bitmaps(stored, ["event_type", "week"], "users").unionByName(whole)


@query("daily_counts", "SELECT CAST(o_orderdate AS DATE) AS day, count(*) AS n FROM orders GROUP BY 1")
def daily_counts(t):
    return windows.daily_series(t.orders, "o_orderdate").orderBy("day")


_MONTHLY = f"""
    SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS month, count(*) AS n,
           {mean_sql('l_extendedprice', 2)} AS avg_price, max(l_extendedprice) AS max_price,
           {mean_sql('l_quantity', 1)} AS avg_quantity, count(*) FILTER (l_quantity >= 40) AS large
    FROM lineitem GROUP BY 1"""


@query("monthly_mart", _MONTHLY)
def monthly_mart(t):
    return marts.rollup_by(t.lineitem, [month_start("l_shipdate").alias("month")], {
        "n": marts.n_rows(), "avg_price": fixed_mean("l_extendedprice", 2), "max_price": F.max("l_extendedprice"),
        "avg_quantity": fixed_mean("l_quantity", 1), "large": F.count_if(F.col("l_quantity") >= 40),
    }).orderBy("month")


def orders_by_nation(t):
    """Orders per nation. They are added up per customer before the join, so a customer with very many
    orders joins as one row."""
    per_customer = marts.rollup_by(t.orders, ["o_custkey"], {
        "n": marts.n_rows(), "units": F.sum(F.rint(F.col("o_totalprice") * 100).cast("bigint")), "top": F.max("o_totalprice"),
    })
    customer = t.customer.select("c_custkey", "c_nationkey")
    placed = per_customer.join(customer, F.col("o_custkey") == F.col("c_custkey"))
    nations = placed.groupBy("c_nationkey").agg(
        F.sum("n").alias("n"), F.max("top").alias("max_price"), F.sum("units").alias("units")
    )
    named = nations.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    mean = F.round(F.col("units").cast("decimal(20,0)") / (F.col("n") * 100).cast("decimal(20,0)"), 1)
    return named.select(F.col("n_name").alias("nation"), "n", "max_price", mean.alias("avg_price"))


_NATIONS = f"""
    SELECT n_name AS nation, count(*) AS n, max(o_totalprice) AS max_price, {mean_sql('o_totalprice', 1)} AS avg_price
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1"""


@query("region_mart", _NATIONS)
def region_mart(t):
    return orders_by_nation(t)


@query("count_by_nation", f"SELECT nation, n FROM ({_NATIONS})")
def count_by_nation(t):
    return orders_by_nation(t).select("nation", "n").orderBy(F.desc("n"))


def _count_query(name: str, table: str, column: str):
    @query(name, f"SELECT {column}, count(*) AS n FROM {table} GROUP BY 1")
    def run(t):
        return marts.count_by(getattr(t, table), column).orderBy(F.desc("n"), column)


_count_query("count_by_status", "orders", "o_orderstatus")
_count_query("count_by_priority", "orders", "o_orderpriority")
_count_query("count_by_segment", "customer", "c_mktsegment")
_count_query("count_by_type", "events", "event_type")


def _band_query(name: str, table: str, column: str, bands: Bands):
    sql = f"SELECT {bands_sql(column, bands)} AS band, count(*) AS n FROM {table} GROUP BY 1"

    @query(name, f"SELECT *, {order_sql('band', bands)} AS sort_order FROM ({sql})")
    def run(t):
        labelled = getattr(t, table).select(bands.label(column).alias("band"))
        return marts.count_bands(labelled, "band", bands).orderBy("sort_order")


_band_query("bands_value", "events", "value", VALUE_BANDS)
_band_query("bands_depth", "events", "value", DEPTH_LIKE)
_band_query("bands_size", "part", "p_size", SIZE_BANDS)


@query("band_order", f"""
    WITH b AS (SELECT {bands_sql('p_size', SIZE_BANDS)} AS band, count(*) AS n FROM part GROUP BY 1)
    SELECT band, {order_sql('band', SIZE_BANDS)} AS sort_order, n,
           CAST(row_number() OVER (ORDER BY {order_sql('band', SIZE_BANDS)}) AS INTEGER) AS place FROM b""")
def band_order(t):
    mart = marts.count_by(t.part.select(SIZE_BANDS.label("p_size").alias("band")), "band")
    dim = band_dimension(mart, "band", SIZE_BANDS).select("band", "sort_order", "n")
    return ranking.number_top(dim, [F.col("sort_order")], len(SIZE_BANDS.labels) + 1, "place")


@query("fact_rollup_5d", """
    SELECT CAST(o_orderdate AS DATE) AS day, n_name AS nation, c_mktsegment AS segment, o_orderstatus AS status,
           o_orderpriority AS priority, count(*) AS n
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY ALL""")
def fact_rollup_5d(t):
    return order_fact(t)


def order_fact(t):
    """Day x nation x segment x status x priority.

    Adding up per customer and day first would hardly shrink the rows and cost a second shuffle of all of
    them. They are joined once; a customer with very many orders is split by the skew join, and its groups
    are combined before the only other shuffle. Names are attached to the small result.
    """
    orders = t.orders.select("o_custkey", F.to_date("o_orderdate").alias("day"), "o_orderstatus", "o_orderpriority")
    placed = orders.join(t.customer.select("c_custkey", "c_nationkey", "c_mktsegment"), F.col("o_custkey") == F.col("c_custkey"))
    rolled = marts.count_by(placed, ["day", "c_nationkey", "c_mktsegment", "o_orderstatus", "o_orderpriority"])
    named = rolled.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return named.select(
        "day", F.col("n_name").alias("nation"), F.col("c_mktsegment").alias("segment"),
        F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("priority"), "n",
    )


QUANTITY_BANDS = Bands((10, 20, 30, 40), ("<10", "10-19", "20-29", "30-39", "40+"), "unspecified")
ITEM_FACT_SQL = f"""
    SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS month, l_returnflag AS flag, l_linestatus AS status,
           {bands_sql('l_quantity', QUANTITY_BANDS)} AS band, count(*) AS n, {mean_sql('l_extendedprice', 2)} AS avg_price,
           max(l_extendedprice) AS max_price, {mean_sql('l_quantity', 1)} AS avg_quantity
    FROM lineitem GROUP BY ALL"""


@query("fact_rollup_4d", ITEM_FACT_SQL)
def fact_rollup_4d(t):
    return item_fact(t)


def item_fact(t):
    keys = [
        month_start("l_shipdate").alias("month"), F.col("l_returnflag").alias("flag"),
        F.col("l_linestatus").alias("status"), QUANTITY_BANDS.label("l_quantity").alias("band"),
    ]
    return marts.rollup_by(t.lineitem, keys, {
        "n": marts.n_rows(), "avg_price": fixed_mean("l_extendedprice", 2), "max_price": F.max("l_extendedprice"),
        "avg_quantity": fixed_mean("l_quantity", 1),
    })


@query("duplicate_keys", """
    SELECT l_orderkey, l_partkey, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""")
def duplicate_keys(t):
    return marts.duplicate_keys(t.lineitem, ["l_orderkey", "l_partkey"])


_EXTREMES = f"WITH m AS ({_NATIONS})"


@query("arg_max_min", f"""{_EXTREMES}
    SELECT (SELECT nation FROM m ORDER BY n DESC, nation LIMIT 1) AS top_entity, (SELECT max(n) FROM m) AS top_value,
           (SELECT nation FROM m ORDER BY n, nation LIMIT 1) AS low_entity, (SELECT min(n) FROM m) AS low_value""")
def arg_max_min(t):
    return marts.extremes(orders_by_nation(t), "nation", "n")


def _share_sql(table: str, column: str, digits: int) -> str:
    share = half_up_sql("100 * n", "sum(n) OVER ()", 0, digits)
    return f"""WITH m AS (SELECT {column}, count(*) AS n FROM {table} GROUP BY 1)
    SELECT {column}, n, {share} AS share_pct FROM m"""


@query("share_of_status", _share_sql("orders", "o_orderstatus", 1))
def share_of_status(t):
    return marts.with_share(marts.count_by(t.orders, "o_orderstatus"), "n", 1)


@query("share_of_nation", f"""
    WITH m AS ({_NATIONS}) SELECT nation, n, {half_up_sql('100 * n', '(SELECT count(*) FROM orders)', 0, 2)} AS share_pct
    FROM m ORDER BY n DESC, nation LIMIT 10""")
def share_of_nation(t):
    total = t.orders.agg(marts.n_rows().alias("total")).scalar()
    top = ranking.top_n(orders_by_nation(t).select("nation", "n"), [F.desc("n"), F.asc("nation")], 10)
    return marts.with_share(top, "n", 2, total=total)


@query("strong_share", f"""
    WITH s AS (SELECT count(*) AS total, count(*) FILTER (value >= 100) AS strong FROM events)
    SELECT total, strong, {half_up_sql('100 * strong', 'total', 0, 2)} AS share_pct FROM s""")
def strong_share(t):
    one = _event_summary(t).select("total", "strong")
    return marts.with_share(one, "strong", 2, total=F.col("total"))


@query("sum_exact", f"""
    SELECT l_returnflag, CAST(sum({units_sql('l_extendedprice')}) AS DOUBLE) / 100 AS total FROM lineitem GROUP BY 1""")
def sum_exact(t):
    return marts.rollup_by(t.lineitem, ["l_returnflag"], {"total": fixed_sum("l_extendedprice")})


# --- top-k and ranks -------------------------------------------------------------------------------------

_PER_CUSTOMER = "SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1"


def _customers(t):
    return marts.count_by(t.orders, "o_custkey")


@query("top_customers", f"SELECT * FROM ({_PER_CUSTOMER}) ORDER BY n DESC, o_custkey LIMIT 15")
def top_customers(t):
    return ranking.top_n(_customers(t), [F.desc("n"), F.asc("o_custkey")], 15)


@query("top_brands", "SELECT p_brand, count(*) AS n FROM part GROUP BY 1 ORDER BY n DESC, p_brand LIMIT 10")
def top_brands(t):
    return ranking.top_n(marts.count_by(t.part, "p_brand"), [F.desc("n"), F.asc("p_brand")], 10)


@query("top_nations", f"SELECT * FROM ({_NATIONS}) ORDER BY n DESC, nation LIMIT 15")
def top_nations(t):
    return ranking.top_n(orders_by_nation(t), [F.desc("n"), F.asc("nation")], 15)


_STRONGEST = "SELECT event_id, ts, value, event_type FROM events WHERE value IS NOT NULL ORDER BY value DESC, ts DESC, event_id"


def _strongest(t, n):
    known = t.events.where("value is not null").select("event_id", "ts", "value", "event_type")
    return ranking.top_n(known, [F.desc("value"), F.desc("ts"), F.asc("event_id")], n)


@query("strongest_n", f"""
    WITH s AS ({_STRONGEST} LIMIT 20)
    SELECT *, CAST(row_number() OVER (ORDER BY value DESC, ts DESC, event_id) AS INTEGER) AS rank FROM s""")
def strongest_n(t):
    return ranking.number_top(_strongest(t, 20), [F.desc("value"), F.desc("ts"), F.asc("event_id")], 20)


@query("strongest_read", f"WITH s AS ({_STRONGEST} LIMIT 20) SELECT * FROM s ORDER BY value DESC, ts DESC LIMIT 10")
def strongest_read(t):
    return ranking.top_n(_strongest(t, 20), [F.desc("value"), F.desc("ts")], 10)


@query("entity_rank", f"""
    SELECT o_custkey, n, row_number() OVER (ORDER BY n DESC, o_custkey) AS rank FROM ({_PER_CUSTOMER})""")
def entity_rank(t):
    return entity_dimension(_customers(t), "o_custkey", "n")


@query("latest_n", "SELECT event_id, event_type, ts FROM events ORDER BY ts DESC, event_id DESC LIMIT 4")
def latest_n(t):
    return ranking.top_n(t.events.select("event_id", "event_type", "ts"), [F.desc("ts"), F.desc("event_id")], 4)


@query("latest_row", """
    SELECT CAST(o_orderdate AS DATE) AS day, o_orderkey, o_totalprice FROM orders
    ORDER BY day DESC, o_orderkey DESC, o_totalprice DESC LIMIT 1""")
def latest_row(t):
    orders = t.orders.select(F.to_date("o_orderdate").alias("day"), "o_orderkey", "o_totalprice")
    return ranking.latest_row(orders, "day", ["day", "o_orderkey", "o_totalprice"])


@query("summary_record", f"""
    WITH d AS (SELECT CAST(o_orderdate AS DATE) AS day, count(*) AS n FROM orders GROUP BY 1), m AS ({_NATIONS})
    SELECT (SELECT count(*) FROM orders) AS total, (SELECT day FROM d ORDER BY n DESC, day LIMIT 1) AS peak_day,
           (SELECT max(n) FROM d) AS peak_n, (SELECT nation FROM m ORDER BY n DESC, nation LIMIT 1) AS top_nation,
           (SELECT max(n) FROM m) AS top_nation_n""")
def summary_record(t):
    summary = marts.summarise(t.orders, {"total": marts.n_rows()}, refreshed=False)
    daily, nations = windows.daily_series(t.orders, "o_orderdate"), orders_by_nation(t)
    by_day, by_nation = [F.desc("n"), F.asc("day")], [F.desc("n"), F.asc("nation")]
    return ranking.with_leaders(summary, [
        (daily, by_day, {"peak_day": "day", "peak_n": "n"}),
        (nations, by_nation, {"top_nation": "nation", "top_nation_n": "n"}),
    ])


@query("summary_record_events", f"""
    WITH s AS ({_EVENT_SUMMARY}), m AS (SELECT event_type, count(*) AS n FROM events GROUP BY 1)
    SELECT s.*, (SELECT event_id FROM ({_STRONGEST} LIMIT 1)) AS strongest_id,
           (SELECT ts FROM ({_STRONGEST} LIMIT 1)) AS strongest_at,
           (SELECT event_type FROM m ORDER BY n DESC, event_type LIMIT 1) AS top_type,
           (SELECT max(n) FROM m) AS top_type_n FROM s""")
def summary_record_events(t):
    strongest, order = _strongest(t, 20), [F.desc("value"), F.desc("ts"), F.asc("event_id")]
    types, by_count = marts.count_by(t.events, "event_type"), [F.desc("n"), F.asc("event_type")]
    return ranking.with_leaders(_event_summary(t), [
        (strongest, order, {"strongest_id": "event_id", "strongest_at": "ts"}),
        (types, by_count, {"top_type": "event_type", "top_type_n": "n"}),
    ])


# --- filters ---------------------------------------------------------------------------------------------


@query("filters_window", """
    SELECT * FROM orders WHERE o_orderdate >= TIMESTAMP '1997-03-01' AND o_orderdate < TIMESTAMP '1997-06-01'""")
def filters_window(t):
    at = F.col("o_orderdate")
    start, end = (wall_time(datetime(1997, m, 1)) for m in (3, 6))
    return t.orders.where((at >= start) & (at < end))


@query("filters_threshold", """
    SELECT event_id, ts, value FROM events WHERE value >= 100 AND user_id IS NOT NULL AND event_type IS NOT NULL""")
def filters_threshold(t):
    strong = (F.col("value") >= 100) & F.col("user_id").isNotNull() & F.col("event_type").isNotNull()
    return t.events.where(strong).select("event_id", "ts", "value")


@query("filters_type", "SELECT event_id, ts FROM events WHERE event_type = 'purchase'")
def filters_type(t):
    return t.events.where(F.col("event_type") == "purchase").select("event_id", "ts")


@query("filters_param", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F' AND o_totalprice >= 250000")
def filters_param(t):
    return read_table(
        t.spark, f"{t.folder}/orders.parquet", ["o_orderkey", "o_totalprice"],
        "o_orderstatus = :status AND o_totalprice >= :low", status="F", low=250000.0,
    )
