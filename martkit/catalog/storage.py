"""Writers, exports, incremental loads: final state after writing to the shared scratch area and reading back."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import functions as F

from martkit import labels
from martkit.catalog import mean_sql, query
from martkit.catalog.series import daily_prices
from martkit.functions.dates import wall_time
from martkit.functions.numbers import fixed_mean, merged_mean, partial_sums
from martkit.operators import marts, ranking
from martkit.operators.calendar import entity_dimension
from martkit.plans.weather import store_readings
from martkit.session import scratch_path
from martkit.sinks import export, snapshots, writers
from martkit.sources.feed import FEED_COLUMNS, is_loadable, parse_events, parse_readings, read_feed
from martkit.sources.tabular import list_files, read_harmonised
from martkit.streaming import incremental

_ORDER_COLUMNS = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate"


def _orders(t):
    return t.orders.select(*_ORDER_COLUMNS.split(", "))


@query("incremental_marts", f"""
    SELECT strftime(o_orderdate, '%Y-%m') AS label, count(*) AS n, {mean_sql('o_totalprice', 2)} AS avg_price, max(o_totalprice) AS max_price FROM orders GROUP BY 1
    UNION ALL SELECT o_orderstatus, count(*), {mean_sql('o_totalprice', 2)}, max(o_totalprice) FROM orders GROUP BY 1""")
def incremental_marts(t):
    """Two loads whose windows overlap; after each the partial sums of the months touched are worked out, and the marts by month
    and by status are merged from them. The first load's last months come with wrong prices, which the second one mends."""
    table, partials, at = scratch_path(t.spark, "orders"), scratch_path(t.spark, "partials"), F.col("o_orderdate")
    wrong = _orders(t).withColumn("o_totalprice", F.when(at < wall_time(datetime(1998, 1, 1)), F.col("o_totalprice")).otherwise(-1.0))
    for batch, start, end in (
        (wrong.where(at < wall_time(datetime(1998, 7, 1))), datetime(1995, 1, 1), datetime(1998, 7, 1)),
        (_orders(t).where(at >= wall_time(datetime(1998, 1, 1))), datetime(1998, 1, 1), datetime(2002, 1, 1)),
    ):
        snapshots.replace_window(batch, table, "o_orderdate", start, end, ["o_orderkey"])
        snapshots.follow(table, partials, t.spark, lambda rows: rows.groupBy("month", "o_orderstatus").agg(
            F.count(F.lit(1)).alias("n"), F.max("o_totalprice").alias("top"), *partial_sums("o_totalprice", "price")
        ), "o_orderstatus")
    stored = snapshots.read(t.spark, partials)
    merge = lambda label: stored.groupBy(label.alias("label")).agg(F.sum("n").alias("n"), merged_mean("price", 2).alias("avg_price"), F.max("top").alias("max_price"))
    return merge(F.col("month")).unionByName(merge(F.col("o_orderstatus")))


@query("rebuild", f"SELECT {_ORDER_COLUMNS} FROM orders")
def rebuild(t):
    path = scratch_path(t.spark, "rebuild")
    writers.rebuild(_orders(t).withColumn("o_totalprice", F.lit(0.0)), path)
    return writers.rebuild(_orders(t), path)


@query("append_log", "SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders GROUP BY 1, 2")
def append_log(t):
    path = scratch_path(t.spark, "append")
    named = [F.col("o_orderstatus").eqNullSafe(status) for status in ("P", "F")]
    for batch in (*named, ~(named[0] | named[1])):  # the last takes all other statuses
        mine = t.orders.where(batch)
        writers.append_log(marts.count_by(mine, ["o_orderstatus", "o_orderpriority"]), path)
    return t.spark.read.parquet(path).where("inserted_at is not null").drop("inserted_at")


@query("window_replace", """
    SELECT o_orderkey, o_custkey, o_orderstatus, o_orderdate,
           CASE WHEN o_orderdate >= TIMESTAMP '1997-03-10' AND o_orderdate < TIMESTAMP '1997-06-01' THEN 1.0 ELSE o_totalprice END AS o_totalprice
    FROM orders WHERE NOT (o_orderdate >= TIMESTAMP '1998-01-01' AND o_orderdate < TIMESTAMP '1998-02-01')""")
def window_replace(t):
    """The whole history, then a corrected window that starts inside a month (twice), then an empty re-fetch."""
    path, orders, keys = scratch_path(t.spark, "replace"), _orders(t), ["o_orderkey"]

    def load(batch, start, end):
        return writers.replace_window(batch, path, "o_orderdate", start, end, keys)

    load(orders, datetime(1995, 1, 1), datetime(2002, 1, 1))
    start, end = datetime(1997, 3, 10), datetime(1997, 6, 1)
    at = F.col("o_orderdate")
    inside = (at >= wall_time(start)) & (at < wall_time(end))
    for _ in range(2):
        load(orders.where(inside).withColumn("o_totalprice", F.lit(1.0)), start, end)
    load(orders.where("false"), datetime(1998, 1, 1), datetime(1998, 2, 1))
    return t.spark.read.parquet(path).drop("month")


@query("snapshot_window", """
    SELECT o_orderkey, o_custkey, o_orderstatus, o_orderdate,
           CASE WHEN o_orderdate >= TIMESTAMP '1997-03-10' AND o_orderdate < TIMESTAMP '1997-06-01' THEN 1.0 ELSE o_totalprice END AS o_totalprice
    FROM orders WHERE NOT (o_orderdate >= TIMESTAMP '1998-01-01' AND o_orderdate < TIMESTAMP '1998-02-01')""")
def snapshot_window(t):
    """As ``window_replace``, into a snapshot table; the corrected window also brings keys of other months, which are ignored."""
    path, orders, keys = scratch_path(t.spark, "snapshot"), _orders(t), ["o_orderkey"]

    def load(batch, start, end):
        return snapshots.replace_window(batch, path, "o_orderdate", start, end, keys)

    load(orders, datetime(1995, 1, 1), datetime(2002, 1, 1))
    start, end = datetime(1997, 3, 10), datetime(1997, 6, 1)
    at = F.col("o_orderdate")
    inside = (at >= wall_time(start)) & (at < wall_time(end))
    fresh = orders.where(inside).withColumn("o_totalprice", F.lit(1.0))
    strange = orders.where(at >= wall_time(datetime(1999, 1, 1))).withColumn("o_orderdate", wall_time(datetime(1997, 4, 1))).withColumn("o_totalprice", F.lit(-1.0))
    for batch in (fresh, fresh.unionByName(strange)):
        load(batch, start, end)
    load(orders.where("false"), datetime(1998, 1, 1), datetime(1998, 2, 1))
    return snapshots.read(t.spark, path).drop("month")


@query("snapshot_insert", f"""
    SELECT {_ORDER_COLUMNS} FROM orders
    QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderstatus = 'P' DESC, o_orderkey) = 1""")
def snapshot_insert(t):
    """First writer of a key wins, into a snapshot table that is then compacted and cleared of what no reader needs."""
    path, orders = scratch_path(t.spark, "snapshot"), _orders(t)
    for batch in (orders.where("o_orderstatus = 'P'"), orders, orders):
        snapshots.insert_if_absent(batch, path, ["o_custkey"], ["o_orderkey"], at="o_orderdate")
    snapshots.compact(t.spark, path, "o_custkey")
    snapshots.vacuum(t.spark, path)
    return snapshots.read(t.spark, path).drop("month")


@query("snapshot_upsert", f"""
    WITH d AS (SELECT CAST(o_orderdate AS DATE) AS date, o_orderstatus AS symbol, {mean_sql('o_totalprice', 2)} AS price FROM orders GROUP BY 1, 2)
    SELECT date, symbol, CASE WHEN year(date) = 1999 AND symbol <> 'O' THEN 50.0 ELSE price END AS price FROM d""")
def snapshot_upsert(t):
    path = scratch_path(t.spark, "snapshot")
    price = fixed_mean("o_totalprice", 2).cast("double").alias("price")
    daily = t.orders.groupBy(F.to_date("o_orderdate").alias("date"), F.col("o_orderstatus").alias("symbol")).agg(price)
    snapshots.upsert(daily, path, ["date", "symbol"], "date")
    fresh = daily.where("year(date) = 1999 and symbol <> 'O'").withColumn("price", F.lit(50.0))
    for _ in range(2):
        snapshots.upsert(fresh, path, ["date", "symbol"], "date")
    return snapshots.read(t.spark, path).drop("month", "inserted_at")


@query("insert_if_absent", f"""
    SELECT {_ORDER_COLUMNS} FROM orders
    QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderstatus = 'P' DESC, o_orderkey) = 1""")
def insert_if_absent(t):
    path, orders = scratch_path(t.spark, "insert"), _orders(t)
    for batch in (orders.where("o_orderstatus = 'P'"), orders, orders):
        writers.insert_if_absent(batch, path, ["o_custkey"], ["o_orderkey"], at="o_orderdate")
    return t.spark.read.parquet(path).drop("month")


@query("upsert", f"""
    WITH d AS (SELECT CAST(o_orderdate AS DATE) AS date, o_orderstatus AS symbol, {mean_sql('o_totalprice', 2)} AS price
               FROM orders GROUP BY 1, 2)
    SELECT date, symbol, CASE WHEN year(date) = 1999 AND symbol <> 'O' THEN 50.0 ELSE price END AS price FROM d
    UNION ALL SELECT DATE '2010-01-01', 'F', 50.0""")
def upsert(t):
    path = scratch_path(t.spark, "upsert")
    price = fixed_mean("o_totalprice", 2).cast("double").alias("price")
    keys = [F.to_date("o_orderdate").alias("date"), F.col("o_orderstatus").alias("symbol")]
    daily = t.orders.groupBy(*keys).agg(price)
    writers.upsert(daily, path, ["date", "symbol"], "date")
    fresh = daily.where("year(date) = 1999 and symbol <> 'O'").withColumn("price", F.lit(50.0))
    extra = t.spark.createDataFrame([(date(2010, 1, 1), "F", 50.0)], "date date, symbol string, price double")
    for _ in range(2):
        writers.upsert(fresh.unionByName(extra), path, ["date", "symbol"], "date")
    return t.spark.read.parquet(path).drop("month", "inserted_at")


@query("header_harmonise", """
    SELECT o_orderkey::VARCHAR AS case_no, strftime(o_orderdate, '%Y-%m-%d') AS announce_date,
           CASE WHEN o_orderstatus IS DISTINCT FROM 'F' THEN o_orderpriority END AS risk FROM orders""")
def header_harmonise(t):
    """One file set per status, each with its own header spelling; one of them lacks a column."""
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    layouts = {
        "P": {" No. ": F.col("o_orderkey"), "Announce  Date": day, "risk": F.col("o_orderpriority")},
        "F": {"announce_date": day, "no": F.col("o_orderkey"), "unused": F.lit("x")},
        "O": {"RISK": F.col("o_orderpriority"), "ANNOUNCE DATE": day, "No": F.col("o_orderkey")},
    }
    root, paths = scratch_path(t.spark, "headers"), []
    for status, columns in layouts.items():
        paths.append(f"{root}/{status}")
        # whatever is neither of the first two goes to the last
        named = [F.col("o_orderstatus").eqNullSafe(s) for s in ("P", "F")]
        own = ~(named[0] | named[1]) if status == "O" else F.col("o_orderstatus").eqNullSafe(status)
        part = t.orders.where(own).select(*[c.alias(n) for n, c in columns.items()])
        part.write.option("header", "true").csv(paths[-1])
    targets = ["case_no", "announce_date", "risk"]
    return read_harmonised(t.spark, paths, labels.CASE_HEADERS, targets, labels.CASE_REQUIRED).drop("source_file")


@query("csv_roundtrip_bom", """
    SELECT o_custkey, o_orderstatus || ', "' || o_orderpriority || '"' AS label, count(*) AS n, max(o_totalprice) AS top,
           max(o_orderdate) AS last_at FROM orders GROUP BY 1, 2""")
def csv_roundtrip_bom(t):
    label = F.concat("o_orderstatus", F.lit(', "'), "o_orderpriority", F.lit('"')).alias("label")
    table = t.orders.groupBy("o_custkey", label).agg(
        marts.n_rows().alias("n"), F.max("o_totalprice").alias("top"), F.max("o_orderdate").alias("last_at")
    )
    path = scratch_path(t.spark, "csv")
    export.write_csv(table, path, ["o_custkey", "label"])
    return export.read_export(
        t.spark, path, "o_custkey bigint, label string, n bigint, top double, last_at timestamp_ntz"
    )


@query("export_manifest", """
    SELECT 'dim_customer' AS name, count(DISTINCT o_custkey) AS rows, true AS has_bytes FROM orders
    UNION ALL SELECT 'fact_status', count(*), true FROM (SELECT DISTINCT o_orderstatus, o_orderdate FROM orders)""")
def export_manifest(t):
    fact = marts.count_by(t.orders, ["o_orderstatus", "o_orderdate"])
    dim = entity_dimension(marts.count_by(t.orders, "o_custkey"), "o_custkey", "n")
    bundle = {"dim_customer": (dim, ["rank"]), "fact_status": (fact, ["o_orderdate", "o_orderstatus"])}
    manifest = export.export_bundle(bundle, scratch_path(t.spark, "bundle"))
    return manifest.select("name", "rows", (F.col("bytes") > 0).alias("has_bytes"))


@query("file_listing", """
    SELECT o_orderstatus AS part, true AS has_bytes FROM orders GROUP BY 1""")
def file_listing(t):
    """Files of a table written in parts, found by listing alone."""
    path = scratch_path(t.spark, "listing")
    t.orders.write.partitionBy("o_orderstatus").parquet(path)
    part = F.regexp_extract("path", "o_orderstatus=([^/]*)/", 1).alias("part")
    return list_files(t.spark, path, "*.parquet").groupBy(part).agg((F.sum("bytes") > 0).alias("has_bytes"))


@query("mart_status", "SELECT true AS ready, count(*) AS total, max(ts) AS last_event FROM events")
def mart_status(t):
    path = scratch_path(t.spark, "status")
    summary = marts.summarise(t.events, {"total": marts.n_rows(), "last_event": F.max("ts")})
    writers.rebuild(summary, path)
    status = export.mart_status(t.spark, path, ["total", "last_event", "refreshed_at"])
    return status.where("refreshed_at is not null").drop("refreshed_at")


# --- feed and incremental loads --------------------------------------------------------------------------


def _land_feed(t, path: str, spoil: bool = False):
    """Events as feed pages, all text; spoiled ones have no id in one kind of event."""
    key = F.col("event_id")
    event = F.when(F.lit(spoil) & (F.col("event_type") == "error"), F.lit(" ")).otherwise(key.cast("string"))
    columns = {
        "time": F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"), "latitude": (key % 181 - 90).cast("string"),
        "longitude": F.lit("x"), "depth": F.lit(""), "mag": F.col("value").cast("string"), "magType": F.lit(" ml "),
        "place": F.concat(F.lit("near "), "user_id", F.lit(", CA")), "type": F.col("event_type"), "net": F.lit(""),
        "status": F.lit("reviewed"), "id": event, "updated": F.lit(None).cast("string"),
    }
    pages = t.events.select(*[columns[c].alias(c) for c in FEED_COLUMNS])
    pages.write.mode("append").option("header", "true").csv(path)


_PARSED = """SELECT event_id::VARCHAR AS event_id, ts AS occurred_at, CAST(event_id % 181 - 90 AS DOUBLE) AS latitude,
    CAST(NULL AS DOUBLE) AS depth_km, value AS magnitude, 'ml' AS mag_type, 'near ' || user_id || ', CA' AS place,
    event_type, 'reviewed' AS status FROM events"""
_STORED = ["event_id", "occurred_at", "latitude", "depth_km", "magnitude", "mag_type", "place", "event_type", "status"]


@query("feed_scan", _PARSED)
def feed_scan(t):
    path = scratch_path(t.spark, "feed")
    _land_feed(t, path)
    return parse_events(read_feed(t.spark, path)).where(is_loadable()).select(*_STORED)


@query("load_window", f"{_PARSED} WHERE event_type <> 'error'")
def load_window(t):
    """The landed pages hold every event twice; loading the window twice must not double anything."""
    landing, path = scratch_path(t.spark, "landing"), scratch_path(t.spark, "events")
    for _ in range(2):
        _land_feed(t, landing, spoil=True)
    for _ in range(2):
        incremental.load_window(read_feed(t.spark, landing), path, datetime(2024, 1, 1), datetime(2024, 2, 1))
    return snapshots.read(t.spark, path).select(*_STORED)


@query("micro_batch", f"{_PARSED} WHERE event_type <> 'error'")
def micro_batch(t):
    """The same pages landing in two rounds and read as a stream that ends when it has caught up."""
    landing, path, checkpoint = (scratch_path(t.spark, n) for n in ("stream-in", "stream-out", "stream-state"))
    for _ in range(2):
        _land_feed(t, landing, spoil=True)
        incremental.stream_feed(t.spark, landing, path, checkpoint).awaitTermination()
    return snapshots.read(t.spark, path).select(*_STORED)


@query("pending_windows", """
    WITH w AS (SELECT CAST(unnest(generate_series(DATE '1995-01-01', DATE '2001-11-01', INTERVAL 1 MONTH)) AS DATE) AS window_start)
    SELECT window_start, CAST(window_start + INTERVAL 1 MONTH AS DATE) AS window_end FROM w WHERE window_start NOT IN (
      SELECT CAST(date_trunc('month', CASE WHEN month(o_orderdate) % 4 = 0 THEN o_orderdate - INTERVAL 1 MONTH ELSE o_orderdate END) AS DATE) FROM orders)""")
def pending_windows(t):
    windows = incremental.month_windows(t.spark, date(1995, 1, 1), date(2001, 12, 1))
    month = F.trunc(F.to_date("o_orderdate"), "MM")  # orders of every fourth month are dated a month earlier
    loaded = t.orders.select(F.when(F.month(month) % 4 == 0, F.add_months(month, -1)).otherwise(month).alias("window_start"))
    return incremental.pending_windows(windows, loaded.distinct())


@query("bootstrap_history", f"""
    WITH p AS (SELECT CAST(ts AS DATE) AS date, event_type AS symbol, {mean_sql('value', 4)} AS price FROM events GROUP BY 1, 2)
    SELECT date, symbol, CASE WHEN date = (SELECT max(date) FROM p) THEN 50.0 ELSE price END AS price FROM p""")
def bootstrap_history(t):
    """Short history is filled once; a second run with other prices only changes the newest day."""
    path = scratch_path(t.spark, "history")
    history = daily_prices(t).select(F.col("day").alias("date"), F.col("event_type").alias("symbol"), "price")
    last = history.agg(F.max("date").alias("d")).scalar()
    latest = history.where(F.col("date") == last).withColumn("price", F.lit(50.0)).withColumn("inserted_at", F.current_timestamp())
    stamped = history.withColumn("inserted_at", F.current_timestamp())
    incremental.bootstrap_or_update(None, stamped, latest, path, 30, "date", ["date", "symbol"])
    stored = t.spark.read.parquet(path)
    other = stamped.withColumn("price", F.lit(-1.0))
    incremental.bootstrap_or_update(stored, other, latest, path, 30, "date", ["date", "symbol"])
    return t.spark.read.parquet(path).drop("month", "inserted_at")


def _readings(t):
    """Events as nested JSON readings, one document per row."""
    current = F.struct(
        F.col("value").alias("temperature"), (F.col("value") / 2).alias("windspeed"),
        F.col("user_id").cast("int").alias("weathercode"), F.date_format("ts", "yyyy-MM-dd'T'HH:mm").alias("time"),
    )
    doc = F.struct(F.lit(1).alias("generationtime"), current.alias("current_weather"))
    return t.events.select(F.col("event_type").alias("province"), F.to_json(doc).alias("value"))


@query("json_readings", """
    SELECT event_type AS province, value AS temperature, value / 2 AS windspeed, CAST(user_id AS INTEGER) AS weathercode,
           date_trunc('minute', ts) AS recorded_at FROM events""")
def json_readings(t):
    return parse_readings(_readings(t), "value", "province")


@query("readings_read_back", """
    SELECT event_type AS province, value AS temperature, date_trunc('minute', ts) AS recorded_at,
           CASE WHEN value >= 35 THEN 'ร้อนจัด' WHEN value >= 30 THEN 'ร้อน' WHEN value >= 25 THEN 'อากาศดี' ELSE 'เย็น' END AS temperature_category
    FROM events ORDER BY recorded_at DESC, province LIMIT 4""")
def readings_read_back(t):
    newest = store_readings(_readings(t), scratch_path(t.spark, "readings"))
    return newest.select("province", "temperature", "recorded_at", "temperature_category")


@query("hottest_coolest", f"""
    WITH m AS (SELECT event_type, {mean_sql('value', 2)} AS mean FROM events GROUP BY 1)
    SELECT (SELECT event_type FROM m ORDER BY mean DESC, event_type LIMIT 1) AS top_entity, (SELECT max(mean) FROM m) AS top_value,
           (SELECT event_type FROM m ORDER BY mean, event_type LIMIT 1) AS low_entity, (SELECT min(mean) FROM m) AS low_value""")
def hottest_coolest(t):
    return marts.extremes(marts.rollup_by(t.events, ["event_type"], {"mean": fixed_mean("value", 2)}), "event_type", "mean")


@query("verify_load", """
    SELECT count(*) AS stored, max(o_orderkey) AS newest FROM orders""")
def verify_load(t):
    path = scratch_path(t.spark, "verify")
    stored = writers.rebuild(_orders(t), path)
    newest = ranking.top_n(stored.select("o_orderkey"), [F.desc("o_orderkey")], 1).scalar()
    return stored.agg(marts.n_rows().alias("stored")).withColumn("newest", newest)
