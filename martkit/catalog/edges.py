"""Values that plain tables lack: endless fractions, NaN and infinity, padded and broken texts, mixed layouts, bad requests."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import functions as F

from martkit import labels
from martkit.catalog import query
from martkit.catalog.series import LAG_SQL, lag_features
from martkit.functions.numbers import fixed_mean, fixed_sum
from martkit.operators import forecast, marts, windows
from martkit.session import scratch_path
from martkit.sinks import export, snapshots
from martkit.sources.feed import FEED_COLUMNS, province_table
from martkit.sources.tabular import read_harmonised
from martkit.streaming import incremental

_SEVENTH = "CAST(value / 7 AS DECIMAL(38, 18))"


@query("mean_of_sevenths", f"""
    SELECT event_type, round(sum({_SEVENTH}), 6)::DOUBLE AS total, round(sum({_SEVENTH})::DOUBLE / count(*), 6) AS mean FROM events GROUP BY 1""")
def mean_of_sevenths(t):
    seventh = F.col("value") / 7
    return marts.rollup_by(t.events, ["event_type"], {"total": F.round(fixed_sum(seventh), 6), "mean": fixed_mean(seventh, 6)})


@query("mean_with_nan", """
    SELECT event_type, round(sum(CAST(value AS DECIMAL(18, 4)))::DOUBLE / count(*), 4) AS mean FROM events WHERE event_id % 5 > 1 GROUP BY 1""")
def mean_with_nan(t):
    value = F.when(F.col("event_id") % 5 == 0, float("nan")).when(F.col("event_id") % 5 == 1, float("-inf")).otherwise(F.col("value"))
    return marts.rollup_by(t.events.withColumn("v", value), ["event_type"], {"mean": fixed_mean("v", 4)})


@query("fractional_moving_avg", f"""
    WITH d AS (SELECT CAST(ts AS DATE) AS day, sum({_SEVENTH}) AS v FROM events GROUP BY 1)
    SELECT day, round(sum(v) OVER w::DOUBLE / count(v) OVER w, 5) AS moving_avg
    FROM d WINDOW w AS (ORDER BY day ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)""")
def fractional_moving_avg(t):
    daily = windows.daily_series(t.events, "ts", measures={"v": fixed_sum(F.col("value") / 7)})
    return windows.moving_average_rows(daily, "v", digits=5).select("day", "moving_avg")


@query("fractional_share", f"""
    WITH s AS (SELECT event_type, sum({_SEVENTH})::DOUBLE AS v FROM events GROUP BY 1)
    SELECT event_type, round(100 * v / sum(v) OVER (), 6) AS share_pct FROM s""")
def fractional_share(t):
    parts = marts.rollup_by(t.events, ["event_type"], {"v": fixed_sum(F.col("value") / 7).cast("double")})
    return marts.with_share(parts, "v", 6).select("event_type", "share_pct")


@query("csv_roundtrip_exact", """
    SELECT o_orderkey, '  ' || o_orderstatus || chr(10) || '"x", ' || o_orderpriority || ' ' AS label, o_totalprice / 7 AS seventh,
           o_totalprice * 1e-24 AS tiny, (SELECT count(*) FROM orders) AS manifest_rows FROM orders""")
def csv_roundtrip_exact(t):
    """Padding, line breaks, quotes, seventeen digits and exponents survive, and the manifest counts rows, not lines."""
    label = F.concat(F.lit("  "), "o_orderstatus", F.lit('\n"x", '), "o_orderpriority", F.lit(" ")).alias("label")
    table = t.orders.select("o_orderkey", label, (F.col("o_totalprice") / 7).alias("seventh"), (F.col("o_totalprice") * 1e-24).alias("tiny"))
    path = scratch_path(t.spark, "csv")
    rows = export.write_csv(table, path, ["o_orderkey"]).first().rows
    read = export.read_export(t.spark, path, "o_orderkey bigint, label string, seventh double, tiny double")
    return read.withColumn("manifest_rows", F.lit(rows).cast("bigint"))


@query("folder_layouts", """
    SELECT o_orderkey::VARCHAR AS case_no, strftime(o_orderdate, '%Y-%m-%d') AS announce_date, CASE WHEN o_orderkey % 2 = 0 THEN o_orderpriority END AS risk
    FROM orders""")
def folder_layouts(t):
    """One folder whose files differ in their columns and in their order."""
    folder, day = scratch_path(t.spark, "folder"), F.date_format("o_orderdate", "yyyy-MM-dd")
    layouts = ([day.alias("Announce Date"), F.col("o_orderpriority").alias("risk"), F.col("o_orderkey").alias("No.")], [F.col("o_orderkey").alias("no"), day.alias("announce_date")])
    for rest, columns in enumerate(layouts):
        t.orders.where(F.pmod("o_orderkey", F.lit(2)) == rest).select(*columns).write.mode("append").option("header", "true").csv(folder)
    targets = ["case_no", "announce_date", "risk"]
    return read_harmonised(t.spark, [folder], labels.CASE_HEADERS, targets, labels.CASE_REQUIRED).drop("source_file")


_BAD = "CASE day(day) % 5 WHEN 1 THEN 'lag_1' WHEN 2 THEN 'lag_2,lag_4' WHEN 3 THEN 'lag_5' END"


@query("score_rejects", f"SELECT event_type, day, {_BAD} AS rejected_inputs FROM ({LAG_SQL}) WHERE {_BAD} IS NOT NULL")
def score_rejects(t):
    """Requests with a negative, a missing and an endless, or an undefined input are set apart; the others can be scored."""
    k = F.dayofmonth("day") % 5
    requests = lag_features(t).withColumns({
        "lag_1": F.when(k == 1, -1 - F.col("lag_1")).otherwise(F.col("lag_1")), "lag_2": F.when(k != 2, F.col("lag_2")),
        "lag_4": F.when(k == 2, float("inf")).otherwise(F.col("lag_4")), "lag_5": F.when(k == 3, float("nan")).otherwise(F.col("lag_5")),
    })
    return forecast.split_scorable(requests)[1].select("event_type", "day", "rejected_inputs")


@query("peaks_of_null_series", """
    WITH d AS (SELECT nullif(o_orderstatus, 'P') AS status, CAST(o_orderdate AS DATE) AS day, count(*) AS n FROM orders GROUP BY 1, 2)
    SELECT status, 3 AS picks, max(n) AS most FROM d GROUP BY 1""")
def peaks_of_null_series(t):
    orders = t.orders.withColumn("status", F.expr("nullif(o_orderstatus, 'P')"))
    found = windows.peaks(windows.daily_series(orders, "o_orderdate", ["status"]), "n", series=["status"])
    return found.groupBy("status").agg(F.count("*").cast("int").alias("picks"), F.max("n").alias("most"))


@query("backfill", """
    SELECT CAST(event_id AS VARCHAR) AS event_id, ts AS occurred_at, (SELECT count(DISTINCT date_trunc('month', ts)) FROM events) AS logged FROM events""")
def backfill(t):
    """All months, in two calls whose spans overlap, and a third that finds nothing left to do."""
    path, log = scratch_path(t.spark, "backfill"), scratch_path(t.spark, "backfill-log")
    stamp = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("Z"))
    own = {"time": stamp, "id": F.col("event_id").cast("string"), "mag": F.lit("1"), "type": F.lit("earthquake"), "place": F.lit("x")}
    feed = t.events.select("ts", *[own.get(c, F.lit(None).cast("string")).alias(c) for c in FEED_COLUMNS])

    def fetch(start: datetime, end: datetime):
        return feed.where((F.col("ts") >= incremental.wall_time(start)) & (F.col("ts") < incremental.wall_time(end))).drop("ts")

    first, last = t.events.agg(F.to_date(F.min("ts")), F.to_date(F.max("ts"))).first()
    after = date(last.year + last.month // 12, last.month % 12 + 1, 1)
    middle = date(last.year, last.month, 1)
    for start, until in ((first, middle), (first, after), (first, after)):
        incremental.backfill(t.spark, fetch, path, log, start, until)
    logged = t.spark.read.parquet(log).count()
    return snapshots.read(t.spark, path).select("event_id", "occurred_at", F.lit(logged).cast("bigint").alias("logged"))


_SLOT = "CAST('0x' || left(md5('42:' || event_id), 8) AS UBIGINT) % 10000"


@query("keyed_split", f"SELECT event_id, {_SLOT} < 8000 AS is_train FROM events")
def keyed_split(t):
    train, test = forecast.split_by_key(t.events.select("event_id"), "event_id")
    return train.withColumn("is_train", F.lit(True)).unionByName(test.withColumn("is_train", F.lit(False)))


@query("forest_on_one_feature", f"""
    SELECT count(*) FILTER ({_SLOT} < 8000) AS trained, count(*) FILTER ({_SLOT} >= 8000) AS tested, true AS deployed,
           count(*) FILTER ({_SLOT} >= 8000 AND abs(value - 50) > 25) AS checked, count(*) FILTER ({_SLOT} >= 8000 AND abs(value - 50) > 25) AS correct
    FROM events""")
def forest_on_one_feature(t):
    """A label that one feature decides, given twice so that every tree sees it: the forest passes its bound and is right wherever the value is clear."""
    rows = t.events.select("event_id", "value", (-F.col("value")).alias("mirrored"), (F.col("value") > 50).cast("double").alias("is_high"))
    train, test = forecast.split_by_key(rows, "event_id")
    model = forecast.train_forest(train, "is_high", ["value", "mirrored"])
    reached = forecast.accuracy(model.transform(test), "is_high")
    checked = forecast.sample_check(model, test.where(F.abs(F.col("value") - 50) > 25), "is_high")
    return checked.select(
        train.agg(marts.n_rows().alias("n")).scalar().alias("trained"), test.agg(marts.n_rows().alias("n")).scalar().alias("tested"),
        F.lit(forecast.passes_accuracy(reached)).alias("deployed"), "checked", "correct",
    )


_PLACES = ", ".join(f"({k}, '{name}', {lat}::DOUBLE, {lon}::DOUBLE)" for k, (name, _, lat, lon) in enumerate(labels.PROVINCES))


@query("customers_by_province", f"""
    SELECT province, lat, lon, count(*) AS customers FROM customer JOIN (VALUES {_PLACES}) p(k, province, lat, lon) ON c_custkey % {len(labels.PROVINCES)} = k GROUP BY ALL""")
def customers_by_province(t):
    slugs = F.array(*[F.lit(slug) for _, slug, _, _ in labels.PROVINCES])
    own = t.customer.select(F.get(slugs, (F.col("c_custkey") % len(labels.PROVINCES)).cast("int")).alias("slug"))
    return own.join(province_table(t.spark), "slug").groupBy("province", "lat", "lon").agg(marts.n_rows().alias("customers"))
