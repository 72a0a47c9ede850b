"""Deduplication, canonical labels, quality gates and reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from martkit.catalog import mean_sql, query
from martkit.functions import text
from martkit.functions.numbers import fixed_mean, within
from martkit.operators import dedupe, forecast, marts, windows
from martkit.operators.quality import Gate, RowRule, off_globe, out_of_range
from martkit.sources.feed import is_loadable
from martkit.sources.tabular import drop_blank

_FIRST = """
    SELECT user_id, event_type, event_id, ts,
           CASE WHEN value <= 120 THEN value END AS value, coalesce(nullif(trim(props), ''), 'none') AS props
    FROM events WHERE ts IS NOT NULL AND user_id IS NOT NULL
    QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) = 1"""


@query("clean_dedupe_first", _FIRST)
def clean_dedupe_first(t):
    valid = drop_blank(t.events, ["ts", "user_id"]).where("ts is not null and user_id is not null")
    first = dedupe.keep_first(valid, ["user_id", "event_type"], ["ts", "event_id"])
    return first.select(
        "user_id", "event_type", "event_id", "ts", within("value", 0, 120).alias("value"),
        text.default_label("props", "none").alias("props"),
    )


@query("keep_last_per_day", """
    SELECT CAST(o_orderdate AS DATE) AS day, o_orderkey, o_totalprice FROM orders
    QUALIFY row_number() OVER (PARTITION BY o_orderdate ORDER BY o_orderkey DESC) = 1""")
def keep_last_per_day(t):
    rows = t.orders.select(F.to_date("o_orderdate").alias("day"), "o_orderkey", "o_totalprice")
    return dedupe.keep_last(rows, ["day"], ["o_orderkey"])


@query("source_precedence", """
    SELECT CAST(o_orderdate AS DATE) AS day, o_orderkey, o_orderstatus AS status FROM orders
    QUALIFY row_number() OVER (PARTITION BY CAST(o_orderdate AS DATE) ORDER BY coalesce(o_orderstatus = 'F', false) DESC, coalesce(o_orderstatus = 'P', false) DESC, o_orderkey DESC) = 1""")
def source_precedence(t):
    named = [F.col("o_orderstatus").eqNullSafe(status) for status in ("P", "F")]

    def source(mine):
        return t.orders.where(mine).select(F.to_date("o_orderdate").alias("day"), "o_orderkey", F.col("o_orderstatus").alias("status"))

    return dedupe.merge_by_precedence([source(~(named[0] | named[1])), source(named[0]), source(named[1])], ["day"], ["o_orderkey"])


_SPELLINGS = """SELECT c_custkey, CASE WHEN c_custkey % 7 < 2 THEN lower(c_mktsegment) WHEN c_custkey % 7 < 4
    THEN upper(left(c_mktsegment, 1)) || lower(substr(c_mktsegment, 2)) ELSE c_mktsegment END AS segment FROM customer"""
_CANONICAL = f"""
    WITH s AS ({_SPELLINGS}), n AS (SELECT segment, count(*) AS n FROM s GROUP BY 1)
    SELECT lower(segment) AS segment_key, segment AS segment_label FROM n
    QUALIFY row_number() OVER (PARTITION BY lower(segment) ORDER BY n DESC, segment) = 1"""


def spelled_segments(t):
    """Customers whose segment is spelled in three ways."""
    part, name = F.pmod("c_custkey", F.lit(7)), F.col("c_mktsegment")
    spelled = F.when(part < 2, F.lower(name)).when(part < 4, F.initcap(name)).otherwise(name)
    return t.customer.select("c_custkey", spelled.alias("segment"))


@query("canonical_label", _CANONICAL)
def canonical_label(t):
    return dedupe.canonical_labels(spelled_segments(t), "segment")


@query("canonical_applied", f"""
    WITH c AS ({_CANONICAL}), s AS ({_SPELLINGS})
    SELECT c_custkey, segment_label AS segment FROM s JOIN c ON lower(segment) = segment_key""")
def canonical_applied(t):
    return dedupe.apply_canonical(spelled_segments(t), "segment")


@query("first_in_feed", """
    SELECT user_id, event_id, ts FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id) = 1""")
def first_in_feed(t):
    feed = t.events.select("user_id", F.col("event_id").alias("position"), "event_id", "ts")
    return dedupe.keep_first(feed, ["user_id"], ["position"]).drop("position")


@query("reject_counts", """
    SELECT count(*) FILTER (event_type <> 'error' AND value >= 1) AS loaded,
           count(*) FILTER (event_type = 'error' OR value < 1) AS rejected FROM events""")
def reject_counts(t):
    spoiled = t.events.select(
        F.when(F.col("event_type") != "error", F.col("event_id").cast("string")).alias("event_id"),
        F.when(F.col("value") >= 1, F.col("ts")).alias("occurred_at"),
    )
    return spoiled.agg(F.count_if(is_loadable()).alias("loaded"), F.count_if(~is_loadable()).alias("rejected"))


# --- gates -----------------------------------------------------------------------------------------------

_BAD = """SELECT *, CASE WHEN o_orderkey % 100 = 0 THEN o_orderkey + 1 ELSE o_orderkey END AS k,
    CASE WHEN o_orderkey % 50 <> 3 THEN o_orderdate END AS d, o_totalprice / 1000 AS p,
    CASE WHEN o_orderkey % 3 > 0 THEN (o_orderkey % 200) - 100 END AS lat, (o_orderkey % 400) - 200 AS lon FROM orders"""


def _spoiled_orders(t):
    key = F.col("o_orderkey")
    return t.orders.select(
        F.when(key % 100 == 0, key + 1).otherwise(key).alias("k"),
        F.when(key % 50 != 3, F.to_date("o_orderdate")).alias("d"),
        (F.col("o_totalprice") / 1000).alias("p"),
        F.when(key % 3 > 0, (key % 200) - 100).alias("lat"),
        ((key % 400) - 200).alias("lon"),
        F.when(key % 2 == 0, F.lower("o_orderpriority")).otherwise(F.col("o_orderpriority")).alias("label"),
    )


@query("quality_report", f"""
    WITH b AS ({_BAD}),
    l AS (SELECT DISTINCT CASE WHEN o_orderkey % 2 = 0 THEN lower(o_orderpriority) ELSE o_orderpriority END AS label FROM orders),
    m AS (SELECT DISTINCT date_trunc('month', CASE WHEN month(d) % 4 = 0 THEN d - INTERVAL 1 MONTH ELSE d END) AS m FROM b WHERE d IS NOT NULL),
    r(rule, violations) AS (
      SELECT 'date missing', count(*) FILTER (d IS NULL) FROM b
      UNION ALL SELECT 'price out of range', count(*) FILTER (p < 10 OR p > 480) FROM b
      UNION ALL SELECT 'off the globe', count(*) FILTER (lat IS NOT NULL AND (abs(lat) > 90 OR abs(lon) > 180)) FROM b
      UNION ALL SELECT 'table empty', CASE WHEN count(*) = 0 THEN 1 ELSE 0 END FROM b
      UNION ALL SELECT 'key repeated', (SELECT count(*) FROM (SELECT k FROM b GROUP BY k HAVING count(*) > 1))
      UNION ALL SELECT 'labels differ only in case', (SELECT count(*) FROM (SELECT lower(label) FROM l GROUP BY 1 HAVING count(*) > 1))
      UNION ALL SELECT 'months missing', (SELECT date_diff('month', min(m), max(m)) + 1 - count(*) FROM m)
      UNION ALL SELECT 'history too short', greatest(0, 30 - (SELECT count(*) FROM b)))
    SELECT rule, CAST(violations AS BIGINT) AS violations, violations = 0 AS passed FROM r""")
def quality_report(t):
    bad = _spoiled_orders(t)
    # every fourth month's rows are dated a month earlier: gaps in a series of all rows
    earlier = F.when(F.month("d") % 4 == 0, F.add_months("d", -1)).otherwise(F.col("d"))
    gappy = windows.monthly_series(bad.where("d is not null").select(earlier.alias("d")), "d")
    return (
        Gate()
        .rows(bad, [
            RowRule("date missing", F.col("d").isNull()),
            RowRule("price out of range", out_of_range("p", 10, 480)),
            RowRule("off the globe", off_globe("lat", "lon")),
        ], not_empty="table empty")
        .unique(bad, ["k"], "key repeated")
        .unique(marts.count_by(bad, "label"), ["label"], "labels differ only in case", fold_case=True)
        .no_missing_months(gappy, "months missing")
        .at_least(bad, 30, "history too short")
        .report()
    )


@query("history_gate", """
    WITH d AS (SELECT event_type, count(DISTINCT CAST(ts AS DATE)) AS days FROM events GROUP BY 1)
    SELECT event_type, days, days >= 30 AS enough_history, days >= 11 AS enough_for_holdout, days - 5 - 5 >= 20 AS enough_to_train FROM d""")
def history_gate(t):
    """Each check on each series, in one job over the daily counts."""
    return forecast.check_series(windows.daily_series(t.events, "ts", ["event_type"]), "n", ["event_type"])


@query("run_report", f"""
    WITH c AS ({_FIRST}), k AS (SELECT event_type, count(*) AS n FROM c GROUP BY 1)
    SELECT (SELECT count(*) FROM events) AS loaded, count(*) AS clean, (SELECT count(*) FROM events) - count(*) AS dropped,
           CAST(min(ts) AS DATE) AS first_date, CAST(max(ts) AS DATE) AS last_date, {mean_sql('value', 1)} AS avg_value,
           (SELECT event_type FROM k ORDER BY n DESC, event_type LIMIT 1) AS top_type FROM c""")
def run_report(t):
    clean = clean_dedupe_first(t)
    by_type = marts.count_by(clean, "event_type")
    loaded = t.events.agg(marts.n_rows().alias("n")).scalar()
    top = by_type.agg(F.min_by("event_type", F.struct(-F.col("n"), F.col("event_type"))).alias("e")).scalar()
    one = clean.agg(
        marts.n_rows().alias("clean"), F.to_date(F.min("ts")).alias("first_date"), F.to_date(F.max("ts")).alias("last_date"),
        fixed_mean("value", 1).alias("avg_value"),
    )
    return one.select(
        loaded.alias("loaded"), "clean", (loaded - F.col("clean")).alias("dropped"), "first_date", "last_date", "avg_value",
        top.alias("top_type"),
    )
