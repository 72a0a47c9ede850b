"""The case and event flows on tables shaped like their real input, derived row by row from the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from martkit import labels
from martkit.catalog import mean_sql, query
from martkit.functions.chart import map_position, marker_radius
from martkit.operators.calendar import band_dimension, calendar_dimension
from martkit.operators.marts import with_share
from martkit.operators.ranking import number_top, top_n, with_leaders
from martkit.plans import cases, events
from martkit.session import scratch_path

# Two files: every order, and once more the finished ones with a later date. 24 years are added, so that part of
# the dates lies outside the accepted range.
_RAW = """
    SELECT CASE WHEN o_orderkey % 97 <> 5 THEN o_orderkey END AS case_no,
           CASE WHEN o_orderkey % 89 <> 7 THEN CAST(o_orderdate + INTERVAL 24 YEAR + INTERVAL (f) DAY AS DATE) END AS announce_date,
           CASE o_orderkey % 4 WHEN 0 THEN 'Male' WHEN 1 THEN ' F ' WHEN 2 THEN 'x' END AS sex,
           CAST(o_orderkey % 130 AS INTEGER) AS age,
           CASE o_orderkey % 5 WHEN 0 THEN 'Thai' WHEN 1 THEN 'burmese ' WHEN 2 THEN ' Laos' WHEN 3 THEN o_orderpriority END AS nationality,
           CASE WHEN o_custkey % 11 <> 0 THEN 'P' || (o_custkey % 77) ELSE '  ' END AS province,
           CASE WHEN f = 0 THEN 'all.csv' ELSE 'finished.csv' END AS source_file
    FROM orders JOIN (VALUES (0), (1)) v(f) ON f = 0 OR o_orderstatus = 'F'"""
_CLEAN = f"""
    SELECT case_no, announce_date, CASE sex WHEN 'Male' THEN 'ชาย' WHEN ' F ' THEN 'หญิง' ELSE 'ไม่ระบุ' END AS sex,
           CASE WHEN age <= 120 THEN age END AS age,
           CASE WHEN age > 120 THEN 'ไม่ระบุ' WHEN age >= 70 THEN '70+' ELSE (age // 10 * 10) || '-' || (age // 10 * 10 + 9) END AS age_group,
           CASE WHEN nationality IS NULL THEN 'ไม่ระบุ' WHEN nationality = 'Thai' THEN 'Thailand' WHEN nationality LIKE 'burm%' THEN 'Myanmar'
                WHEN nationality = ' Laos' THEN 'Laos' ELSE nationality END AS nationality,
           CASE WHEN trim(province) = '' THEN 'ไม่ระบุ' ELSE province END AS province, source_file
    FROM ({_RAW}) WHERE announce_date BETWEEN DATE '2020-01-01' AND DATE '2023-12-31' AND case_no IS NOT NULL
    QUALIFY row_number() OVER (PARTITION BY case_no ORDER BY announce_date, source_file) = 1"""


def _raw_cases(t):
    key = F.col("o_orderkey")

    def one(later: int, name: str):
        day = F.date_add(F.add_months(F.to_date("o_orderdate"), 288), later)
        return [
            F.when(key % 97 != 5, key).alias("case_no"),
            F.when(key % 89 != 7, day).alias("announce_date"),
            F.lit(None).cast("date").alias("notified_date"),
            F.when(key % 4 == 0, "Male").when(key % 4 == 1, " F ").when(key % 4 == 2, "x").alias("sex"),
            (key % 130).cast("int").alias("age"),
            F.when(key % 5 == 0, "Thai").when(key % 5 == 1, "burmese ").when(key % 5 == 2, " Laos")
            .when(key % 5 == 3, F.col("o_orderpriority")).alias("nationality"),
            F.when(F.col("o_custkey") % 11 != 0, F.concat(F.lit("P"), F.col("o_custkey") % 77)).otherwise("  ").alias("province_of_isolation"),
            F.lit(None).cast("string").alias("risk"),
            F.lit(None).cast("string").alias("district_of_onset"),
            F.lit(name).alias("source_file"),
        ]

    every = t.orders.select(*one(0, "all.csv"))
    return every.unionByName(t.orders.where("o_orderstatus = 'F'").select(*one(1, "finished.csv")))


_CASE_COLUMNS = ["case_no", "announce_date", "sex", "age", "age_group", "nationality", "province", "source_file"]


@query("case_clean", _CLEAN)
def case_clean(t):
    return cases.clean_cases(_raw_cases(t)).select(*_CASE_COLUMNS)


@query("case_files", f"""
    WITH c AS ({_CLEAN}) SELECT announce_date AS day, province, sex, count(*) AS cases FROM c GROUP BY ALL""")
def case_files(t):
    """The raw cases written as delimited files with two header styles, loaded, cleaned and counted."""
    root, raw = scratch_path(t.spark, "case-files"), _raw_cases(t)
    names = {
        "all.csv": {"No.": "case_no", "announce date": "announce_date", "Sex": "sex", "age": "age", "Nationality": "nationality", "Province of Isolation": "province_of_isolation"},
        "finished.csv": {"province_of_isolation": "province_of_isolation", "no": "case_no", "nationality": "nationality", "Announce_Date": "announce_date", " sex ": "sex", "AGE": "age"},
    }
    for file, columns in names.items():
        rows = raw.where(F.col("source_file") == file).select(*[F.col(c).alias(h) for h, c in columns.items()])
        rows.write.option("header", "true").option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false").csv(f"{root}/{file}")
    clean = cases.clean_cases(cases.load_cases(t.spark, [f"{root}/{file}" for file in names]))
    return clean.groupBy(F.col("announce_date").alias("day"), "province", "sex").agg(F.count(F.lit(1)).alias("cases"))


def _case_marts(t):
    return cases.case_marts(cases.clean_cases(_raw_cases(t)))


for _key in ("province", "sex", "nationality"):
    query(f"case_by_{_key}", f"SELECT {_key}, count(*) AS cases FROM ({_CLEAN}) GROUP BY 1")(
        lambda t, key=_key: _case_marts(t)[f"by_{key}"]
    )


@query("case_age_dimension", f"""
    SELECT age_group, CAST(CASE age_group WHEN 'ไม่ระบุ' THEN 9 WHEN '70+' THEN 8 ELSE 1 + CAST(split_part(age_group, '-', 1) AS INTEGER) // 10 END AS INTEGER) AS sort_order,
           count(*) AS cases FROM ({_CLEAN}) GROUP BY 1""")
def case_age_dimension(t):
    return band_dimension(_case_marts(t)["by_age_group"], "age_group", labels.AGE_BANDS).orderBy("sort_order")


@query("case_summary", f"""
    SELECT count(*) AS total_cases, min(announce_date) AS first_date, max(announce_date) AS last_date,
           {mean_sql('age', 1, 0)} AS avg_age, count(DISTINCT province) AS province_count FROM ({_CLEAN})""")
def case_summary(t):
    return _case_marts(t)["summary"].drop("refreshed_at")


@query("case_top_nationalities", f"""
    WITH n AS (SELECT nationality, count(*) AS cases FROM ({_CLEAN}) GROUP BY 1 ORDER BY cases DESC, nationality LIMIT 10)
    SELECT *, CAST(row_number() OVER (ORDER BY cases DESC, nationality) AS INTEGER) AS rank,
           round(100 * cases::DOUBLE / (SELECT count(*) FROM ({_CLEAN})), 2) AS share_pct FROM n""")
def case_top_nationalities(t):
    marts = _case_marts(t)
    top = number_top(marts["by_nationality"], [F.desc("cases"), F.asc("nationality")], 10)
    return with_share(top, "cases", 2, total=marts["summary"].select("total_cases").scalar())


@query("case_calendar", f"""
    WITH b AS (SELECT min(announce_date) AS lo, max(announce_date) AS hi FROM ({_CLEAN})),
    s AS (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS day FROM b)
    SELECT day, strftime(day, '%Y-%m') AS year_month, CASE WHEN isodow(day) >= 6 THEN 'TRUE' ELSE 'FALSE' END AS is_weekend FROM s""")
def case_calendar(t):
    dim = calendar_dimension(cases.clean_cases(_raw_cases(t)), "announce_date")
    return dim.select("day", "year_month", "is_weekend")


@query("case_gate", f"""
    SELECT unnest(['announce_date is null', 'age out of range', 'cases empty', 'case_no repeated', 'daily summary empty']) AS rule,
           CAST(0 AS BIGINT) AS violations, (SELECT count(*) FROM ({_CLEAN})) > 0 AS passed""")
def case_gate(t):
    clean = cases.clean_cases(_raw_cases(t))
    return cases.case_gate(clean, cases.case_marts(clean)["daily"]).report()


@query("case_run_report", f"""
    WITH c AS ({_CLEAN}), p AS (SELECT province, count(*) AS n FROM c GROUP BY 1)
    SELECT (SELECT count(*) FROM ({_RAW})) AS loaded, count(*) AS clean, (SELECT count(*) FROM ({_RAW})) - count(*) AS dropped,
           min(announce_date) AS first_date, max(announce_date) AS last_date, {mean_sql('age', 1, 0)} AS avg_age,
           count(DISTINCT province) AS province_count, (SELECT province FROM p ORDER BY n DESC, province LIMIT 1) AS top_province FROM c""")
def case_run_report(t):
    raw = _raw_cases(t)
    return cases.run_report(raw, cases.clean_cases(raw), _case_marts(t))


# --- events ----------------------------------------------------------------------------------------------

_EVENTS = """
    SELECT event_id::VARCHAR AS event_id, ts + INTERVAL (user_id % 24) MONTH AS occurred_at,
           CASE WHEN event_id % 13 <> 0 THEN CAST(event_id % 181 - 90 AS DOUBLE) END AS latitude, CAST(user_id % 360 - 180 AS DOUBLE) AS longitude,
           CASE WHEN event_id % 17 <> 0 THEN value * 2 END AS depth_km, CASE WHEN event_id % 29 = 0 THEN NULL ELSE value / 50 END AS magnitude,
           CASE event_id % 6 WHEN 0 THEN 'California' WHEN 1 THEN 'California' WHEN 2 THEN 'Alaska' WHEN 3 THEN 'Off the coast of ' || event_type
                WHEN 4 THEN CASE WHEN event_id % 4 = 0 THEN 'Off the coast of ' ELSE 'off the coast of ' END || event_type ELSE 'ไม่ระบุ' END AS region,
           CASE event_id % 6 WHEN 0 THEN '9 km N of A, CA' WHEN 1 THEN 'near B, California' WHEN 2 THEN 'C, AK' WHEN 3 THEN 'Off the coast of ' || event_type
                WHEN 4 THEN CASE WHEN event_id % 4 = 0 THEN 'Off the coast of ' ELSE 'off the coast of ' END || event_type END AS place
    FROM events WHERE event_type <> 'error'"""
_ENRICHED = f"""
    WITH e AS ({_EVENTS}), n AS (SELECT region, count(*) AS n FROM e GROUP BY 1),
    c AS (SELECT lower(region) AS k, region AS label FROM n QUALIFY row_number() OVER (PARTITION BY lower(region) ORDER BY n DESC, region) = 1)
    SELECT e.* EXCLUDE (region), label AS region, CAST(date_trunc('month', occurred_at) AS DATE) AS month,
           CASE WHEN magnitude IS NULL THEN 8 ELSE least(greatest(floor(magnitude), 1), 7) END AS mag_order,
           CASE WHEN depth_km IS NULL THEN 4 WHEN depth_km < 70 THEN 1 WHEN depth_km < 300 THEN 2 ELSE 3 END AS depth_order
    FROM e JOIN c ON lower(e.region) = c.k"""


def _sql_labels(column: str, bands) -> str:
    names = ", ".join(f"'{n}'" for n in (*bands.labels, bands.null_label))
    return f"([{names}])[CAST({column} AS INTEGER)]"


_MAG_LABEL, _DEPTH_LABEL = _sql_labels("mag_order", labels.MAGNITUDE_BANDS), _sql_labels("depth_order", labels.DEPTH_BANDS)


def _event_table(t):
    key, kind = F.col("event_id"), F.col("event_type")
    coast = F.concat(F.when(key % 4 == 0, "Off the coast of ").otherwise("off the coast of "), kind)
    place = F.when(key % 6 == 0, "9 km N of A, CA").when(key % 6 == 1, "near B, California").when(key % 6 == 2, "C, AK")
    place = place.when(key % 6 == 3, F.concat(F.lit("Off the coast of "), kind)).when(key % 6 == 4, coast)
    return t.events.select(
        key.cast("string").alias("event_id"),
        F.expr("ts + make_ym_interval(0, cast(user_id % 24 as int))").alias("occurred_at"),
        F.when(key % 13 != 0, (key % 181 - 90).cast("double")).alias("latitude"),
        (F.col("user_id") % 360 - 180).cast("double").alias("longitude"),
        F.when(key % 17 != 0, F.col("value") * 2).alias("depth_km"),
        F.when(key % 29 == 0, F.lit(-9.99)).otherwise(F.col("value") / 50).alias("magnitude"),
        F.lit("ml").alias("mag_type"),
        place.alias("place"),
        F.when(kind == "error", "quarry blast").otherwise("earthquake").alias("event_type"),
    )


def _enriched(t):
    return events.with_canonical_regions(events.enrich_events(_event_table(t)))


@query("event_enriched", f"""
    SELECT event_id, occurred_at, CAST(occurred_at AS DATE) AS occurred_on, month AS occurred_month, latitude, longitude, depth_km, magnitude,
           'ml' AS mag_type, place, region, {_MAG_LABEL} AS magnitude_band, {_DEPTH_LABEL} AS depth_band FROM ({_ENRICHED})""")
def event_enriched(t):
    return _enriched(t)


_MEANS = f"{mean_sql('magnitude', 2, 4)} AS avg_magnitude, max(magnitude) AS max_magnitude, {mean_sql('depth_km', 1, 4)} AS avg_depth_km"
_EVENT_MARTS = {
    "monthly": f"SELECT month, count(*) AS events, {_MEANS}, count(*) FILTER (magnitude >= 5) AS events_m5_plus FROM ({_ENRICHED}) GROUP BY 1",
    "by_magnitude": f"SELECT {_MAG_LABEL} AS magnitude_band, count(*) AS events, CAST(mag_order AS INTEGER) AS sort_order FROM ({_ENRICHED}) GROUP BY mag_order",
    "by_region": f"SELECT region, count(*) AS events, max(magnitude) AS max_magnitude, {mean_sql('depth_km', 1, 4)} AS avg_depth_km FROM ({_ENRICHED}) GROUP BY 1",
    "by_depth": f"SELECT {_DEPTH_LABEL} AS depth_band, count(*) AS events, CAST(depth_order AS INTEGER) AS sort_order FROM ({_ENRICHED}) GROUP BY depth_order",
    "strongest": f"""SELECT event_id, occurred_at, magnitude, depth_km, place, region, latitude, longitude FROM ({_ENRICHED})
        WHERE magnitude IS NOT NULL ORDER BY magnitude DESC, occurred_at DESC, event_id LIMIT 20""",
    "map_points": f"""SELECT event_id, occurred_at, latitude, longitude, magnitude, depth_km, place FROM ({_ENRICHED})
        WHERE magnitude >= 6 AND latitude IS NOT NULL AND longitude IS NOT NULL""",
}
for _name, _sql in _EVENT_MARTS.items():
    query(f"event_{_name}", _sql)(lambda t, name=_name: events.event_marts(_enriched(t))[name])

_EVENT_SUMMARY = f"""
    SELECT count(*) AS total_events, min(occurred_at) AS first_event, max(occurred_at) AS last_event, {_MEANS},
           count(DISTINCT region) AS region_count, count(*) FILTER (magnitude >= 6) AS events_m6_plus FROM ({_ENRICHED})"""


@query("event_run_report", f"""
    WITH r AS (SELECT region, events FROM ({_EVENT_MARTS['by_region']}) ORDER BY events DESC, region LIMIT 1),
    s AS (SELECT event_id, magnitude, place FROM ({_EVENT_MARTS['strongest']}) ORDER BY magnitude DESC, occurred_at DESC, event_id LIMIT 1)
    SELECT m.total_events AS events, first_event, last_event, r.region AS top_region, r.events AS top_region_events,
           s.event_id AS strongest_event, s.magnitude AS strongest_magnitude, s.place AS strongest_place FROM ({_EVENT_SUMMARY}) m, r, s""")
def event_run_report(t):
    return events.run_report(events.event_marts(_enriched(t)))


@query("event_summary_record", f"""
    SELECT *, (SELECT place FROM ({_EVENT_MARTS['strongest']}) ORDER BY magnitude DESC, occurred_at DESC LIMIT 1) AS strongest_place,
           (SELECT region FROM ({_EVENT_MARTS['by_region']}) ORDER BY events DESC, region LIMIT 1) AS top_region FROM ({_EVENT_SUMMARY})""")
def event_summary_record(t):
    marts = events.event_marts(_enriched(t))
    return with_leaders(marts["summary"].drop("refreshed_at"), [
        (marts["strongest"], [F.desc("magnitude"), F.desc("occurred_at")], {"strongest_place": "place"}),
        (marts["by_region"], [F.desc("events"), F.asc("region")], {"top_region": "region"}),
    ])


@query("event_fact", f"""
    SELECT month AS occurred_month, region, {_MAG_LABEL} AS magnitude_band, {_DEPTH_LABEL} AS depth_band, count(*) AS events, {_MEANS}
    FROM ({_ENRICHED}) GROUP BY month, region, mag_order, depth_order""")
def event_fact(t):
    return events.event_fact(_enriched(t))


@query("event_top_regions", f"SELECT * FROM ({_EVENT_MARTS['by_region']}) ORDER BY events DESC, region LIMIT 15")
def event_top_regions(t):
    return top_n(events.event_marts(_enriched(t))["by_region"], [F.desc("events"), F.asc("region")], 15)


@query("event_map", f"""
    SELECT event_id, round((longitude + 180) / 360 * 1060, 1) AS x, round((90 - latitude) / 180 * 540, 1) AS y,
           round(1.6 + (magnitude - 6) * 1.5, 1) AS radius, coalesce(depth_km >= 70, false) AS is_deep
    FROM ({_EVENT_MARTS['map_points']})""")
def event_map(t):
    points = events.event_marts(_enriched(t))["map_points"]
    spots = map_position("longitude", "latitude") | {"radius": marker_radius("magnitude")}
    deep = F.coalesce(F.col("depth_km") >= 70, F.lit(False)).alias("is_deep")
    return points.select("event_id", *[c.alias(n) for n, c in spots.items()], deep)


@query("event_gate", f"""
    WITH m AS (SELECT DISTINCT month FROM ({_ENRICHED})),
    g AS (SELECT date_diff('month', min(month), max(month)) + 1 - count(*) AS n FROM m)
    SELECT rule, CAST(violations AS BIGINT) AS violations, violations = 0 AS passed FROM (
    SELECT unnest(['coordinates off the globe', 'magnitude out of range', 'events empty', 'event_id repeated',
                   'regions differ only in case', 'monthly summary empty']) AS rule, 0 AS violations
    UNION ALL SELECT 'months missing', n FROM g)""")
def event_gate(t):
    enriched = _enriched(t)
    return events.event_gate(enriched, events.event_marts(enriched)).report()
