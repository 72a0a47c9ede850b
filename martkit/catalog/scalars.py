"""Scalar functions over texts that Spark derives from the test tables.

Each query renders known values as text in several ways, row by row, and parses the text back; the SQL starts
from the known values, so it does not repeat the parsing.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from martkit import labels
from martkit.catalog import half_up_sql, query, units_sql
from martkit.functions import casts, chart, numbers, text
from martkit.functions.dates import month_start
from martkit.operators.marts import count_by
from martkit.sinks.export import as_records


def _variant(n: int, key: str):
    """0 .. n-1 by key: which rendering a row gets. Every row gets one."""
    return F.pmod(F.col(key), F.lit(n))


def _choose(variant, *options):
    out = F.when(variant == 0, options[0])
    for i, option in enumerate(options[1:], 1):
        out = out.when(variant == i, option)
    return out


# --- texts -----------------------------------------------------------------------------------------------


@query("header_normalise", """
    SELECT c_custkey, lower(c_mktsegment) || ' ' || lower(replace(c_name, '#', ' ')) AS header FROM customer""")
def header_normalise(t):
    raw = F.concat(F.lit(" \t"), "c_mktsegment", F.lit("  \n"), F.replace("c_name", F.lit("#"), F.lit("  ")), F.lit("  "))
    return t.customer.select("c_custkey", text.normalise_header(raw).alias("header"))


@query("squeeze_text", """
    SELECT doc_id, nullif(trim(regexp_replace(text, '[\\s\\x{00A0}\\x{0085}\\x{1680}\\x{2000}-\\x{200A}\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}]+', ' ', 'g')), '') AS squeezed
    FROM documents""")
def squeeze_text(t):
    return t.documents.select("doc_id", text.squeeze_or_null("text").alias("squeezed"))


@query("strip_blank", """
    SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 2 THEN NULL ELSE o_orderpriority END AS priority FROM orders""")
def strip_blank(t):
    padded = _choose(
        _variant(3, "o_orderkey"), F.concat(F.lit("　 "), "o_orderpriority", F.lit("\t")), F.col("o_orderpriority"), F.lit("  ")
    )
    return t.orders.select("o_orderkey", text.strip_or_null(padded).alias("priority"))


@query("squash_match", """
    SELECT p_partkey, p_name LIKE '% ring' OR p_name LIKE '% bolt' AS is_ring_or_bolt,
           lower(replace(p_name, ' ', '')) AS squashed FROM part""")
def squash_match(t):
    raw = F.upper(F.replace("p_name", F.lit(" "), F.lit("   ")))
    hit = text.mentions(raw, "ring") | text.mentions(raw, "bolt")
    return t.part.select("p_partkey", hit.alias("is_ring_or_bolt"), text.squash(raw).alias("squashed"))


@query("member_labels", """
    SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN 'ชาย' WHEN 1 THEN 'หญิง' ELSE 'ไม่ระบุ' END AS sex FROM orders""")
def member_labels(t):
    raw = _choose(_variant(4, "o_orderkey"), F.lit(" Male "), F.lit("หญิง"), F.lit("other"), F.lit(None).cast("string"))
    return t.orders.select("o_orderkey", text.member_label(raw, labels.SEX_SPELLINGS, labels.UNSPECIFIED).alias("sex"))


@query("synonyms", """
    SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN 'Thailand' WHEN 1 THEN 'Laos' WHEN 2 THEN 'ไม่ระบุ'
           WHEN 3 THEN o_orderpriority ELSE 'Myanmar' END AS nationality FROM orders""")
def synonyms(t):
    raw = _choose(
        _variant(5, "o_orderkey"), F.lit(" THAI"), F.lit("Laotian / Lao"), F.lit("  "),
        F.concat(F.lit(" "), "o_orderpriority", F.lit(" ")), F.lit("พม่า"),
    )
    known = text.canonical_synonym(raw, labels.NATIONALITY_SYNONYMS, labels.UNSPECIFIED)
    return t.orders.select("o_orderkey", known.alias("nationality"))


@query("default_labels", """
    SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN o_orderstatus ELSE 'ไม่ระบุ' END AS status FROM orders""")
def default_labels(t):
    raw = _choose(_variant(3, "o_orderkey"), F.concat(F.lit(" "), "o_orderstatus"), F.lit("   "), F.lit(None).cast("string"))
    return t.orders.select("o_orderkey", text.default_label(raw, labels.UNSPECIFIED).alias("status"))


@query("last_segment", """
    SELECT page_id, coalesce(nullif(trim(regexp_extract(url, '([^/]*)$', 1)), ''), 'none') AS segment FROM pages""")
def last_segment(t):
    return t.pages.select("page_id", text.aliased_segment("url", {"-": "-"}, "none", "/").alias("segment"))


@query("region_alias", """
    SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN 'California' WHEN 1 THEN 'British Columbia' WHEN 2 THEN p_name
           WHEN 3 THEN 'ไม่ระบุ' ELSE 'ไม่ระบุ' END AS region FROM part""")
def region_alias(t):
    place = _choose(
        _variant(5, "p_partkey"), F.concat("p_name", F.lit(", x, CA ")), F.concat("p_name", F.lit(",B.C.")), F.col("p_name"),
        F.concat("p_name", F.lit(" ,")), F.lit(None).cast("string"),
    )
    known = text.aliased_segment(place, labels.REGION_CODES, labels.UNSPECIFIED)
    return t.part.select("p_partkey", known.alias("region"))


@query("label_shortening", """
    SELECT event_id, CASE WHEN value < 2 THEN '<2.0' WHEN value < 3 THEN '2.0 - 2.9' WHEN value < 4 THEN '3.0 - 3.9'
           WHEN value < 5 THEN '4.0 - 4.9' WHEN value < 6 THEN '5.0 - 5.9' WHEN value < 7 THEN '6.0 - 6.9' ELSE '7.0 +' END AS magnitude,
           CASE WHEN value < 70 THEN 'ตื้น' WHEN value < 300 THEN 'ปานกลาง' ELSE 'ลึก' END AS depth FROM events""")
def label_shortening(t):
    short = [
        text.shorten(bands.label("value"), labels.BAND_SHORTENINGS).alias(name)
        for name, bands in (("magnitude", labels.MAGNITUDE_BANDS), ("depth", labels.DEPTH_BANDS))
    ]
    return t.events.select("event_id", *short)


@query("temperature_bands", """
    SELECT event_id, CASE WHEN value >= 35 THEN 'ร้อนจัด' WHEN value >= 30 THEN 'ร้อน' WHEN value >= 25 THEN 'อากาศดี'
           ELSE 'เย็น' END AS category FROM events""")
def temperature_bands(t):
    return t.events.select("event_id", labels.TEMPERATURE_BANDS.label("value").alias("category"))


@query("age_bands", """
    SELECT event_id, CASE WHEN a IS NULL THEN 'ไม่ระบุ' WHEN a >= 70 THEN '70+'
           ELSE (a // 10 * 10)::VARCHAR || '-' || (a // 10 * 10 + 9)::VARCHAR END AS age_group
    FROM (SELECT event_id, CASE WHEN floor(value) <= 120 THEN CAST(floor(value) AS INTEGER) END AS a FROM events)""")
def age_bands(t):
    age = numbers.within(F.floor("value").cast("int"), *labels.AGE_RANGE)
    return t.events.select("event_id", labels.AGE_BANDS.label(age).alias("age_group"))


# --- dates and times -------------------------------------------------------------------------------------


@query("lenient_dates", """
    SELECT o_orderkey, CASE o_orderkey % 7 WHEN 2 THEN CASE WHEN day(d) <= 12 THEN make_date(year(d), day(d), month(d)) ELSE d END
           WHEN 4 THEN NULL WHEN 5 THEN NULL ELSE d END AS parsed
    FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders)""")
def lenient_dates(t):
    def as_text(pattern):
        return F.date_format("o_orderdate", pattern)

    raw = _choose(
        _variant(7, "o_orderkey"), as_text("yyyy-MM-dd"), as_text("d/M/yyyy"), as_text("MM/dd/yyyy"), as_text("yyyy/MM/dd"),
        as_text("yyyy.MM.dd"), F.lit(" "), F.datediff("o_orderdate", F.lit(casts.SERIAL_EPOCH).cast("date")).cast("string"),
    )
    return t.orders.select("o_orderkey", casts.lenient_date(raw, serial_numbers=True).alias("parsed"))


@query("locale_dates", """
    SELECT o_orderkey, CASE WHEN o_orderkey % 20 = 7 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS parsed FROM orders""")
def locale_dates(t):
    d = F.col("o_orderdate")
    era_year = (F.year(d) + 543).cast("string")
    names = [F.element_at(F.array(*[F.lit(n) for n in months]), F.month(d)) for months in (labels.MONTHS_SHORT, labels.MONTHS_LONG)]
    raw = _choose(
        _variant(20, "o_orderkey"), F.date_format(d, "yyyy-MM-dd"), F.date_format(d, "dd/MM/yy"), F.date_format(d, "d-M-yyyy"),
        F.concat_ws(" ", F.dayofmonth(d), names[0], era_year), F.concat_ws("  ", F.dayofmonth(d), names[1], era_year),
        F.date_format(d, "d MMM yyyy"), F.concat_ws("/", F.date_format(d, "d/M"), era_year), F.lit("junk"),
        F.date_format(d, "dd/MM/yyyy HH:mm"), F.date_format(d, "yyyy-MM-dd'T23:30:00+07:00'"), F.date_format(d, "d MMMM, yyyy"),
        F.date_format(d, "d MMM yyyy 'at' h:mm a"), F.date_format(d, "dd-MMM-yy"), F.date_format(d, "yyyy.MM.dd"), F.date_format(d, "EEEE d MMMM yyyy"),
        F.concat(F.dayofmonth(d), F.lit("th "), F.date_format(d, "MMMM yyyy")), F.date_format(d, "EEE, d MMM yyyy HH:mm:ss 'GMT'"),
        F.concat(F.date_format(d, "MMMM d"), F.lit("st, "), F.year(d)), F.concat(F.date_format(d, "d "), F.when(F.month(d) == 9, "Sept").otherwise(F.date_format(d, "MMM")), F.date_format(d, ". yyyy")),
        F.concat(F.lit("วันจันทร์ที่ "), F.concat_ws(" ", F.dayofmonth(d), names[1], era_year), F.lit(" 10:30 น.")),
    )
    # a leap day written with an era year still is one
    return t.orders.select("o_orderkey", casts.locale_date(raw, labels.MONTH_NUMBERS).alias("parsed"))


@query("iso_timestamps", """
    SELECT event_id, CASE event_id % 3 WHEN 0 THEN date_trunc('millisecond', ts) WHEN 1 THEN date_trunc('second', ts) END AS parsed
    FROM events""")
def iso_timestamps(t):
    raw = _choose(
        _variant(3, "event_id"), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss"),
    )
    return t.events.select("event_id", casts.iso_utc_timestamp(raw).alias("parsed"))


@query("local_time", "SELECT event_id, ts + INTERVAL 7 HOUR AS local_ts FROM events")
def local_time(t):
    return t.events.select("event_id", casts.local_wall_time("ts").alias("local_ts"))


@query("date_parts", """
    SELECT event_id, CAST(ts AS DATE) AS day, CAST(date_trunc('month', ts) AS DATE) AS month FROM events""")
def date_parts(t):
    return t.events.select("event_id", F.to_date("ts").alias("day"), month_start("ts").alias("month"))


# --- numbers ---------------------------------------------------------------------------------------------


@query("lenient_numbers", """
    SELECT event_id, CASE event_id % 4 WHEN 0 THEN value WHEN 1 THEN value END AS number,
           CASE event_id % 4 WHEN 0 THEN CAST(trunc(value) AS BIGINT) WHEN 1 THEN CAST(trunc(value) AS BIGINT) END AS whole
    FROM events""")
def lenient_numbers(t):
    plain = F.col("value").cast("decimal(10,2)").cast("string")
    raw = _choose(_variant(4, "event_id"), plain, F.concat(F.lit(" +"), plain, F.lit(" ")), F.concat(plain, F.lit("d")), F.lit(""))
    return t.events.select("event_id", casts.lenient_double(raw).alias("number"), casts.lenient_long(raw).alias("whole"))


@query("first_number", """
    SELECT doc_id, CASE WHEN n BETWEEN 20 AND 80 THEN n END AS price FROM (
    SELECT doc_id, CASE WHEN lower(trim(replace(text, ',', ''), ' \n\t\r')) IN ('', '-', 'nan', 'none', 'null') THEN NULL
           ELSE TRY_CAST(nullif(regexp_extract(replace(text, ',', ''), '[0-9]+(?:\\.[0-9]+)?'), '') AS DOUBLE) END AS n FROM documents)""")
def first_number(t):
    return t.documents.select("doc_id", casts.number_in_range("text", *labels.PRICE_RANGE).alias("price"))


@query("range_to_null", "SELECT event_id, CASE WHEN value BETWEEN 0 AND 120 THEN value END AS value FROM events")
def range_to_null(t):
    return t.events.select("event_id", numbers.within("value", *labels.AGE_RANGE).alias("value"))


@query("sentinel_to_null", """
    SELECT event_id, CASE event_id % 3 WHEN 0 THEN value WHEN 2 THEN -2.1 END AS magnitude FROM events""")
def sentinel_to_null(t):
    raw = _choose(_variant(3, "event_id"), F.col("value"), F.lit(-9.99), F.lit(-2.1))
    return t.events.select("event_id", numbers.at_least(raw, labels.MAGNITUDE_FLOOR).alias("magnitude"))


@query("round_half_up", f"""
    SELECT event_id, {half_up_sql(units_sql('value'), '1', 2, 1)} AS rounded FROM events""")
def round_half_up(t):
    return t.events.select("event_id", numbers.round_half_up("value", 1).alias("rounded"))


@query("array_map_sum", """
    SELECT event_id, n * 2 AS first_doubled, CAST(n * 2 + event_id * 2 + user_id * 2 AS BIGINT) AS total
    FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS n FROM events)""")
def array_map_sum(t):
    k = F.from_json("props", "k bigint")["k"]
    doubled, total = numbers.doubled_sum(F.array(k, "event_id", "user_id"))
    return t.events.select("event_id", F.get(doubled, F.lit(0)).alias("first_doubled"), total.alias("total"))


@query("json_props", """
    SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events""")
def json_props(t):
    return t.events.select("event_id", F.from_json("props", "k int")["k"].alias("k"))


@query("json_records", """
    SELECT '{"o_orderkey":' || o_orderkey || ',"day":"' || strftime(o_orderdate, '%Y-%m-%d') || '","at":"'
           || strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') || '","status":"' || o_orderstatus || '","note":null}' AS record
    FROM orders""")
def json_records(t):
    return as_records(t.orders.select(
        "o_orderkey", F.to_date("o_orderdate").alias("day"), F.col("o_orderdate").alias("at"),
        F.col("o_orderstatus").alias("status"), F.lit(None).cast("string").alias("note"),
    ))


# --- chart values ----------------------------------------------------------------------------------------

_LON, _LAT = "(c_custkey % 360 - 180)", "(c_custkey % 181 - 90)"


@query("map_projection", f"""
    SELECT c_custkey, {half_up_sql(f'(({_LON} + 180) * 1060)', '360', 0, 1)} AS x,
           {half_up_sql(f'((90 - {_LAT}) * 540)', '180', 0, 1)} AS y,
           {half_up_sql('(160 + (c_custkey % 20) * 30)', '1', 2, 1)} AS radius, abs(c_acctbal) >= 70 AS is_deep
    FROM customer ORDER BY radius""")
def map_projection(t):
    lon, lat = F.pmod("c_custkey", F.lit(360)) - 180, F.pmod("c_custkey", F.lit(181)) - 90
    magnitude = F.lit(6) + F.pmod("c_custkey", F.lit(20)) / 5
    spots = chart.map_position(lon, lat) | {"radius": chart.marker_radius(magnitude)}
    return t.customer.select(
        "c_custkey", *[c.alias(n) for n, c in spots.items()], (F.abs("c_acctbal") >= 70).alias("is_deep")
    ).orderBy("radius")


_DAYS = "SELECT CAST(o_orderdate AS DATE) AS day, count(*) AS n FROM orders GROUP BY 1"


@query("axis_ticks", f"""
    WITH d AS ({_DAYS}), f AS (SELECT unnest([0.0, 0.25, 0.5, 0.75, 1.0])::DOUBLE AS fraction)
    SELECT fraction, CAST(floor((SELECT max(n) FROM d) * fraction + 0.5) AS BIGINT) AS tick FROM f""")
def axis_ticks(t):
    return chart.axis_ticks(count_by(t.orders, [F.to_date("o_orderdate").alias("day")]), "n")


@query("bar_fraction", f"""
    WITH d AS ({_DAYS}) SELECT day, n, n::DOUBLE / (SELECT max(n) FROM d) AS fraction FROM d""")
def bar_fraction(t):
    return chart.bar_fraction(count_by(t.orders, [F.to_date("o_orderdate").alias("day")]), "n")
