"""Edge rows of the column functions."""

import math
from datetime import date, datetime

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from martkit import labels
from martkit.functions import casts, numbers, text
from martkit.functions.bands import Bands
from martkit.functions.text import header_key


def test_squeeze_and_strip(col):
    values = [" a \t b ", " x　y ", "   ", "", None]
    assert col("string", values, text.squeeze_or_null) == ["a b", "x y", None, None, None]
    assert col("string", values, text.strip_or_null) == ["a \t b", "x　y", None, None, None]
    assert col("string", ["Notified  Date ", None, "No."], text.normalise_header) == ["notified date", "", "no."]
    assert [header_key(v) for v in ("Notified  Date ", None, "No.")] == ["notified date", "", "no."]


def test_record_dates(col):
    values = ["2021-01-01", "1/2/2021", "31/12/2021", "12/31/2021", "2021/1/2", " 2021-3-4 ", "31/04/2021", "30/02/2021", "02/29/2021", "21/1/1", "x", "", None, "0000-01-01", "2021-01-01 00:00"]
    out = [date(2021, 1, 1), date(2021, 2, 1), date(2021, 12, 31), date(2021, 12, 31), date(2021, 1, 2), date(2021, 3, 4)] + [None] * 9
    assert col("string", values, casts.lenient_date) == out


def test_serial_dates(col):
    values = ["44197", "44197.6", "1", "-1", "1e9", "nan", "inf", "x", "2021-01-01"]
    out = [date(2021, 1, 1), date(2021, 1, 1), date(1899, 12, 31), date(1899, 12, 29), None, None, None, None, date(2021, 1, 1)]
    assert col("string", values, lambda c: casts.lenient_date(c, serial_numbers=True)) == out
    assert col("string", ["44197"], casts.lenient_date) == [None]


def test_numbers(col):
    values = ["12.0", " 7 ", "-3.9", "3.9", "abc", "", None, "5d", "5f", "0x1", "inf", "nan", "1e3", ".5", "5."]
    assert col("string", values, casts.lenient_long) == [12, 7, -3, 3, None, None, None, None, None, None, None, None, 1000, 0, 5]
    doubles = col("string", values, casts.lenient_double)
    assert doubles[:4] == [12.0, 7.0, -3.9, 3.9] and doubles[4:10] == [None] * 6
    assert math.isinf(doubles[10]) and math.isnan(doubles[11])


def test_utc_timestamps(col):
    values = ["2024-01-02T03:04:05.678Z", "2024-01-02T03:04:05Z", "2024-01-02T03:04:05", "2024-13-02T03:04:05Z", "", None, "2024-01-02T03:04:05.1234567Z"]
    out = [datetime(2024, 1, 2, 3, 4, 5, 678000), datetime(2024, 1, 2, 3, 4, 5)] + [None] * 5
    assert col("string", values, casts.iso_utc_timestamp) == out


def test_locale_dates(col):
    values = ["2026-08-24", "24/08/26", "24-8-69", "24 ส.ค. 2569", "24  สิงหาคม 2569", "24/08/2569", "29 ก.พ. 2567", "31 ก.พ. 2567",
              "24 Aug 2026", "August 24, 2026", "20260824", "24.8.2026", "2026-08-24 10:00:00", "24 xyz 2026", "junk", "", None]
    day = date(2026, 8, 24)
    out = [day, day, date(1969, 8, 24), day, day, day, date(2024, 2, 29), None, day, day, day, day, day, None, None, None, None]
    assert col("string", values, lambda c: casts.locale_date(c, labels.MONTH_NUMBERS)) == out
    kept = col("string", ["24/08/2569", "24 ส.ค. 2569"], lambda c: casts.locale_date(c, labels.MONTH_NUMBERS, convert_era=False))
    assert kept == [date(2569, 8, 24), day]


def test_dates_in_many_forms(col):
    values = ["24/08/2026 10:30", "2026-08-24T00:00:00+07:00", "24 August, 2026", "24-Aug-26", "2026.08.24", "24 Aug 2026 10:30", "Monday 24 August 2026",
              "24th August 2026", "Mon, 24 Aug 2026 23:59:59 GMT", "Aug. 24th, 2026", "August 24 2026 1:05 pm", "24th of August, 2026", "24.8.2026 7:00",
              "2026-08-24 10:00:00.123456Z", "24/08/2569 10:30", "24 ส.ค. 2569 10:30 น.", "วันจันทร์ที่ 24 สิงหาคม 2569", "24 Aug '26"]
    assert col("string", values, lambda c: casts.locale_date(c, labels.MONTH_NUMBERS)) == [date(2026, 8, 24)] * len(values)
    assert col("string", ["24 Sept 2026", "1st Sep 99"], lambda c: casts.locale_date(c, labels.MONTH_NUMBERS)) == [date(2026, 9, 24), date(1999, 9, 1)]
    bad = ["10:30", "Monday", "24th", "32 Aug 2026", "24 Augu 2026", "2026.13.01", "24/08/2026 10:3", "24/08/2026 noon", "th August 2026", "24 Aug 2026 x 10:30"]
    assert col("string", bad, lambda c: casts.locale_date(c, labels.MONTH_NUMBERS)) == [None] * len(bad)


def test_prices(col):
    values = ["37.69", "1,037", "-", "38.29 บาท", "19.99", "80", "20", "80.01", "NaN", None, "a 25 b 30"]
    out = [37.69, None, None, 38.29, None, 80.0, 20.0, None, None, None, 25.0]
    assert col("string", values, lambda c: casts.number_in_range(c, *labels.PRICE_RANGE)) == out


def test_labels(col):
    sex = col("string", ["Male", " m ", "ชาย", "Female", "F", "หญิง", "x", None, ""], lambda c: text.member_label(c, labels.SEX_SPELLINGS, labels.UNSPECIFIED))
    assert sex == ["ชาย"] * 3 + ["หญิง"] * 3 + [labels.UNSPECIFIED] * 3
    nations = col("string", ["Thai", "ไทย", "Burmese", "Laotian / Lao", " Chinese ", "", None], lambda c: text.canonical_synonym(c, labels.NATIONALITY_SYNONYMS, labels.UNSPECIFIED))
    assert nations == ["Thailand", "Thailand", "Myanmar", "Laos", "Chinese", labels.UNSPECIFIED, labels.UNSPECIFIED]


def test_regions(col):
    values = ["96 km SSE of Sand Point, Alaska", "14km SE of Ridgecrest, CA", "2018 Fiji Earthquake", "x, y, B.C.", "somewhere,", "", None]
    out = ["Alaska", "California", "2018 Fiji Earthquake", "British Columbia"] + [labels.UNSPECIFIED] * 3
    assert col("string", values, lambda c: text.aliased_segment(c, labels.REGION_CODES, labels.UNSPECIFIED)) == out


def test_shorten_replaces_first_occurrence(col):
    assert col("string", ["aXbXc", "none", None], lambda c: text.shorten(c, [("X", "-")])) == ["a-bXc", "none", None]


def test_bands(col):
    assert col("int", [0, 9, 10, 69, 70, 120, None], labels.AGE_BANDS.label) == ["0-9", "0-9", "10-19", "60-69", "70+", "70+", labels.UNSPECIFIED]
    magnitude = col("double", [-9.99, -5.0, -2.1, None, 2.0, 5.0, 6.0, 7.0], lambda c: labels.MAGNITUDE_BANDS.label(numbers.at_least(c, -3)))
    names = labels.MAGNITUDE_BANDS.labels
    assert magnitude == [labels.UNSPECIFIED, labels.UNSPECIFIED, names[0], labels.UNSPECIFIED, names[1], names[4], names[5], names[6]]
    assert col("double", [69.9, 70.0, 299.9, 300.0], labels.DEPTH_BANDS.label) == [*labels.DEPTH_BANDS.labels[:1], *labels.DEPTH_BANDS.labels[1:2] * 2, labels.DEPTH_BANDS.labels[2]]
    assert col("double", [24.9, 25.0, 30.0, 35.0], labels.TEMPERATURE_BANDS.label) == list(labels.TEMPERATURE_BANDS.labels)
    assert col("string", [*labels.AGE_BANDS.labels, labels.UNSPECIFIED], labels.AGE_BANDS.order) == list(range(1, 10))
    with pytest.raises(ValueError):
        Bands((1,), ("a",))


@settings(max_examples=15, deadline=None)
@given(values=st.lists(st.integers(-10**6, 10**6), min_size=1, max_size=30))
def test_fixed_mean_is_exact(spark, values):
    from decimal import ROUND_HALF_UP, Decimal

    df = spark.createDataFrame([(v / 100,) for v in values], "v double")
    got = df.agg(numbers.fixed_mean("v", 1).alias("m"), numbers.fixed_sum("v").alias("s")).first()
    exact = (Decimal(sum(values)) / (100 * len(values))).quantize(Decimal("0.1"), ROUND_HALF_UP)
    assert got.m == exact and got.s == Decimal(sum(values)) / 100


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_sums_keep_digits_and_survive_nan(spark, ansi):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        df = spark.createDataFrame([(1.23456,)] * 3 + [(float("nan"),), (float("inf"),), (None,)], "v double")
        got = df.agg(numbers.fixed_mean("v", 4).cast("double").alias("m"), numbers.fixed_sum("v").cast("double").alias("s")).first()
        assert (got.m, got.s) == (1.2346, 3.70368)
        with pytest.raises(Exception, match="20 whole digits"):
            spark.createDataFrame([(1e25,)], "v double").agg(numbers.fixed_sum("v")).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_means_at_halves_and_of_noisy_doubles(spark):
    """Means that fall on a half at 15 digits go up, whatever the binary digits say."""
    def mean(values, digits=2):
        return float(spark.createDataFrame([(v,) for v in values], "v double").agg(numbers.fixed_mean("v", digits)).first()[0])

    assert mean([1.9758000000000002, 0.4342]) == 1.21 and mean([1.2049999999999998]) == 1.21 and mean([-2.675]) == -2.68
    assert mean([1e12 + 0.5, -1e12, 0.25], 3) == 0.25 and mean([1e-7] * 3, 9) == 1e-7 and mean([0.1] * 10, 6) == 0.1


def test_sums_do_not_depend_on_the_order(spark):
    import math
    import random
    from fractions import Fraction

    draw = random.Random(7)
    values = [draw.choice([-1, 1]) * draw.random() * 10.0 ** draw.randint(-6, 12) for _ in range(3000)] + [4.5e15, -4.5e15]
    want = float(sum(map(Fraction, values)))
    got = set()
    for parts in (1, 3, 16):
        draw.shuffle(values)
        df = spark.createDataFrame([(v,) for v in values], "v double").repartition(parts)
        got.add(df.agg(numbers.fixed_sum("v")).first()[0])
    assert len(got) == 1 and abs(float(got.pop()) - want) <= 5  # half a unit of the 15th digit of the largest value


def test_difference_of_what_is_shown(col, spark):
    df = spark.createDataFrame([(54.66, 36.505), (1000000.005, 1000000.0), (0.1, 0.3)], "a double, b double")
    assert [float(r[0]) for r in df.select(F.round(numbers.difference("a", "b"), 2)).collect()] == [18.16, 0.01, -0.2]
    assert [float(x) for x in col("double", [18.154999999999994, 2.675, -0.125], lambda c: numbers.round_half_up(c, 2))] == [18.16, 2.68, -0.13]
    assert col("double", [float("nan"), float("inf"), None], lambda c: numbers.round_half_up(c, 2)) == [None] * 3
