"""Operators against brute force on small fixtures."""

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from martkit.functions.numbers import fixed_mean
from martkit.operators import calendar, dedupe, marts, ranking, star, windows
from martkit.operators.quality import Gate, QualityError, RowRule, off_globe, out_of_range, require_rows
from martkit.sources.tabular import MissingSource, check_files, drop_blank, list_files, map_headers, read_harmonised


def _days(spark, counts, start=date(2021, 1, 1)):
    rows = [(start + timedelta(days=i), n) for i, n in enumerate(counts) if n is not None]
    return spark.createDataFrame(rows, "day date, n bigint")


def test_moving_average_over_rows_not_days(spark):
    rows = [(date(2020, 1, 12), 1), (date(2020, 1, 17), 1), (date(2020, 1, 22), 2), (date(2020, 1, 24), 1)]
    out = windows.moving_average_rows(spark.createDataFrame(rows, "day date, n bigint"), "n").orderBy("day").collect()
    assert [float(r.moving_avg) for r in out] == [1.0, 1.0, 1.3, 1.3]


def test_three_seven_day_averages_differ(spark):
    daily = _days(spark, [7, None, None, 14, None, None, None, None, 7])
    last = date(2021, 1, 9)
    spine = calendar.day_spine(daily, "day")
    pick = lambda df, c: float(df.where(F.col("day") == F.lit(last)).first()[c])
    assert pick(windows.moving_average_rows(daily, "n"), "moving_avg") == 9.3
    assert pick(windows.calendar_average(daily, spine, "n"), "calendar_avg") == 3.0
    assert pick(windows.present_average(daily, "n", digits=1), "present_avg") == 10.5


def _greedy(values, count, apart):
    picks = []
    for i in sorted(range(len(values)), key=lambda i: (-values[i], i)):
        if len(picks) < count and all(abs(p - i) > apart for p in picks):
            picks.append(i)
    return sorted(picks)


@pytest.mark.parametrize("seed", range(4))
def test_peaks_equal_greedy_choice(spark, seed):
    rng = random.Random(seed)
    values = [rng.randint(0, 20) for _ in range(rng.choice([1, 40, 200]))]
    got = windows.peaks(_days(spark, values), "n", count=3, apart=15).orderBy("day").collect()
    assert [r.position for r in got] == _greedy(values, 3, 15)


def test_lags_and_holdout(spark):
    prices = [float(x) for x in range(1, 14)]
    df = spark.createDataFrame([(date(2021, 1, 1) + timedelta(days=2 * i), p) for i, p in enumerate(prices)], "day date, price double")
    rows = windows.ordered_holdout(windows.lag_features(df, "price")).orderBy("day").collect()
    assert len(rows) == 8 and [r.lag_1 for r in rows][:2] == [5.0, 6.0] and rows[0].lag_5 == 1.0 and rows[0].lag_mean == 3.0
    assert [r.is_holdout for r in rows] == [False] * 3 + [True] * 5
    latest = windows.latest_features(df, "price").first()
    assert [latest[f"lag_{k}"] for k in range(1, 6)] == [13.0, 12.0, 11.0, 10.0, 9.0] and latest.lag_mean == 11.0
    assert windows.latest_features(df.limit(4), "price").count() == 0


def test_year_markers(spark):
    df = spark.createDataFrame([(date(2020, 12, 30),), (date(2021, 1, 2),), (date(2021, 5, 1),), (date(2023, 1, 1),)], "day date")
    marks = windows.year_markers(df).orderBy("day").collect()
    assert [(r.position, r.year_be) for r in marks] == [(0, 2563), (1, 2564), (3, 2566)]
    assert [r.year_ce for r in windows.year_markers(df, every=2).orderBy("day").collect()] == [2020, 2023]


@pytest.mark.parametrize("hot", [0, 700])
def test_rank_all_equals_one_window(spark, hot):
    """Also when many rows tie on the measure, as a hot value does."""
    rng = random.Random(hot)
    rows = [(i, 1 if i < hot else rng.randint(1, 50)) for i in range(2000)]
    df = spark.createDataFrame(rows, "e int, n int").repartition(7)
    order = [F.col("n").desc(), F.col("e").asc()]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = {(r.e, r["rank"]) for r in ranking.rank_all(df, order).collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    want = {(r.e, r.k) for r in df.select("e", F.row_number().over(Window.orderBy(*order)).alias("k")).collect()}
    assert got == want


def test_keep_first_and_precedence(spark):
    df = spark.createDataFrame([(1, 2, "a"), (1, 1, "b"), (2, 5, "c"), (1, 1, "a")], "k int, o int, v string")
    assert {(r.k, r.v) for r in dedupe.keep_first(df, ["k"], ["o"]).collect()} == {(1, "a"), (2, "c")}
    assert {(r.k, r.v) for r in dedupe.keep_last(df, ["k"], ["o"]).collect()} == {(1, "a"), (2, "c")}
    low, high = df.limit(0).union(df), spark.createDataFrame([(1, 0, "high")], "k int, o int, v string")
    merged = dedupe.merge_by_precedence([low, high], ["k"], ["o"])
    assert {(r.k, r.v) for r in merged.collect()} == {(1, "high"), (2, "c")}


def test_canonical_label_ties_take_binary_order(spark):
    rows = [("off the coast",)] * 2 + [("Off the coast",)] * 2 + [("Fiji",), ("FIJI",), ("FIJI",)]
    df = spark.createDataFrame(rows, "r string")
    got = {r.r_key: r.r_label for r in dedupe.canonical_labels(df, "r").collect()}
    assert got == {"off the coast": "Off the coast", "fiji": "FIJI"}
    applied = marts.count_by(dedupe.apply_canonical(df, "r"), "r").collect()
    assert {(r.r, r.n) for r in applied} == {("Off the coast", 4), ("FIJI", 3)}


def test_spines_of_nothing_are_empty(spark):
    empty = spark.createDataFrame([], "day date")
    assert calendar.day_spine(empty, "day").count() == 0 and calendar.month_spine(empty, "day").count() == 0


def test_gate_reports_every_problem(spark):
    df = spark.createDataFrame([(1, -1, 95.0, 0.0), (1, 5, None, 500.0), (2, None, 0.0, 0.0)], "k int, age int, lat double, lon double")
    months = spark.createDataFrame([(date(2021, 1, 1),), (date(2021, 4, 1),)], "month date")
    labels = spark.createDataFrame([("a",), ("A",)], "label string")
    gate = (
        Gate()
        .rows(df, [RowRule("age", out_of_range("age", 0, 120)), RowRule("globe", off_globe("lat", "lon"))], not_empty="empty")
        .unique(df, ["k"], "key").unique(labels, ["label"], "case", fold_case=True)
        .no_missing_months(months, "months").at_least(df, 5, "short").not_empty(df.limit(0), "nothing")
    )
    report = {r.rule: r.violations for r in gate.report().collect()}
    assert report == {"age": 1, "globe": 1, "empty": 0, "key": 1, "case": 1, "months": 2, "short": 2, "nothing": 1}
    with pytest.raises(QualityError) as error:
        gate.enforce()
    assert all(name in str(error.value) for name in ("age", "globe", "key", "case", "months", "short", "nothing"))
    assert "empty" not in str(error.value)
    assert Gate().not_empty(df, "empty").enforce().first().passed
    with pytest.raises(QualityError):
        require_rows(df, 4, "rows")


def test_measures(spark):
    fact = spark.createDataFrame([("a", 3, 10.0), ("A", 1, None), ("b", 0, 2.0)], "r string, n bigint, d double")
    model = star.Star(fact, {})
    row = model.query({"w": star.weighted_mean("d", "n"), "r": star.distinct_labels("r", True), "s": star.total_in("n", "r", ["zz"]), "q": star.safe_share(star.total_in("n", "r", ["zz"]), star.total("n"))}).first()
    assert row.w == 7.5 and row.r == 2 and row.s is None and row.q is None
    days = spark.createDataFrame([(date(2021, 1, 1), 5), (date(2021, 1, 2), 5), (date(2021, 1, 3), 1)], "day date, n bigint")
    assert star.peak_day(days, "day", "n").first().peak_day == date(2021, 1, 2)


def test_slicer_filters_the_fact(spark):
    fact = spark.createDataFrame([(1, 5), (2, 7), (3, 9)], "k int, n bigint")
    dim = spark.createDataFrame([(1, 2540), (2, 2541)], "k int, y int")
    model = star.Star(fact, {"d": star.Dimension(dim, "k", "k")})
    assert model.query({"t": star.total("n")}, slicers={"d": F.col("y") == 2541}).first().t == 7
    by_year = {r.y: r.t for r in model.query({"t": star.total("n")}, by={"y": ("d", "y")}).collect()}
    assert by_year == {2540: 5, 2541: 7, None: 9}


def test_shares_and_extremes(spark):
    df = spark.createDataFrame([("a", 1), ("b", 1), ("c", 1)], "e string, n bigint")
    assert [float(r.share_pct) for r in marts.with_share(df, "n", 1).collect()] == [33.3] * 3
    best = marts.extremes(df, "e", "n").first()
    assert best.top_entity == "a" and best.low_entity == "a"
    assert df.agg(fixed_mean("n", 1)).first()[0] == 1


def test_header_rules(spark, tmp_path):
    aliases = {"no": "id", "no.": "id", "day": "day"}
    assert map_headers(["﻿No.", "x", " NO ", None, "Day"], aliases) == {"id": 0, "day": 4}
    (tmp_path / "a.csv").write_text("No.,Day,extra\n1,x,e\n", encoding="utf-8-sig")
    (tmp_path / "b.csv").write_text("day,no\ny,2\n")
    (tmp_path / "c.csv").write_text("day\ny\n")
    paths = [str(tmp_path / f) for f in ("a.csv", "b.csv")]
    rows = {tuple(r) for r in read_harmonised(spark, paths, aliases, ["id", "day", "risk"], ["id"]).collect()}
    assert rows == {("1", "x", None, "a.csv"), ("2", "y", None, "b.csv")}
    with pytest.raises(MissingSource, match="id"):
        read_harmonised(spark, [*paths, str(tmp_path / "c.csv")], aliases, ["id", "day"], ["id"])
    with pytest.raises(MissingSource, match="d.csv, e.csv"):
        check_files(spark, str(tmp_path), ["a.csv", "d.csv", "e.csv"])
    assert {r.file_name for r in check_files(spark, str(tmp_path), ["a.csv", "b.csv"]).collect()} == {"a.csv", "b.csv"}
    assert list_files(spark, str(tmp_path), "*.csv").count() == 3


def test_blank_rows_are_dropped(spark):
    df = spark.createDataFrame([(None, None, 1), (1, None, 2)], "a int, b int, c int")
    assert [r.c for r in drop_blank(df, ["a", "b"]).collect()] == [2]
