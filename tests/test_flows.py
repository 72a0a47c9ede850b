"""The composed flows end to end on small fixtures."""

import json
import zipfile
from datetime import date, datetime, timedelta
from pathlib import Path
from xml.sax.saxutils import escape

import numpy as np
import pytest
from pyspark.sql import functions as F

from martkit import labels
from martkit.operators import forecast
from martkit.operators.quality import QualityError
from martkit.operators.windows import lag_features, ordered_holdout
from martkit.plans import cases, events, prices, weather
from martkit.sinks import export, snapshots
from martkit.sources import html
from martkit.sources.tabular import MissingSource
from martkit.sources.workbook import read_workbooks, sheet_rows
from martkit.streaming import incremental

HEADER = ["No.", "announce date", "Notified  Date", "sex", "age", "unit", "nationality", "Province of Isolation", "risk", "province_of_onset", "district of onset"]
ROWS = [
    ["1", "44197", None, "Male", "5", "year", "Thai", "A", "x", None, "d"],
    ["2", "1/1/2021", "2021-01-02", "หญิง", "121", None, "Burmese", " ", None, None, " "],
    ["3", "2021/01/03", None, None, None, None, None, "B", None, None, None],
    ["3", "2021-01-02", None, "f", "70", None, "Laotian / Lao", "A", None, None, None],
    ["4", "2019-12-31", None, "m", "9", None, "Thai", "A", None, None, None],
    [None, "2021-01-04", None, "m", "9", None, "Thai", "A", None, None, None],
    [None, None, None, "m", None, None, None, None, None, None, None],
    ["abc", "x", None, None, None, None, None, "C", None, None, None],
]


def _workbook(path: Path, rows):
    """A minimal workbook: numbers as numbers, every other text shared or inline, empty cells left out."""
    shared, lines = [], []
    for r, row in enumerate(rows, 1):
        cells = []
        for c, value in enumerate(row):
            at = f"{chr(65 + c)}{r}"
            if value is None:
                continue
            if value.replace(".", "", 1).isdigit():
                cells.append(f'<c r="{at}"><v>{value}</v></c>')
            elif c % 2:
                shared.append(value)
                cells.append(f'<c r="{at}" t="s"><v>{len(shared) - 1}</v></c>')
            else:
                cells.append(f'<c r="{at}" t="inlineStr"><is><t xml:space="preserve">{escape(value)}</t></is></c>')
        lines.append(f'<row r="{r}">{"".join(cells)}</row>')
    main = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    rel = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    with zipfile.ZipFile(path, "w") as book:
        book.writestr("xl/workbook.xml", f'<workbook {main} xmlns:r="{rel}"><sheets><sheet name="s" sheetId="1" r:id="r9"/><sheet name="t" sheetId="2" r:id="r8"/></sheets></workbook>')
        book.writestr("xl/_rels/workbook.xml.rels", '<Relationships><Relationship Id="r8" Target="worksheets/sheet1.xml"/><Relationship Id="r9" Target="worksheets/sheet2.xml"/></Relationships>')
        book.writestr("xl/worksheets/sheet2.xml", f"<worksheet {main}><sheetData>{''.join(lines)}</sheetData></worksheet>")
        book.writestr("xl/sharedStrings.xml", f"<sst {main}>" + "".join(f"<si><r><t>{escape(t[:1])}</t></r><r><t>{escape(t[1:])}</t></r></si>" for t in shared) + "</sst>")


@pytest.fixture(scope="module")
def books(tmp_path_factory):
    folder = tmp_path_factory.mktemp("books")
    _workbook(folder / "old.xlsx", [HEADER, *ROWS[:4]])
    _workbook(folder / "new.xlsx", [[h for h in HEADER if h != "risk"], *[r[:8] + r[9:] for r in ROWS[3:]]])
    _workbook(folder / "bad.xlsx", [HEADER[1:], ROWS[0][1:]])
    _workbook(folder / "none.xlsx", [])
    return folder


def test_workbook_scan(spark, books):
    assert list(sheet_rows(str(books / "old.xlsx")))[0] == HEADER
    both = [str(books / f) for f in ("old.xlsx", "new.xlsx")]
    raw = read_workbooks(spark, both, labels.CASE_HEADERS, labels.CASE_COLUMNS, labels.CASE_REQUIRED)
    assert raw.rdd.getNumPartitions() == 2 and raw.count() == 9
    assert raw.where("source_file = 'new.xlsx' and risk is not null").count() == 0
    with pytest.raises(MissingSource, match="case_no"):
        read_workbooks(spark, [str(books / "bad.xlsx")], labels.CASE_HEADERS, labels.CASE_COLUMNS, labels.CASE_REQUIRED)
    with pytest.raises(ValueError, match="no data"):
        read_workbooks(spark, [str(books / "none.xlsx")], labels.CASE_HEADERS, labels.CASE_COLUMNS)


def _expect_cases(clean):
    rows = {r.case_no: r for r in clean.collect()}
    assert set(rows) == {1, 2, 3}
    assert rows[1].announce_date == date(2021, 1, 1) and rows[1].sex == "ชาย" and rows[1].age_group == "0-9" and rows[1].nationality == "Thailand"
    assert rows[2].age is None and rows[2].age_group == labels.UNSPECIFIED and rows[2].province == labels.UNSPECIFIED and rows[2].nationality == "Myanmar"
    assert rows[3].announce_date == date(2021, 1, 2) and rows[3].age_group == "70+" and rows[3].source_file.startswith("new")


def test_case_flow_from_workbooks(spark, books, tmp_path):
    paths = [str(books / f) for f in ("old.xlsx", "new.xlsx")]
    raw = cases.load_cases(spark, paths)
    assert raw.count() == 8  # the row that only has a sex is blank
    _expect_cases(cases.clean_cases(raw))
    manifest = {r.name: r.rows for r in cases.build_cases(spark, paths, str(tmp_path / "out")).collect()}
    assert manifest == {"fact_cases": 3, "dim_date": 2, "dim_province": 2, "dim_age_group": 3, "summary_daily": 2, "summary_overall": 1}
    marts = {n: spark.read.parquet(str(tmp_path / "out" / n)) for n in ("daily", "by_province", "by_age_group", "by_sex", "by_nationality", "summary")}
    total = marts["summary"].first().total_cases
    for name in ("daily", "by_province", "by_age_group", "by_sex", "by_nationality"):
        assert marts[name].agg(F.sum("cases")).first()[0] == total == 3
    report = cases.run_report(raw, spark.read.parquet(str(tmp_path / "out" / "cases")), marts).first()
    assert (report.loaded, report.clean, report.dropped) == (8, 3, 5) and float(report.avg_age) == 37.5
    text = next((tmp_path / "out" / "export" / "dim_age_group").glob("*.csv")).read_bytes()
    assert text.startswith(b"\xef\xbb\xbfage_group,sort_order,cases\n0-9,1,1\n")


def test_case_flow_from_csv(spark, tmp_path):
    def write(name, rows):
        (tmp_path / name).write_text("\n".join(",".join("" if v is None else v for v in r) for r in rows) + "\n", encoding="utf-8-sig")
        return str(tmp_path / name)

    serial_as_text = [["1", "2021-01-01", *ROWS[0][2:]], *ROWS[1:3]]
    paths = [write("old.csv", [HEADER, *serial_as_text]), write("new.csv", [HEADER, *ROWS[3:]])]
    _expect_cases(cases.clean_cases(cases.load_cases(spark, paths)))


def _event(i, at, mag, depth, place, kind="earthquake", lat="1.0", lon="2.0"):
    return (at, lat, lon, depth, mag, "ml", place, kind, "us", "reviewed", i, "2024-05-01T00:00:00.000Z")


EVENTS = [
    _event("a", "2024-01-05T01:02:03.500Z", "6.5", "70", "9 km N of X, CA"),
    _event("b", "2024-01-06T01:02:03Z", "-9.99", "", "off the coast of Oregon"),
    _event("c", "2024-02-01T00:00:00Z", "7", "300", "Off the coast of Oregon"),
    _event("d", "2024-02-02T00:00:00Z", "2.0", "69.9", "Off the coast of Oregon"),
    _event("e", "2024-02-03T00:00:00Z", "5", "x", "quarry, CA", kind="quarry blast"),
    _event(" ", "2024-02-03T00:00:00Z", "5", "1", "no id"),
    _event("f", "yesterday", "5", "1", "no time"),
]


def _land(spark, path, rows):
    from martkit.sources.feed import FEED_SCHEMA

    spark.createDataFrame(rows, FEED_SCHEMA).coalesce(1).write.mode("append").option("header", "true").csv(path)


def test_event_flow(spark, tmp_path):
    landing, table, out = (str(tmp_path / n) for n in ("landing", "events", "out"))
    _land(spark, landing, EVENTS)
    counts = incremental.load_window(incremental_feed(spark, landing), table, datetime(2024, 1, 1), datetime(2024, 3, 1))
    assert counts == {"attempted": 5, "rejected": 2, "distinct": 5, "in_window": 5}
    stored = snapshots.read(spark, table)
    manifest = {r.name: r.rows for r in events.build_events(spark, stored, out).collect()}
    assert manifest["dim_month"] == 2 and manifest["dim_region"] == 2 and manifest["strongest_events"] == 3
    marts = {n: {r[0]: r for r in spark.read.parquet(f"{out}/{n}").collect()} for n in ("monthly", "by_region", "by_magnitude", "by_depth")}
    assert marts["by_region"]["Off the coast of Oregon"].events == 3 and marts["by_region"]["California"].events == 1
    assert marts["monthly"][date(2024, 1, 1)].events_m5_plus == 1 and float(marts["monthly"][date(2024, 1, 1)].avg_magnitude) == 6.5
    assert sum(r.events for r in marts["by_magnitude"].values()) == sum(r.events for r in marts["by_depth"].values()) == 4
    assert {r.sort_order for r in marts["by_depth"].values()} == {1, 2, 3, 4}
    summary = spark.read.parquet(f"{out}/summary").first()
    assert (summary.total_events, summary.region_count, summary.events_m6_plus) == (4, 2, 2)
    strongest = next((tmp_path / "out" / "export" / "strongest_events").glob("*.csv")).read_text("utf-8-sig").splitlines()
    assert strongest[1] == "2024-02-01 00:00:00,7,300,Off the coast of Oregon,Off the coast of Oregon,1,2"


def incremental_feed(spark, landing):
    from martkit.sources.feed import read_feed

    return read_feed(spark, landing)


def test_event_gate_names_a_missing_month(spark):
    rows = [("a", datetime(2024, 1, 1), 1.0, 2.0, 3.0, 4.0, "ml", "x, CA", "earthquake"), ("a", datetime(2024, 4, 1), 99.0, 2.0, 3.0, 11.0, "ml", "x, CA", "earthquake")]
    schema = "event_id string, occurred_at timestamp_ntz, latitude double, longitude double, depth_km double, magnitude double, mag_type string, place string, event_type string"
    enriched = events.enrich_events(spark.createDataFrame(rows, schema))
    with pytest.raises(QualityError) as error:
        events.event_gate(enriched, events.event_marts(enriched)).enforce()
    assert "months missing: 2" in str(error.value) and "event_id repeated: 1" in str(error.value) and "off the globe: 1" in str(error.value) and "magnitude out of range: 1" in str(error.value)


def test_prices_from_pages(spark):
    named = "<table><thead><tr><th>วันที่</th><th>E20</th><th>Gasohol<br>95 </th></tr></thead><tr><td>24 ส.ค. 2569</td><td>30</td><td>37.69</td></tr><tr><td>25/08/2569</td><td>30</td><td>-</td></tr></table>"
    dated = "<table><tr><td>ราคา</td><td>x</td></tr><tr><td>2026-08-20</td><td>38.29 บาท</td></tr><tr><td>2026-08-21</td><td>99</td></tr><tr><td>2026-08-20</td><td>39</td></tr></table>"
    single = "<table><tr><td>2026-08-22</td><td>40</td></tr></table>"
    pages = spark.createDataFrame([("named", named + single), ("dated", dated), ("bare", single), ("none", "<p>2026-08-22 40</p>")], "page string, html string")
    got = {(r.page, str(r.date), r.price) for r in html.extract_prices(pages).collect()}
    assert got == {("named", "2026-08-24", 37.69), ("dated", "2026-08-20", 38.29), ("dated", "2026-08-20", 39.0), ("bare", "2026-08-22", 40.0)}
    current = {(str(r.date), r.price) for r in prices.current_prices(pages.where("page = 'dated'").drop("page")).collect()}
    assert current == {("2026-08-20", 39.0)}


def test_single_price(spark):
    rows = [
        "<tr><td>แก๊สโซฮอล์ 91</td><td>30</td></tr><tr><td> แก๊สโซฮอล์  95</td><td>99</td></tr><tr><td>GASOHOL95</td><td>37.5</td></tr>",
        "<p>แก๊สโซฮอล์ 95 | 38.25</p>", "<p>แก๊สโซฮอล์ 95 | 99</p>", "<p>ดีเซล 30</p>", "<script>แก๊สโซฮอล์ 95 30</script>", None,
    ]
    df = spark.createDataFrame(list(enumerate(rows)), "i int, html string")
    got = [r.p for r in df.select("i", html.extract_price("html").alias("p")).orderBy("i").collect()]
    assert got == [37.5, 38.25, None, None, None, None]


def test_price_flow(spark, tmp_path):
    start, rng = date(2026, 6, 1), np.random.default_rng(0)
    series = [round(30 + 3 * np.sin(i / 4) + float(rng.normal(0, 0.2)), 2) for i in range(45)]
    body = lambda items: "<table>" + "".join(f"<tr><td>{start + timedelta(days=i):%d/%m/%Y}</td><td>{p}</td></tr>" for i, p in items) + "</table>"
    current = prices.current_prices(spark.createDataFrame([(body(list(enumerate(series))[-7:]),)], "html string"))
    archive = prices.archived_prices(spark.createDataFrame([(start + timedelta(days=i), f"<p>แก๊สโซฮอล์ 95 {p + (1 if i == 44 else 0)}</p>") for i, p in enumerate(series)], "date date, html string"))
    table, model, log = (str(tmp_path / n) for n in ("prices", "model", "log"))
    assert prices.store_prices(spark, current, archive, table) == "bootstrapped"
    assert prices.store_prices(spark, current, archive.where("false"), table) == "updated"
    history = spark.read.parquet(table)
    assert history.count() == 45 and history.orderBy(F.desc("date")).first().price == series[-1]
    error, promoted = prices.train_prices(spark, history, model, log)
    again, kept = prices.train_prices(spark, history, model, log)
    assert promoted and not kept and error == pytest.approx(again)
    assert [r.deployed for r in spark.read.parquet(log).orderBy("run_at").collect()] == [True, False]
    # the same regression by least squares
    rows = ordered_holdout(lag_features(history, "price", "date"), "date").orderBy("date").toPandas()
    x = np.c_[np.ones(len(rows)), rows[list(forecast.FEATURES)].to_numpy()]
    y, train = rows.price.to_numpy(), ~rows.is_holdout.to_numpy()
    w = np.linalg.lstsq(x[train], y[train], rcond=None)[0]
    assert error == pytest.approx(float(np.sqrt(np.mean((x[~train] @ w - y[~train]) ** 2))), rel=1e-4)
    last = np.array(series[::-1][:5])
    want = float(np.r_[1, last, last.mean()] @ w)
    row = prices.forecast_next(history, model).first()
    assert row.forecast == pytest.approx(want, abs=0.011) and row.unit == labels.PRICE_UNIT
    assert row.direction == ("up" if row.forecast >= series[-1] else "down")
    with pytest.raises(QualityError):
        prices.train_prices(spark, history.limit(20), model, log)


def test_weather_flow(spark, tmp_path):
    doc = lambda temp, at: json.dumps({"x": 1, "current_weather": {"temperature": temp, "windspeed": 1.5, "weathercode": 3, "time": at}})
    raw = spark.createDataFrame([(p[0], doc(t, "2026-01-01T10:00")) for p, t in zip(labels.PROVINCES, (24.9, 25, 30, 35))], "province string, value string")
    newest = weather.store_readings(raw, str(tmp_path / "w"))
    assert [r.temperature_category for r in newest.orderBy("temperature").collect()] == list(labels.TEMPERATURE_BANDS.labels)
    weather.store_readings(raw, str(tmp_path / "w"))
    assert spark.read.parquet(str(tmp_path / "w")).count() == 8


def test_scoring_floor_and_input_check(spark):
    rows = [(1.0, 1.0, 1.0, 1.0, 1.0), (-1.0, 1.0, 1.0, 1.0, 1.0), (float("nan"), 1.0, 1.0, 1.0, 1.0), (None, 1.0, 1.0, 1.0, 1.0), (float("inf"), 1.0, 1.0, 1.0, 1.0)]
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in forecast.LAG_COLUMNS))
    assert [r.ok for r in df.select(forecast.is_scorable(forecast.LAG_COLUMNS).alias("ok")).collect()] == [True, False, False, False, False]
    floors = spark.createDataFrame([(-3.0,), (1.005,), (2.5,)], "p double").select(forecast.floored_forecast("p").alias("f"))
    assert [r.f for r in floors.collect()] == [0.0, 1.01, 2.5]


def test_promotion_is_strict(spark):
    log = spark.createDataFrame([("m", 1, 0.5), ("m", 2, 0.5), ("m", 3, 0.4), ("m", 4, 0.45), ("n", 1, 9.0)], "model_name string, run_at int, rmse double")
    got = {(r.model_name, r.run_at): r.deployed for r in forecast.replay_promotions(log).collect()}
    assert got == {("m", 1): True, ("m", 2): False, ("m", 3): True, ("m", 4): False, ("n", 1): True}


def test_split_is_stable_and_classifier_learns(spark):
    rows = [(i, float(i % 3), float(i % 3) + (i % 7) / 100) for i in range(600)]
    df = spark.createDataFrame(rows, "k long, label double, x double")
    train, test = forecast.split_by_key(df, "k")
    moved, _ = forecast.split_by_key(df.repartition(5), "k")
    assert {r.k for r in train.collect()} == {r.k for r in moved.collect()} and 0.7 < train.count() / 600 < 0.9
    model = forecast.train_forest(train, "label", ["x"])
    assert forecast.passes_accuracy(forecast.accuracy(model.transform(test), "label"))
    assert tuple(forecast.sample_check(model, test.limit(3), "label").first()) == (3, 3)


def test_status_of_unbuilt_mart(spark, tmp_path):
    assert not export.mart_status(spark, str(tmp_path / "no"), ["a"]).first().ready


def test_workbooks_of_one_name_in_two_folders(spark, tmp_path):
    for name, header, row in (("x", ["No.", "announce date", "risk"], ["1", "44197", "r1"]), ("y", ["risk", "No.", "announce date"], ["r2", "2", "44198"])):
        (tmp_path / name).mkdir()
        _workbook(tmp_path / name / "book.xlsx", [header, row])
    (tmp_path / "more.csv").write_text('no,announce_date,risk\n3,2021-01-03,"two\nlines"\n')
    paths = [str(tmp_path / p) for p in ("x/book.xlsx", "more.csv", "y/book.xlsx")]
    got = {(r.case_no, str(r.announce_date), r.risk, r.source_file) for r in cases.load_cases(spark, paths).collect()}
    assert got == {(1, "2021-01-01", "r1", "book.xlsx"), (2, "2021-01-02", "r2", "book.xlsx"), (3, "2021-01-03", "two lines", "more.csv")}


def test_typed_cells(tmp_path):
    main = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    rel = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    cells = '<c t="b"><v>1</v></c><c t="d"><v>2021-01-05T00:00:00</v></c><c s="1"><v>42735</v></c><c s="0"><v>7</v></c><c t="e"><v>#N/A</v></c><c t="str"><v>f</v></c>'
    with zipfile.ZipFile(tmp_path / "t.xlsx", "w") as book:
        book.writestr("xl/workbook.xml", f'<workbook {main} xmlns:r="{rel}"><workbookPr date1904="1"/><sheets><sheet name="s" r:id="r1"/></sheets></workbook>')
        book.writestr("xl/_rels/workbook.xml.rels", '<Relationships><Relationship Id="r1" Target="worksheets/s.xml"/></Relationships>')
        book.writestr("xl/styles.xml", f'<styleSheet {main}><cellXfs><xf numFmtId="0"/><xf numFmtId="14"/></cellXfs></styleSheet>')
        book.writestr("xl/worksheets/s.xml", f"<worksheet {main}><sheetData><row>{cells}</row></sheetData></worksheet>")
    # the day number of 1904's system is 1462 days behind
    assert list(sheet_rows(str(tmp_path / "t.xlsx"))) == [["true", "2021-01-05", "44197.0", "7", None, "f"]]


def test_bad_requests_do_not_fail_the_others(spark):
    days = spark.createDataFrame([(date(2024, 1, 1) + timedelta(days=k), 30.0 + k % 5) for k in range(60)], "day date, price double")
    model = forecast.train_regression(lag_features(days, "price"), "price")
    names = ", ".join(f"lag_{k} double" for k in range(1, 6))
    requests = spark.createDataFrame([(31.0, 30.0, 34.0, 33.0, 32.0), (float("nan"), 30.0, 34.0, 33.0, 32.0), (31.0, None, -1.0, 33.0, 32.0)], names)
    assert len(forecast.score(model, requests).collect()) == 1
    assert [r.rejected_inputs for r in forecast.split_scorable(requests)[1].collect()] == ["lag_1", "lag_2,lag_3"]


def test_empty_summary_is_not_ready(spark, tmp_path):
    path = str(tmp_path / "summary")
    spark.createDataFrame([], "total long").write.parquet(path)
    assert [(r.ready, r.total) for r in export.mart_status(spark, path, ["total"]).collect()] == [(False, None)]
    spark.createDataFrame([(3,)], "total long").write.mode("overwrite").parquet(path)
    assert [(r.ready, r.total) for r in export.mart_status(spark, path, ["total"]).collect()] == [(True, 3)]
