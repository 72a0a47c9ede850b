"""Loads run twice, empty windows, cross-window keys."""

import os
import subprocess
import sys
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from martkit.sinks import export, writers
from martkit.streaming import incremental

SCHEMA = "id string, at timestamp_ntz, v int"


def _rows(spark, path):
    return {(r.id, r.at, r.v) for r in spark.read.parquet(path).collect()}


def _load(spark, path, rows, start, end):
    return writers.replace_window(spark.createDataFrame(rows, SCHEMA), path, "at", start, end, ["id"])


JAN, FEB, MAR = datetime(2024, 1, 1), datetime(2024, 2, 1), datetime(2024, 3, 1)


def test_window_replace(spark, tmp_path):
    path = str(tmp_path / "t")
    january = [("a", datetime(2024, 1, 5), 1), ("b", datetime(2024, 1, 31, 23), 1)]
    february = [("c", FEB, 1)]
    _load(spark, path, january, JAN, FEB)
    _load(spark, path, february, FEB, MAR)
    once = _rows(spark, path)
    _load(spark, path, january, JAN, FEB)
    assert _rows(spark, path) == once == set(january + february)
    # a key of another window is ignored, a corrected row replaces, a missing one goes
    result = _load(spark, path, [("c", datetime(2024, 1, 9), 9), ("a", datetime(2024, 1, 5), 2)], JAN, FEB)
    assert _rows(spark, path) == {("a", datetime(2024, 1, 5), 2), ("c", FEB, 1)} and result == {"distinct": 2, "in_window": 1}
    # a re-fetch without rows clears its window only
    _load(spark, path, [], JAN, FEB)
    assert _rows(spark, path) == {("c", FEB, 1)}
    # a window inside a month keeps the rest of the month
    _load(spark, path, [("d", datetime(2024, 2, 20), 1)], datetime(2024, 2, 10), MAR)
    assert _rows(spark, path) == {("c", FEB, 1), ("d", datetime(2024, 2, 20), 1)}
    # a row outside its window lands in its own month without harming it
    _load(spark, path, [("e", datetime(2024, 2, 2), 1)], JAN, FEB)
    assert _rows(spark, path) == {("c", FEB, 1), ("d", datetime(2024, 2, 20), 1), ("e", datetime(2024, 2, 2), 1)}


def test_months_of_a_window():
    assert writers.months_between(JAN, FEB) == ["2024-01"]
    assert writers.months_between(datetime(2023, 12, 15), datetime(2024, 2, 1, 1)) == ["2023-12", "2024-01", "2024-02"]
    assert writers.months_between(datetime(2023, 11, 1), JAN) == ["2023-11", "2023-12"]


def test_first_writer_wins(spark, tmp_path):
    path = str(tmp_path / "t")
    first = spark.createDataFrame([("a", JAN, 1), ("a", FEB, 2), ("b", JAN, 1)], SCHEMA)
    assert writers.insert_if_absent(first, path, ["id"], ["at"]) == 2
    assert writers.insert_if_absent(first.withColumn("v", F.lit(7)), path, ["id"], ["at"]) == 0
    assert writers.insert_if_absent(spark.createDataFrame([("c", JAN, 3), ("a", JAN, 3)], SCHEMA), path, ["id"]) == 1
    assert _rows(spark, path) == {("a", JAN, 1), ("b", JAN, 1), ("c", JAN, 3)}


def test_upsert(spark, tmp_path):
    path = str(tmp_path / "t")
    def put(rows):
        writers.upsert(spark.createDataFrame(rows, "day date, s string, p double"), path, ["day", "s"], "day")

    put([(date(2024, 1, 1), "x", 1.0), (date(2024, 2, 1), "x", 1.0), (date(2024, 1, 1), "y", 1.0)])
    for _ in range(2):
        put([(date(2024, 1, 1), "x", 2.0), (date(2024, 3, 1), "x", 2.0)])
    got = {(str(r.day), r.s, r.p) for r in spark.read.parquet(path).collect()}
    assert got == {("2024-01-01", "x", 2.0), ("2024-02-01", "x", 1.0), ("2024-01-01", "y", 1.0), ("2024-03-01", "x", 2.0)}
    with pytest.raises(ValueError):
        writers.upsert(spark.range(1), path, ["id"], "day")


def test_csv_text(spark, tmp_path):
    rows = [("é, \"q\"", 35.0, 1.5, datetime(2025, 7, 29, 23, 24, 52, 483000), True), (None, 1e10, -0.00012, None, None), ("", 0.0, 1e-9, None, None)]
    df = spark.createDataFrame(rows, "t string, a double, b double, at timestamp_ntz, f boolean")
    entry = export.write_csv(df, str(tmp_path / "x"), [F.desc("a")]).first()
    (file,) = (tmp_path / "x").glob("*.csv")
    data = file.read_bytes()
    assert data.startswith(b"\xef\xbb\xbft,a,b,at,f\n") and entry.rows == 3 and entry.files == 1 and entry.bytes == len(data)
    assert data.decode("utf-8-sig").splitlines()[1:] == [
        ",10000000000,-0.00012,,", '"é, ""q""",35,1.5,2025-07-29 23:24:52.483,true', '"",0,0.000000001,,',
    ]
    back = export.read_export(spark, str(tmp_path / "x"), "t string, a double, b double, at timestamp_ntz, f boolean")
    assert {(r.a, r.b, r.at) for r in back.collect()} == {(r[1], r[2], r[3]) for r in rows}


def test_empty_csv_keeps_its_header(spark, tmp_path):
    entry = export.write_csv(spark.createDataFrame([], "a int, b int"), str(tmp_path / "x"), ["a"]).first()
    assert entry.rows == 0
    assert b"".join(f.read_bytes() for f in (tmp_path / "x").glob("*.csv")) == b"\xef\xbb\xbfa,b\n"


def test_pending_windows(spark):
    windows = incremental.month_windows(spark, date(2024, 1, 1), date(2024, 4, 20))
    assert [str(r.window_start) for r in windows.orderBy("window_start").collect()] == ["2024-01-01", "2024-02-01", "2024-03-01"]
    loaded = spark.createDataFrame([(date(2024, 2, 1),)], "window_start date")
    assert {str(r.window_end) for r in incremental.pending_windows(windows, loaded).collect()} == {"2024-02-01", "2024-04-01"}
    assert incremental.month_windows(spark, date(2024, 5, 1), date(2024, 5, 20)).count() == 0


def test_window_bounds_ignore_the_machines_zone():
    """The same load on machines of different zones: rows beside the window stay."""
    code = """
import sys, tempfile
from datetime import datetime
from martkit.session import local_session
from martkit.sinks import writers
spark, path = local_session("zone", 2, "1g"), tempfile.mkdtemp() + "/t"
rows = [("a", datetime(2024, 3, 9, 18), 1), ("b", datetime(2024, 3, 10), 1), ("c", datetime(2024, 3, 19, 23), 1), ("d", datetime(2024, 3, 20), 1)]
df = spark.createDataFrame([(i, at.isoformat(), v) for i, at, v in rows], "id string, at string, v int").selectExpr("id", "cast(at as timestamp_ntz) at", "v")
writers.replace_window(df, path, "at", datetime(2024, 3, 1), datetime(2024, 4, 1), ["id"])
writers.replace_window(df.where("false"), path, "at", datetime(2024, 3, 10), datetime(2024, 3, 20), ["id"])
print(sorted(r.id for r in spark.read.parquet(path).collect()))
"""
    for zone in ("Asia/Bangkok", "UTC", "America/New_York"):
        done = subprocess.run([sys.executable, "-c", code], env=os.environ | {"TZ": zone}, capture_output=True, text=True, check=True)
        assert done.stdout.strip().splitlines()[-1] == "['a', 'd']", zone


def test_a_second_past_midnight_counts():
    assert writers.months_between(JAN, datetime(2024, 2, 1, 0, 0, 30)) == ["2024-01", "2024-02"]
