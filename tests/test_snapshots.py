"""Snapshot tables: readers see the state before or after a load, at any of its steps; a crash needs no repair."""

import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from martkit.sinks import snapshots

SCHEMA = "id string, at timestamp_ntz, v int"
JAN, FEB, MAR, APR = (datetime(2024, m, 1) for m in (1, 2, 3, 4))


def _rows(spark, path):
    return {(r.id, r.at, r.v) for r in snapshots.read(spark, path).collect()}


def _load(spark, path, rows, start, end):
    return snapshots.replace_window(spark.createDataFrame(rows, SCHEMA), path, "at", start, end, ["id"])


def test_windows(spark, tmp_path):
    path = str(tmp_path / "t")
    january = [("a", datetime(2024, 1, 5), 1), ("b", datetime(2024, 1, 31, 23), 1)]
    february = [("c", FEB, 1)]
    _load(spark, path, january, JAN, FEB)
    _load(spark, path, february, FEB, MAR)
    _load(spark, path, january, JAN, FEB)
    assert _rows(spark, path) == set(january + february)
    result = _load(spark, path, [("c", datetime(2024, 1, 9), 9), ("a", datetime(2024, 1, 5), 2)], JAN, FEB)
    assert _rows(spark, path) == {("a", datetime(2024, 1, 5), 2), ("c", FEB, 1)} and result == {"distinct": 2, "in_window": 1}
    _load(spark, path, [], JAN, FEB)
    assert _rows(spark, path) == {("c", FEB, 1)}
    _load(spark, path, [("d", datetime(2024, 2, 20), 1)], datetime(2024, 2, 10), MAR)
    assert _rows(spark, path) == {("c", FEB, 1), ("d", datetime(2024, 2, 20), 1)}
    _load(spark, path, [("e", datetime(2024, 2, 2), 1), ("d", datetime(2024, 1, 3), 7)], JAN, FEB)
    assert _rows(spark, path) == {("c", FEB, 1), ("d", datetime(2024, 2, 20), 1), ("e", datetime(2024, 2, 2), 1)}
    _load(spark, path, [], FEB, MAR)
    assert _rows(spark, path) == set() and snapshots.read(spark, path).columns == ["id", "at", "v", "month"]


def test_first_load_may_be_empty(spark, tmp_path):
    path = str(tmp_path / "t")
    assert not snapshots.exists(spark, path) and snapshots.manifest(spark, path) is None
    assert _load(spark, path, [], JAN, FEB) == {"distinct": 0, "in_window": 0}
    assert _rows(spark, path) == set() and snapshots.exists(spark, path)
    with pytest.raises(ValueError, match="no table"):
        snapshots.read(spark, str(tmp_path / "other"))


def test_readers_see_one_state_at_every_step(spark, tmp_path, monkeypatch):
    """The table is read again before and after every write and rename of a load."""
    path = str(tmp_path / "t")
    old = [(f"k{k}", datetime(2024, 1 + k % 3, 1 + k % 25), 0) for k in range(60)]
    _load(spark, path, old, JAN, APR)
    new = [(i, at, 1) for i, at, _ in old if at < FEB] + [("k1", datetime(2024, 1, 9), 1)]
    began = snapshots.read(spark, path)
    seen = []
    write, publish = snapshots._Load.write, snapshots._publish

    def watched(work):
        def run(*args):
            seen.append(_rows(spark, path))
            out = work(*args)
            seen.append(_rows(spark, path))
            return out

        return run

    monkeypatch.setattr(snapshots._Load, "write", watched(write))
    monkeypatch.setattr(snapshots, "_publish", watched(publish))
    _load(spark, path, new, JAN, datetime(2024, 2, 10))
    after = _rows(spark, path)
    assert after != set(old) and len(seen) >= 6 and all(s == set(old) for s in seen[:-1]) and seen[-1] == after
    assert {(r.id, r.at, r.v) for r in began.collect()} == set(old)  # one that had begun before
    assert {(r.id, r.at, r.v) for r in snapshots.read(spark, path, version=1).collect()} == set(old)


@pytest.mark.parametrize("step", ["write", "publish"])
def test_a_load_that_dies_leaves_the_table(spark, tmp_path, monkeypatch, step):
    path = str(tmp_path / "t")
    rows = [("a", JAN, 1), ("b", FEB, 1)]
    _load(spark, path, rows, JAN, MAR)

    def die(*args):
        raise RuntimeError("died")

    with monkeypatch.context() as m:
        m.setattr(*((snapshots._Load, "rows") if step == "write" else (snapshots, "_publish")), die)
        with pytest.raises(RuntimeError, match="died"):
            _load(spark, path, [("a", JAN, 2)], JAN, MAR)
    assert _rows(spark, path) == set(rows)
    _load(spark, path, [("a", JAN, 2)], JAN, MAR)
    assert _rows(spark, path) == {("a", JAN, 2)}
    assert snapshots.vacuum(spark, path) == 2 and _rows(spark, path) == {("a", JAN, 2)}
    assert len(os.listdir(f"{path}/data")) == 1


def test_two_loads_at_once(spark, tmp_path):
    path = str(tmp_path / "t")
    _load(spark, path, [("a", JAN, 1)], JAN, FEB)
    known = snapshots.manifest(spark, path)
    _load(spark, path, [("b", FEB, 1)], FEB, MAR)
    with pytest.raises(snapshots.Conflict):
        snapshots._publish(spark, path, known, known["schema"], {})
    assert _rows(spark, path) == {("a", JAN, 1), ("b", FEB, 1)}


def test_only_parts_that_may_hold_a_key_are_read(spark, tmp_path, monkeypatch):
    """A load of one month into many looks at no part whose key range it does not meet."""
    path = str(tmp_path / "t")
    month = lambda k: datetime(2020 + k // 12, 1 + k % 12, 1)
    rows = [(f"{k:03d}-{j}", month(k), 0) for k in range(36) for j in range(5)]
    _load(spark, path, rows, month(0), month(36))
    looked = []
    parts = snapshots._parts
    monkeypatch.setattr(snapshots, "_parts", lambda s, p, schema, months: looked.append(sorted(months)) or parts(s, p, schema, months))
    _load(spark, path, [(f"036-{j}", month(36), 0) for j in range(5)], month(36), month(37))
    assert looked == []
    _load(spark, path, [("007-2", month(37), 1), ("007-9", month(37), 1)], month(37), month(38))
    assert looked == [["2020-08"]]
    assert ("007-2", month(7), 0) in _rows(spark, path) and ("007-9", month(37), 1) in _rows(spark, path) and ("007-2", month(37), 1) not in _rows(spark, path)


def test_first_writer_wins_and_compaction(spark, tmp_path):
    path = str(tmp_path / "t")
    first = spark.createDataFrame([("a", JAN, 1), ("a", FEB, 2), ("b", JAN, 1), (None, JAN, 5)], SCHEMA)
    assert snapshots.insert_if_absent(first, path, ["id"], ["at"]) == 3
    more = spark.createDataFrame([("a", MAR, 9), ("c", JAN, 1)], SCHEMA)
    assert snapshots.insert_if_absent(more, path, ["id"], ["at"]) == 1 and snapshots.insert_if_absent(more, path, ["id"], ["at"]) == 0
    want = {("a", JAN, 1), ("b", JAN, 1), ("c", JAN, 1), (None, JAN, 5)}
    assert _rows(spark, path) == want
    assert snapshots.compact(spark, path, "id") == 1 and snapshots.compact(spark, path, "id") == 0
    assert _rows(spark, path) == want and [len(p) for p in snapshots.manifest(spark, path)["months"].values()] == [1]
    snapshots.vacuum(spark, path)
    assert _rows(spark, path) == want


def test_upsert(spark, tmp_path):
    path, kind = str(tmp_path / "t"), "day date, k string, v int"
    rows = lambda *r: spark.createDataFrame(list(r), kind)
    snapshots.upsert(rows((JAN.date(), "x", 1), (FEB.date(), "x", 1)), path, ["day", "k"], "day")
    snapshots.upsert(rows((JAN.date(), "x", 2), (JAN.date(), "y", 1)), path, ["day", "k"], "day")
    assert {(r.day.month, r.k, r.v) for r in snapshots.read(spark, path).collect()} == {(1, "x", 2), (1, "y", 1), (2, "x", 1)}
    with pytest.raises(ValueError, match="part of the key"):
        snapshots.upsert(rows(), path, ["k"], "day")


def test_marts_follow_the_changed_months_alone(spark, tmp_path, monkeypatch):
    from pyspark.sql import functions as F

    from martkit.functions.numbers import fixed_mean, fixed_sum, merged_mean, merged_sum, partial_sums

    table, marts = str(tmp_path / "t"), str(tmp_path / "m")
    month = lambda k: datetime(2020 + k // 12, 1 + k % 12, 1)
    rows = [(f"{k:03d}-{j}", month(k), 7 * k + j) for k in range(24) for j in range(6)]
    _load(spark, table, rows, month(0), month(24))
    build = lambda df: df.groupBy("month").agg(F.count(F.lit(1)).alias("n"), *partial_sums(F.col("v") / 7, "v"))
    assert len(snapshots.follow(table, marts, spark, build, "n")) == 24 and snapshots.follow(table, marts, spark, build, "n") == []
    looked, parts = [], snapshots._parts
    monkeypatch.setattr(snapshots, "_parts", lambda s, p, schema, months: looked.append((p, sorted(months))) or parts(s, p, schema, months))
    _load(spark, table, [("005-0", month(5), 1000), ("006-9", month(6), 3)], month(5), month(7))
    _load(spark, table, [], month(9), month(10))
    assert snapshots.follow(table, marts, spark, build, "n") == ["2020-06", "2020-07", "2020-10"]
    assert [m for p, m in looked if p == table] == [["2020-06", "2020-07"]]
    whole = lambda df, *a: [tuple(r) for r in df.agg(*a).collect()]
    value = F.col("v") / 7
    assert whole(snapshots.read(spark, marts), F.sum("n"), merged_sum("v"), merged_mean("v", 6)) == whole(snapshots.read(spark, table), F.count(F.lit(1)), fixed_sum(value), fixed_mean(value, 6))


def test_a_load_of_many_narrow_rows_is_spread_over_tasks(spark, tmp_path, monkeypatch):
    """All of one month, each id twice: the first of each is stored, and no task writes more than a few times ``ROWS``."""
    from martkit.sources.feed import FEED_COLUMNS
    from martkit.streaming import incremental

    monkeypatch.setattr(snapshots, "ROWS", 100, raising=False)
    own = {"id": F.concat(F.lit("e"), F.col("id") % 1000), "time": F.lit("2024-01-05T00:00:00Z"), "mag": F.when(F.col("id") < 1000, "1").otherwise("2")}
    feed = spark.range(2000).select(*[own.get(c, F.lit(None).cast("string")).alias(c) for c in FEED_COLUMNS])
    path = str(tmp_path / "t")
    found = incremental.load_window(feed, path, datetime(2024, 1, 1), datetime(2024, 2, 1))
    assert found == {"distinct": 1000, "in_window": 1000, "attempted": 2000, "rejected": 0}
    stored = snapshots.read(spark, path)
    assert sorted(tuple(r) for r in stored.select("event_id", "magnitude").collect()) == sorted((f"e{k}", 1.0) for k in range(1000))
    files = stored.groupBy(F.input_file_name()).count().collect()
    assert max(r[1] for r in files) <= 300
    part = snapshots.manifest(spark, path)["months"]["2024-01"][0]
    assert (part["rows"], part["low"], part["high"]) == (1000, "e0", "e999")
