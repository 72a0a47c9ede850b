"""Delimited files in many splits: the rows of the parser that reads a file as one task."""

import random

import pytest
from pyspark.sql import functions as F

from martkit.sinks import export
from martkit.sources import records
from martkit.sources.tabular import MissingSource, read_harmonised

SCHEMA = "k bigint, label string, n double, note string"


@pytest.fixture
def small_splits(spark):
    keys = {"spark.sql.files.maxPartitionBytes": "700", "spark.sql.files.openCostInBytes": "1"}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k in keys:
        spark.conf.unset(k)


def _rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def _whole(spark, path):
    return spark.read.schema(SCHEMA).option("header", "true").option("multiLine", "true").option("escape", '"').csv(path)


def _field(draw, quoted):
    bits = ['""', "a", "b c", "é", "", "7", "x"] + (["\n", "\n\n", ",", "\n,"] if quoted else [])
    text = "".join(draw.choices(bits, k=draw.randint(0, 9)))
    return f'"{text}"' if quoted else text.replace('""', "q")


@pytest.mark.parametrize("seed", range(4))
def test_splits_give_the_rows_of_one_task(spark, small_splits, tmp_path, seed):
    draw = random.Random(seed)
    lines = ['k,label,"n",note']
    for k in range(300):
        label = _field(draw, draw.random() < 0.5)
        note = '"' + "long\n" * draw.choice([300, 900]) + '"' if draw.random() < 0.02 else _field(draw, draw.random() < 0.5)
        lines.append(f"{k},{label},{k / 7},{note}")
        if draw.random() < 0.05:
            lines.append("")
    end = "\r\n" if seed == 3 else "\n"
    text = end.join(lines) + (end if seed % 2 else "")
    path = tmp_path / "one.csv"
    path.write_bytes(("﻿" + text if seed == 2 else text).encode())
    found = records.read_csv(spark, [str(path)], SCHEMA).select("r.*")
    splits = records._lines(spark, [str(path)]).select("start").distinct().count()
    assert splits > 10 and records.open_splits(spark, records._lines(spark, [str(path)])).count() > 1
    assert _rows(found) == _rows(_whole(spark, str(path))) and found.count() == 300


def test_states_along_a_file():
    assert [records.ends_inside(x) for x in ('a,b', 'a,"b', 'a,"b"', 'a,"b""', 'a,"b""c"', '"a,', ',,"', '""', '"""', 'a"b,c', ' "a', 'a,"b"c,"d')] == [
        False, True, False, True, False, True, True, False, True, False, False, True]
    assert [records.ends_inside(x, True) for x in ("a", 'a"', 'a""', 'a","', 'a",b', '""', '"""', 'a"x,"')] == [True, False, True, True, False, True, False, True]


def test_only_open_splits_are_joined(spark, small_splits, tmp_path):
    """Without a field over two splits there is one pass and no shuffle."""
    path = tmp_path / "plain.csv"
    path.write_text("k,label,n,note\n" + "".join(f'{k},"a ""b""",1.5,x\n' for k in range(400)))
    found = records.read_csv(spark, [str(path)], SCHEMA)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and found.count() == 400 and found.rdd.getNumPartitions() > 10


def test_export_is_read_by_many_tasks_a_file(spark, small_splits, tmp_path):
    label = F.concat(F.lit(' "a\n'), F.col("id"), F.lit('",\r\nb '))
    table = spark.range(200).select("id", label.alias("label"), (F.col("id") / 7).alias("n"))
    manifest = export.write_csv(table.coalesce(1), str(tmp_path / "out")).first()
    assert manifest.rows == 200
    found = export.read_export(spark, str(tmp_path / "out"), "id bigint, label string, n double")
    assert found.rdd.getNumPartitions() > 3 * manifest.files and _rows(found) == _rows(table)


def test_headers_without_a_job(spark, tmp_path):
    import gzip

    names = {"a.csv": "No,risk\n1,x\n2,y\n", "b c.csv": '﻿"No","Risk\nlevel"\n3,"z\nz"\n', "d.csv": "", "e.csv": "\r\n\nNo,risk\r\n"}
    for name, text in names.items():
        (tmp_path / name).write_bytes(text.encode())
    (tmp_path / "f.csv.gz").write_bytes(gzip.compress(("no,risk\n" + "4,w\n" * 50_000).encode()))
    (tmp_path / "g.csv").write_text("No," + "x" * 200_000 + "\n5,v\n")
    spark.sparkContext.setJobGroup("headers", "headers")
    try:
        found = {p.rsplit("/", 1)[1]: line for p, line in records.first_records(spark, [str(tmp_path)])}
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("headers")
    assert found == {"a.csv": "No,risk", "b c.csv": '"No","Risk\nlevel"', "e.csv": "No,risk", "f.csv.gz": "no,risk", "g.csv": "No," + "x" * 200_000}


def test_harmonised_layouts(spark, small_splits, tmp_path):
    (tmp_path / "a.csv").write_text("No,risk\n" + "".join(f'{k},"r\n{k}"\n' for k in range(300)))
    (tmp_path / "b.csv").write_text('"Risk","No"\nx,900\n\n,901\n')
    table = read_harmonised(spark, [str(tmp_path)], {"no": "no", "risk": "risk"}, ["no", "risk"], ["no"])
    assert _rows(table) == sorted([(str(k), f"r\n{k}", "a.csv") for k in range(300)] + [("900", "x", "b.csv"), ("901", None, "b.csv")], key=repr)
    (tmp_path / "c.csv").write_text("risk\n1\n")
    with pytest.raises(MissingSource, match="no"):
        read_harmonised(spark, [str(tmp_path)], {"no": "no", "risk": "risk"}, ["no", "risk"], ["no"])
