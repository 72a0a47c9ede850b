"""Stages keep extra columns whatever their names, and settle ties the same way in every run."""

import random

from pyspark.sql import functions as F

from martkit.llm import mixing, quality
from tests.llm import brute


def _docs(spark, extra):
    draw = random.Random(4)
    rows = [(k, " ".join(draw.choice(["alpha", "beta", "the", "of", "gamma", "und", "x1"]) + str(draw.randrange(30)) for _ in range(20 + 7 * k)), "en", "ab"[k % 2], *(100 * j + k for j in range(len(extra)))) for k in range(20)]
    rows.append((20, None, None, None, *(None for _ in extra)))
    return rows, spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, " + ", ".join(f"`{n}` long" for n in extra))


def test_mix_keeps_clashing_columns(spark):
    extra = ["_own", "_h", "_i", "_id", "_source", "_position", "position", "its_id", "Its_Hash", "own_hash", "h", "size"]
    rows, df = _docs(spark, extra)
    out = mixing.apply(df)
    assert out.columns == df.columns
    uses = {r.doc_id: len(r.positions) for r in mixing.plan(df).collect()}
    assert sorted(map(tuple, out.collect())) == sorted(r for r in rows for _ in range(uses[r[0]]))


def test_rules_keep_clashing_columns(spark):
    extra = ["_qt", "_q_kept", "_q_row", "_q_lang", "_q_n", "c0", "c1", "_Q_WORDS", "kept"]
    rows, df = _docs(spark, extra)
    out = quality.keep(df)
    assert out.columns == df.columns
    plain = {r.doc_id for r in quality.rate(df.select("doc_id", "text", "lang")).where("kept").collect()}
    assert {tuple(r) for r in out.collect()} == {r for r in rows if r[0] in plain} and 5 < len(plain) < 20
    assert all(not brute.quality(r[1])[-1] for r in rows if r[0] in plain)


def test_one_id_with_two_texts_of_one_size(spark):
    """Which of the two is used more often does not depend on how the rows lie."""
    rows = [(k % 5, f"w{k} " * (3 + k % 3), "a") for k in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    runs = {tuple(sorted(map(tuple, mixing.apply(df.repartition(n)).collect()))) for n in (1, 3, 7)}
    planned = {tuple(sorted((r.doc_id, r.h, r.taken) for r in mixing.plan(df.orderBy(F.rand(n))).collect())) for n in (1, 2)}
    assert len(runs) == 1 and len(planned) == 1
