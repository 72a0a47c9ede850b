"""The LSH forest: prefixes of sorted labels, shortened until the recall is reached."""

import random

import numpy as np
from pyspark.sql import functions as F

from martkit.llm import near
from tests.llm import brute


def text(draw, n):
    return [draw.choice("abcdefgh") + str(draw.randrange(4000)) for _ in range(n)]


def labels(spark, draw, n):
    """(tree, label, node) with prefixes shared to every length."""
    rows = []
    for node in range(n):
        for tree in range(2):
            values = [draw.randrange(2) for _ in range(4)]
            rows.append((tree, np.array(values, ">u2").tobytes(), node))
    return rows, spark.createDataFrame([(t, bytearray(x), k) for t, x, k in rows], "tree int, label binary, node long")


def test_leads_of_prefixes_across_partitions(spark):
    draw = random.Random(3)
    for parts in (1, 7):
        spark.conf.set("spark.sql.shuffle.partitions", str(parts))
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        try:
            rows, df = labels(spark, draw, 90)
            for depth in (1, 2, 4):
                first = {}
                for tree, label, node in sorted(rows):
                    first.setdefault((tree, label[: 2 * depth]), node)
                tied = {}
                for r in near.leads(df, depth).collect():
                    tied.setdefault((r.tree, r.node), set()).add(r.lead)

                def end(tree, node):
                    seen = node
                    while (tree, seen) in tied and tied[tree, seen] - {seen}:
                        seen = min(tied[tree, seen] - {seen}, key=lambda x: [k for k, r in enumerate(sorted(rows)) if r[0] == tree and r[2] == x][0])
                    return seen

                for tree, label, node in rows:
                    assert end(tree, node) == first[tree, label[: 2 * depth]]
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", "4")
            spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_trie_keeps_what_shares_a_prefix(spark):
    draw = random.Random(5)
    sigs = [(k, np.array([draw.randrange(3) for _ in range(3 * 4)], ">u2").tobytes()) for k in range(200)]
    df = spark.createDataFrame([(k, bytearray(s)) for k, s in sigs], "node long, sig binary")
    got = {(r.tree, r.node): r.depth for r in near.trie(df, 3, trees=3, depth=4).collect()}
    wrong = 0
    for tree in range(3):
        own = {k: s[tree * 8 : tree * 8 + 8] for k, s in sigs}
        for k, s in own.items():
            longest = max(sum(s[: 2 * d] == o[: 2 * d] for d in range(1, 5)) for j, o in own.items() if j != k)
            if longest >= 3:
                assert got[tree, k] >= longest
            wrong += got.get((tree, k), longest) != longest and longest < 3
    assert wrong < 60  # rows at the edges of partitions alone


def test_recall_against_all_pairs(spark):
    """Pairs just above the threshold: those that the ties and their families reach, of all there are."""
    draw, rows = random.Random(11), []
    for k in range(150):
        base = text(draw, 120)
        for copy in range(3):
            own = list(base)
            for _ in range(draw.choice((0, 1, 2, 2, 2))):
                own[draw.randrange(len(own))] = f"new{draw.randrange(9999)}"
            rows.append((3 * k + copy, " ".join(own)))
    want = brute.near(rows)
    got = {r.doc_id: (r.class_id, r.n_links) for r in near.classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    links = sum(n for _, n in want.values())
    assert links > 300 and sum(n for _, n in got.values()) >= 0.99 * links
    assert all(got[i][1] <= want[i][1] for i in want)


def test_recall_is_measured():
    assert near.measured_recall(0, 0.0, 8, 0.8) == near.recall(8, 0.8) < 0.999 < near.recall(7, 0.8)
    odds = near.recall(8, 0.95)
    assert near.measured_recall(50, 50 / odds, 8, 0.8) > 0.999999


def test_family_of_thousands(spark):
    """One family of 3,000 contents of very different sizes, and one of 1,200 near copies: every link counted."""
    draw = random.Random(2)
    words = text(draw, 1200)
    rows = [(k, " ".join(words[: 40 + k % 1100])) for k in range(3000)]
    base = text(draw, 60)
    rows += [(5000 + k, " ".join(base[:30] + [f"x{k}"] + base[30:])) for k in range(1200)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    got = {r.doc_id: (r.class_id, r.n_links) for r in near.classes(df).collect()}
    sizes = {n: n - 4 for n in range(40, 1140)}
    for n in (40, 41, 100, 700, 1139):
        linked = sum(min(a, sizes[n]) >= 0.8 * max(a, sizes[n]) for m, a in sizes.items() if m != n)
        assert got[n - 40][1] == linked
    assert {c for i, (c, _) in got.items() if i < 3000} == {0}
    assert all(got[5000 + k] == (5000, 1199) for k in range(1200))  # 52 shingles of 62 in common


def test_clashing_names_stay(spark):
    draw = random.Random(1)
    base = " ".join(text(draw, 50))
    rows = [(k, base + " end" if k % 2 else base, k, k + 1, k + 2, k + 3, f"r{k}", k) for k in range(6)] + [(9, None, 0, 0, 0, 0, None, 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, _own long, _h long, its_id long, Own_Hash long, first string, node long")
    kept = near.one_of_each(df)
    assert kept.columns == df.columns
    assert {tuple(r) for r in kept.collect()} == {rows[0], rows[6]}
    assert {r.class_id for r in near.classes(df).where(F.col("doc_id") < 9).collect()} == {0}
