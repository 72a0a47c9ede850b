"""Cases in which an operator once did less than its whole job."""

import random

import pytest

from martkit.llm import decontamination, html_blocks, licenses, mixing, queries, secrets, tokens


# 6: the query's rows come out of the schedule


def test_mix_query_follows_the_schedule(spark, tmp_path):
    rows = [(k, "w " * (1 + k % 7), "abc"[k % 3]) for k in range(600)] + [(5, "w " * 6, "c"), (600, "", "a"), (601, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    planned = mixing.plan(docs).collect()
    mixed = mixing.curriculum(docs).collect()
    key = lambda r: repr((r.doc_id, r.source, r.size, r.source_size, r.target, r.taken, r.positions))
    assert sorted(map(key, mixed)) == sorted(map(key, planned))
    firsts = [r.positions[0] if r.positions else 2.0 for r in mixed]
    assert firsts == sorted(firsts) and len(set(firsts)) > 300
    got = queries.op6(spark, str(tmp_path)).collect()
    assert [(r.doc_id, r.size, r.taken) for r in got] == [(r.doc_id, r.size, r.taken) for r in mixed]


# 4: links at every gap within the scope, wherever they lie


def test_links_at_every_gap_and_offset(spark):
    places, scope = [], 20
    for size in (1, 13, 47):
        for offset in range(2 * scope):
            for gap in range(scope + 3):
                a, b = (offset, offset + size), (offset + size + gap, offset + size + gap + 5)
                places += [(a, b, gap <= scope), (b, a, gap <= scope)]
    kind = "row long, kind string, rank int, role string, start long, end long"
    left = spark.createDataFrame([(k, "weak_secret", 4, "secret", *x) for k, (x, _, _) in enumerate(places)], kind)
    right = spark.createDataFrame([(k, "access", 1, "identifier", *y) for k, (_, y, _) in enumerate(places)], kind)
    got = sorted(r.row for r in secrets._near(left, right, scope).collect())
    assert got == [k for k, (_, _, near) in enumerate(places) if near]


def test_long_secret_links_wherever_it_lies(spark):
    rows = [(k, "." * k + " bearer=" + "x" * 90 + " " * 250 + "user: bob") for k in range(0, 320, 10)]
    found = secrets.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {tuple(s.kind for s in r.spans) for r in found} == {("weak_secret", "weak_access")}


# 8: no element but scripts, styles, templates and text areas takes text along


@pytest.mark.parametrize("page, want", [
    ('<header><svg class="logo"/></header><article><p>Body text here</p></article>', ["Body text here"]),
    ('<p>one<svg viewBox="0 0 1 1"><path d="M0 0"/><title/><style/></svg> two</p><p>three', ["one two", "three"]),
    ("<div><svg><g><path d=1></div><p>after", ["after"]),
    ("<svg><title>Logo</title></svg>Home<p>text", ["Logo Home", "text"]),
    ("<p>Let <math><mi>x</mi><mo>=</mo><mn>2</mn></math> be two.</p>", ["Let x=2 be two."]),
    ("<p>Let <math/> be.</p><p>next", ["Let be.", "next"]),
    ("<noscript>see this<p>next", ["see this", "next"]),
    ("<p>a</p><noscript>no script</noscript><p>b", ["a", "no script", "b"]),
    ("<object data=x><p>instead</p></object><p>c", ["instead", "c"]),
    ("<object data=x><p>d", ["d"]),
    ("<iframe src=x><p>e", ["e"]),
    ("<p>f</p><script>var a = '<p>x</p>'</script><style>p{}</style><template><p>t</template><textarea>u</textarea><p>g", ["f", "g"]),
])
def test_blocks_around_other_elements(page, want):
    assert [b.text for b in html_blocks.blocks(page)] == want


# 2: any number of parts of the items


def test_leaks_of_many_parts(spark, monkeypatch):
    monkeypatch.setattr(decontamination, "MOST_STATES", 150)
    draw = random.Random(6)
    text = lambda n: " ".join(draw.choice("abcdefgh") + draw.choice("ijklm") for _ in range(n))
    items = [(f"i{k}", text(30)) for k in range(60)] + [("short", "zz yy xx")]
    docs = [(k, text(40) + " " + items[k % 61][1][: 3 * 20] + " " + items[7 * k % 61][1] + " " + text(9), 5) for k in range(61)] + [(99, None, 0), (None, text(50), 5)]
    df, tests = spark.createDataFrame(docs, "doc_id long, text string, n_chars int"), spark.createDataFrame(items, "item_id string, text string")
    for work in (decontamination.scan, lambda d, i, **k: decontamination.clean(d, i, max_coverage=0.6, **k)):
        whole, many = (sorted(map(repr, work(df, tests, most_bytes=n).collect())) for n in (1 << 20, 150))
        assert many == whole and len(whole) > 40


def test_automata_are_bound_by_states(spark):
    draw = random.Random(8)
    items = [(k, " ".join(f"w{draw.randrange(10**6)}" for _ in range(800))) for k in range(300)]
    df = spark.createDataFrame(items, "item_id long, text string")
    groups = list(decontamination.automata(df, 10, "item_id", "text", 1 << 16))
    sizes = [sum(len(a.length) for a in g) for g in groups]
    assert len(groups) > 1 and all(n <= decontamination.MOST_STATES or len(g) == 1 for n, g in zip(sizes, groups))
    words = items[123][1].split()[40:60]
    assert sum(a.scan(words)[0].all() for g in groups for a in g) == 1


# 4: many spans in one text


def test_spans_that_overlap_in_a_text_of_many(spark):
    draw = random.Random(7)
    kind = "row long, kind string, rank int, role string, start long, end long"
    make = lambda n, longest: [(r, "k", 0, "secret", a, a + draw.randint(1, longest)) for r, a in sorted({(draw.randrange(2), draw.randrange(6000)) for _ in range(n)})]
    left, right = make(250, 40), make(120, 1500)
    got = {(r.row, r.start) for r in secrets._clear(spark.createDataFrame(left, kind), spark.createDataFrame(right, kind)).collect()}
    assert got == {(a[0], a[4]) for a in left if not any(a[0] == b[0] and a[4] < b[5] and b[4] < a[5] for b in right)}


def test_text_of_many_spans(spark):
    text = " ".join(f"password=abcdefgh{k} user: bob{k} https://h{k}.example.com" for k in range(25_000))
    found = secrets.scan(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert len(found.spans) == 75_000


# 3: whole license texts, templates by the join


def test_whole_license_texts(spark):
    every = dict(licenses.TEXTS)
    cased = lambda words: ", ".join(w.capitalize() if k % 3 else w.upper() for k, w in enumerate(words))
    bsd = every["bsd-3"].split()
    rows = [(1, cased(every["mit"].split())), (2, cased(every["unlicense"].split()[5:])), (3, cased(bsd[:20] + ["one", "more"] + bsd[20:])), (4, cased(every["zlib"].split()[:60]))]
    found = {r.doc_id: r.labels.split(",") for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert "mit" in found[1] and found[2] == ["unlicense"] and "bsd-3" in found[3] and "zlib" not in found[4]


def test_many_templates_need_no_literals(spark):
    draw = random.Random(3)
    words = lambda n: " ".join(f"t{draw.randrange(5000)}" for _ in range(n))
    templates = tuple(licenses.Template(f"l{k}", words(60)) for k in range(1500))
    docs = spark.createDataFrame([(k, f"x y {templates[k].words} z") for k in range(0, 1500, 100)], "doc_id long, text string")
    voted = licenses.votes(docs, templates)
    assert len(voted._jdf.queryExecution().logical().toString()) < 200_000
    got = {(r.doc_id, r.label) for r in licenses.spans(voted, templates).where("template >= 0").collect()}
    assert got == {(k, f"l{k}") for k in range(0, 1500, 100)}


# 1: the registered query meets its cache again


def test_second_run_of_the_query_encodes_nothing(spark, monkeypatch):
    folder = "/root/testdata/sf0.001"
    first = {tuple(r) for r in queries.op1(spark, folder).collect()}
    monkeypatch.setattr(tokens, "encoder", lambda path: 1 / 0)
    assert {tuple(r) for r in queries.op1(spark, folder).collect()} == first


def test_counts_of_a_hot_text(spark):
    rows = [(k, "the same text " * 40 if k % 3 else f"own text {k}") for k in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    counted = tokens.count(df, queries.public_tokenizers.path("byte_bpe_50k.json"), queries.scratch_path(spark, "cache"))
    got = {r.doc_id: r.n_tokens for r in counted.collect()}
    assert len(got) == 3000 and len({n for k, n in got.items() if k % 3}) == 1 and None not in got.values()
