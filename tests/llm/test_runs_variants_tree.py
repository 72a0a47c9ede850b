"""Periodic runs, spelling variants and the BPE tree against plain versions and on odd cases."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

from martkit.llm import bpe_tree, queries, runs, variants
from martkit.llm.catalog import load_all
from tests.llm import brute
from tests.oracle import compare, connect

FOLDER = "/root/testdata/sf0.001"
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def _sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


@pytest.fixture(scope="module")
def docs(spark):
    """With a repeated row, null ids and texts, and columns whose names the operators use inside."""
    texts = [None, "", " \n\t", "one", "a " * 700, ("x y z " * 9 + "\n") * 3 + "end", "Große große grosse Grosse grosses grosse", "tokens" * 30_000, "ab ab ab ab ab ab cd"]
    rows = [(k, t, k, 1, "c", "f", "r") for k, t in enumerate(texts)]
    rows += [rows[5], (None, "ab " * 12, 0, 1, "c", "f", "r"), (None, None, None, None, None, None, None)]
    return spark.createDataFrame(rows, "doc_id long, text string, n_words long, n long, word string, form string, ids string")


# 11: periodic runs


def plain_runs(x):
    """(start, length, period) of all runs, every lag over the whole sequence."""
    found = []
    for q in range(1, len(x) // 4 + 1):
        k = 0
        while k + q < len(x):
            end = k
            while end + q < len(x) and x[end] == x[end + q]:
                end += 1
            if end - k + q >= max(6, 4 * q):
                part = x[k : end + q]
                if not any(part[:-p] == part[p:] for p in range(1, q)):
                    found.append((k, end - k + q, q))
            k = end + 1
    return sorted(found)


def sequences(seed, count):
    draw = random.Random(seed)
    pick = lambda n, k: [draw.randrange(k) for _ in range(n)]

    def nested(depth):
        inner = pick(draw.randint(1, 6), 3) if depth == 0 else nested(depth - 1)
        return inner * draw.randint(1, 6) + (nested(depth - 1) if depth else [])

    for k in range(count):
        p = draw.randint(1, 110)
        unit = (pick(p, draw.choice([2, 3, 50])), [0] * (p - 1) + [1], [j % draw.choice([1, 2, 3]) if draw.random() < 0.9 else 7 for j in range(p)])[k % 3]
        if k % 4 == 0:
            yield pick(draw.randint(0, 250), 2)
        elif k % 4 == 1:
            yield nested(draw.randint(1, 4))[:700]
        else:
            yield pick(draw.randint(0, 60), 2) + (unit * 9)[: draw.randint(p, 9 * p)] + [0] * draw.randint(0, 90)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_runs_of_sequences(seed):
    every = list(sequences(seed, 240))
    want = [plain_runs(x) for x in every]
    for at in range(0, len(every), 40):  # many sequences in one array
        got = runs.runs_of([np.array(x, np.int64) for x in every[at : at + 40]])
        assert got == want[at : at + 40]
    assert sum(map(len, want)) > 300 and max(q for found in want for _, _, q in found) >= 100


def test_runs_of_long_sequences():
    draw = random.Random(4)
    unit = [draw.randrange(40) for _ in range(9_000)]
    x = [draw.randrange(40) for _ in range(500)] + unit * 5 + unit[:100]
    assert (500, 45_100, 9_000) in runs.runs_of([np.array(x)])[0]
    assert runs.runs_of([np.zeros(200_000, np.int64)])[0] == [(0, 200_000, 1)]
    assert runs.runs_of([]) == [] and runs.runs_of([np.zeros(0, np.int64)]) == [[]]


def test_runs_of_documents(spark, docs):
    got = runs.find(docs).collect()
    want = []
    for r in docs.collect():
        w = re.findall(r"[^\x20\x09-\x0D]+", r.text or "")
        found = plain_runs(w) if len(w) < 1000 else [(0, len(w), 1)]
        gone = {k for s, n, q in found for k in range(s + q, s + n)}
        want.append((r.doc_id, len(w), found, " ".join(x for k, x in enumerate(w) if k not in gone)))
    assert sorted(((r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in got), key=repr) == sorted(want, key=repr)
    assert runs.find(docs.where("doc_id < -1")).count() == 0


def test_planted_runs(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text")
    docs = docs.unionAll(spark.createDataFrame([(k, t) for k in range(1000, 1060) for t in (None, "one", "a b c d e f g " * 30)], docs.schema))
    got = {(r.doc_id, r.text) for r in queries.planted_runs(docs).collect()}
    want = set()
    for r in docs.collect():
        w, h = brute.TOKEN.findall(r.text or ""), zlib.crc32(str(r.doc_id).encode())
        if h % 10 or not w:
            want.add((r.doc_id, r.text))
            continue
        g, n = h // 10, len(w)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        want.add((r.doc_id, " ".join(w[k] if k < a else w[a + (k - a) % p] for k in range(n))))
    assert got == want


# 12: spelling variants


def near(u, v):
    u, v = sorted((u, v), key=len)
    if len(u) == len(v):
        return sum(a != b for a, b in zip(u, v)) == 1
    return len(v) == len(u) + 1 and any(v[:k] + v[k + 1 :] == u for k in range(len(v)))


def plain_groups(n, ratio=2):
    met = {}
    for u, v in itertools.combinations(n, 2):
        if near(u, v):
            met.setdefault(u, []).append(v)
            met.setdefault(v, []).append(u)
    form = {}
    for w in n:
        best = min(met.get(w, []), key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= ratio * n[w] else None
    out = set()
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, form[w], root, n[w], len(met.get(w, [])), n[form[w]] if form[w] else None))
    return out


@pytest.mark.parametrize("most", [variants.MOST, 40, 3])
def test_groups(spark, most):
    """Few letters make many near words, ties and chains; small states are split again and again."""
    draw = random.Random(most)
    word = lambda letters, a, b: "".join(draw.choice(letters) for _ in range(draw.randint(a, b)))
    n = {word("ab", 1, 9): draw.randint(3, 9) for _ in range(300)} | {word("abé", 5, 6): draw.choice([3, 7, 20, 50]) for _ in range(150)}
    n |= {"": 5, "c" * 2000: 3, "c" * 2001: 8, "c" * 1999 + "d": 4, "d" + "c" * 1999: 30}
    got = variants.group(spark.createDataFrame(list(n.items()), "word string, n long"), most=most)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert {tuple(r) for r in got.collect()} == plain_groups(n)


def test_acceptor_is_minimal():
    draw = random.Random(8)
    for _ in range(50):
        words = {"".join(draw.choice("ab") for _ in range(draw.randint(0, 6))) for _ in range(20)}
        made = variants.Acceptor(sorted(words))
        seen, stack, accepted = {0}, [(0, "")], set()
        while stack:
            state, text = stack.pop()
            if made.final[state]:
                accepted.add(text)
            for letter, to in made.edges[state].items():
                seen.add(to)
                stack.append((to, text + letter))
        prefixes = {w[:k] for w in words for k in range(len(w) + 1)} | {""}
        rests = {frozenset(w[len(p) :] for w in words if w.startswith(p)) for p in prefixes}
        assert accepted == words and len(seen) == len(rests)


def test_counted_words(spark, docs):
    got = {r.word: r.n for r in variants.count_words(docs, least_count=1).collect()}
    want = Counter(w for r in docs.collect() for w in re.findall("[A-Za-zÀ-ÿ]+", (r.text or "").translate(brute.LOWER)) if len(w) >= 5)
    assert got == dict(want)
    assert variants.group(variants.count_words(docs.where("doc_id < -1"))).count() == 0
    assert {r.word for r in variants.group(variants.count_words(docs, least_count=1)).where("n_near > 0").collect()} == {"grosse", "grosses"}


# 13: the BPE tree


@pytest.fixture(scope="module")
def library():
    import tiktoken

    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe_tree.read_ranks(RANKS), special_tokens={})


def ids_of(tree, text):
    return np.frombuffer(tree.encode(text), "<u4").tolist()


@pytest.mark.parametrize("leaf", [2, 3, 9])
def test_tree_gives_the_librarys_ids(library, leaf):
    """With leaves this small nearly every word crosses a cut."""
    tree, draw = bpe_tree.Tree(bpe_tree.read_ranks(RANKS), leaf=leaf, most=300), random.Random(leaf)
    bits = [" ", "  ", "\n", "\t", "a", "Be", "é", "'s", "'", "r", "e", "12", ".", ",", "\x1c", "\x85", "日本", "<|endoftext|>", "ß", "I'll", "\r", "😀", "́", "ǅ", "²", "_", "the", "ing", "aaaa", "ที่", "\U0001e030", "Ʝ", "֋"]
    for k in range(500):
        bits_now = draw.choices(bits, k=draw.randint(0, 30))
        text = "".join(b * (draw.choice([1, 1, 40, 90]) if k % 5 == 0 else 1) for b in bits_now)
        assert ids_of(tree, text) == library.encode_ordinary(text), repr(text)
        assert tree.decode(tree.encode(text)) == text.encode()


def test_tree_of_long_words(library):
    tree, draw = bpe_tree.Tree(bpe_tree.read_ranks(RANKS)), random.Random(1)
    for text in ("a" * 20_001, "abc" * 9_000, " " * 9_000 + "x", "ก" * 7_000, "".join(draw.choice("日本語中文字") for _ in range(9_000)), "".join(draw.choice("aeinrst") for _ in range(30_000))):
        assert ids_of(tree, text) == library.encode_ordinary(text)


def test_merges_with_a_heap(library):
    tree, draw = bpe_tree.Tree(bpe_tree.read_ranks(RANKS)), random.Random(2)
    for _ in range(300):
        data = bytes(draw.choice(b"aeinst \xc3\xa9") for _ in range(draw.randint(1, 120)))
        assert tree.merge(data) == tree._merge_long(data)


def test_entries_that_no_merge_gives():
    """Where whole words are looked up, joining must still go by the merges."""
    ranks = {bytes([k]): k for k in range(256)} | {b"ab": 300, b"bc": 299, b"abc": 301, b"xyz": 302}
    import tiktoken

    library, draw = tiktoken.Encoding("odd", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}), random.Random(3)
    tree = bpe_tree.Tree(ranks, leaf=3)
    assert ids_of(tree, "xyz") == [302] and tree.merge(b"xyz") != [302]
    tree.short = 3
    for _ in range(2000):
        text = "".join(draw.choice("abcxyz ") for _ in range(draw.randint(0, 20)))
        assert ids_of(tree, text) == library.encode_ordinary(text)


def test_tree_of_documents(spark, docs, library):
    got = bpe_tree.decode(bpe_tree.encode(docs, RANKS, leaf=64), RANKS).collect()
    want = [(r.doc_id, library.encode_ordinary(r.text or ""), (r.text or "").encode()) for r in docs.collect()]
    assert sorted(((r.doc_id, np.frombuffer(r.ids, "<u4").tolist(), bytes(r.decoded)) for r in got), key=repr) == sorted(want, key=repr)
    assert all(r.n_tokens == len(r.ids) // 4 for r in got)
    assert bpe_tree.encode(docs.where("doc_id < -1"), RANKS).count() == 0


def test_tree_query(spark, library):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    for r in queries.op13(spark, FOLDER).collect():
        ids = library.encode_ordinary(docs[r.doc_id])
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), _sha(np.array(ids, "<u4").tobytes()), _sha(docs[r.doc_id]))


@pytest.mark.parametrize("name", ["op11_periodic_runs", "op12_spelling_variants"])
def test_query_against_sql(spark, name):
    found, sql = load_all()
    assert compare(found[name](spark, FOLDER), connect(FOLDER), sql[name]) is None
