"""The registered queries against their SQL, the pipeline stage by stage, and the entry without this folder."""

import subprocess
import sys
from pathlib import Path

import corpus_pipeline
from martkit.llm.catalog import load_all
from martkit.llm.queries import OP3_SQL
from tests.llm import brute
from tests.oracle import compare, connect

FOLDER = "/root/testdata/sf0.001"


def test_names():
    names = list(load_all()[0])
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))


def test_license_columns(spark):
    df = load_all()[0]["op3_license_diagonals"](spark, FOLDER)
    assert compare(df, connect(FOLDER), OP3_SQL) is None


def test_near_query(spark):
    got = {r.doc_id: (r.class_id, r.n_links) for r in load_all()[0]["op9_near_duplicate_forest"](spark, FOLDER).collect()}
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]
    assert got == brute.near(docs)


def test_secret_query(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    for r in load_all()[0]["op4_linked_secrets"](spark, FOLDER).collect():
        counts, text = brute.secrets(docs[r.doc_id])
        assert [r.n_assign, r.n_access, r.n_hex] == counts and r.base_sha256 == brute.sha(text)


def test_pipeline(spark, tmp_path):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, kept = docs.columns, {}
    for name, work in corpus_pipeline.STAGES:
        out = work(spark, docs, FOLDER)
        out.write.parquet(str(tmp_path / name.split()[0].replace("/", "-")))
        before, docs = docs, spark.read.parquet(str(tmp_path / name.split()[0].replace("/", "-")))
        kept[name] = [r.asDict() for r in docs.collect()]
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == columns
        if name == "n-gram Jaccard join":
            classes = brute.near([(r.doc_id, r.text) for r in before.collect()])
            assert sorted(r["doc_id"] for r in kept[name]) == sorted({c for c, _ in classes.values()})
        if name == "benchmark decontamination":
            items = [(r.item_id, r.text) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
            assert all(brute.leaks(r["text"], items)[1] == 0 for r in kept[name])
            clean = {r.doc_id for r in before.collect() if brute.leaks(r.text, items)[1] == 0}
            assert clean <= {r["doc_id"] for r in kept[name]}
    assert all(not brute.quality(r["text"])[-1] for r in kept["quality rules"])
    uses, files = kept["mixing sources to target weights"], sorted(kept["token-ID / binary output"], key=lambda r: r["start"])
    assert sorted(r["doc_id"] for r in uses) == [r["doc_id"] for r in sorted(files, key=lambda r: r["doc_id"])]
    ends = [r["start"] + r["n_tokens"] for r in files]
    assert [r["start"] for r in files] == [0, *ends[:-1]]


def test_run(spark):
    assert corpus_pipeline.run(spark, FOLDER).columns == ["doc_id", "start", "n_tokens", "ids_crc32"]


def test_entry_without_this_folder():
    code = (
        "import sys\n"
        "class Gone:\n"
        "    def find_spec(self, name, path=None, target=None):\n"
        "        if name == 'corpus_pipeline' or name.startswith('martkit.llm'):\n"
        "            raise ModuleNotFoundError(name)\n"
        "sys.meta_path.insert(0, Gone())\n"
        "import __spark_entry__ as e\n"
        "assert e.queries() and not [n for n in e.queries() if n.startswith('op') and n[2].isdigit()] and 'pipeline' not in e.oracle_sql()\n"
    )
    subprocess.run([sys.executable, "-c", code], check=True, cwd=Path(__file__).resolve().parents[2])
