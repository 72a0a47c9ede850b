"""From raw documents to token files: quality rules, one document of each group of near duplicates, benchmark passages cut
out, a mix of sources in training order, token files. Each stage is written and read again before the next.

The stages count as part of ``martkit.llm``. The mix hands on a row for each use of a document, sorted by training position
from file to file; the token files keep that order, which they take from the places of the rows in the files.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martkit.llm import ans, decontamination, mixing, near, quality
from martkit.llm.catalog import table
from martkit.llm.common import stage
from martkit.session import scratch_path

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
END_ID = 2


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and lie near their language's histograms."""
    return quality.keep(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of documents linked at 0.8 of their five-word shingles, the one with the smallest id."""
    return near.one_of_each(docs, threshold=0.8)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of ten or more words that a test item has go; so do documents that are such passages for over a fifth."""
    return decontamination.clean(docs, table(spark, sf_dir, "benchmark"), window=10, min_span=10, max_coverage=0.2)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, sorted by training position."""
    return mixing.apply(docs)


def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of all uses in training order, and what they give back for each: ``doc_id`` and where its ids stand."""
    path = scratch_path(spark, "corpus")
    part = F.regexp_extract("_metadata.file_name", r"part-(\d+)", 1)
    placed = docs.select("doc_id", "text", F.coalesce(part.try_cast("int"), F.lit(0)).alias("file"), F.col("_metadata.row_index").alias("row"))
    ans.write(placed, path, TOKENIZER, END_ID, order=("file", "row"))
    return ans.decoded(ans.read(spark, path))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontaminate),
    ("mixing sources to target weights", mix),
    ("token-ID / binary output", token_files),
]

#: The join on shingles and the token ids are beyond SQL; tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn, from ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, apply in STAGES[:-1]:
        docs = stage(apply(spark, docs, sf_dir), f"corpus-{name.split()[0]}")
    return STAGES[-1][1](spark, docs, sf_dir)
