"""What the operators share: staging, column checks, word patterns and Arrow batches."""

from __future__ import annotations

import ctypes
import gc
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martkit.session import scratch_path

#: Fixed values of the contracts. A word is a run of letters, digits and everything beyond ASCII, ...
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: ... or whatever stands between white space.
TOKEN = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: For Python's ``str.translate``: only A-Z change, other capitals stay.
TO_LOWER = str.maketrans(UPPER, LOWER)


def need(df: DataFrame, *columns: str) -> None:
    """Fail early, by name, where a column is missing."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"columns {missing} are missing; there are {df.columns}")


def id_text(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id long, text string`` alone, null texts as empty; other columns, whatever their names, stay out."""
    need(df, id_col, text_col)
    return df.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))


def stage(df: DataFrame, label: str, **options) -> DataFrame:
    """Write to a new folder of the shared area and read it back: lineage ends there, and lost executors cost nothing."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def chunks_of(batches: Iterator[pa.RecordBatch], bytes_at_once: int = 4 << 20) -> Iterator[tuple[list, list]]:
    """(ids, texts) of some rows at a time, about ``bytes_at_once`` of text each: a bound on memory, not on rows."""
    for b in batches:
        ids, texts = b.column("doc_id"), b.column("text")
        if not b.num_rows:
            continue
        step = max(1, int(b.num_rows * bytes_at_once / max(1, b.nbytes)))
        for i in range(0, b.num_rows, step):
            yield ids.slice(i, step).to_pylist(), texts.slice(i, step).to_pylist()


def sent_if_small(df: DataFrame, row_bytes: int, bound: int = 64 << 20) -> DataFrame:
    """A written table, marked to be sent to all tasks if its rows, counted, take no more than ``bound`` bytes; else as it is,
    for a join that shuffles."""
    return F.broadcast(df) if df.count() * row_bytes <= bound else df


def remembered(operator: str) -> dict:
    """What a worker process keeps for the later tasks of one operator. It keeps nothing of any other: workers live on from
    stage to stage, and what several operators remember would add up."""
    kept = sys.modules.setdefault("_martkit_memory", type(sys)("_martkit_memory")).__dict__
    own = kept.get("own")
    if own is None or own[0] != operator:
        kept.pop("own", None)
        own = None
        gc.collect()
        try:  # hand what is free back to the system, where the C library can
            ctypes.CDLL(None).malloc_trim(0)
        except (OSError, AttributeError):
            pass
        own = kept["own"] = (operator, {})
    return own[1]


def free_names(df: DataFrame, *wanted: str) -> list[str]:
    """The wanted names, each with as many underscores before it as no column of ``df`` has, upper or lower case."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in wanted:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out


def attach(rows: DataFrame, known: DataFrame, key: str, spread: tuple[str, ...], row_bytes: int, salts: int = 16) -> DataFrame:
    """``rows`` with the columns of ``known``, a written table with one row for each of some keys, null where it has none. Small
    tables are sent to all tasks; beyond that every key is split over ``salts`` tasks by the columns ``spread``, so that one key
    may have any number of rows."""
    if known.count() * row_bytes <= 64 << 20:
        return rows.join(F.broadcast(known), key, "left")
    salted = rows.withColumn("salt", F.pmod(F.xxhash64(*spread), F.lit(salts)).cast("int"))
    every = known.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted.join(every, [key, "salt"], "left").drop("salt")


def lower_ascii(column: Column) -> Column:
    return F.translate(column, UPPER, LOWER)


def mix64(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values (finaliser of a public 64-bit mixing function)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x
