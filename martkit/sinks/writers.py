"""Conflict-aware writes to month-partitioned Parquet tables.

No table is read and overwritten in one step: what a rewrite needs from the table is written to the shared
scratch area first. A lost executor only repeats tasks of one write. Running a load again gives the same table;
a load that died while months were being swapped in is repaired by running it again, provided its window starts
and ends on month bounds, so that nothing but the batch belongs to the months it rewrites.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martkit.functions.dates import month_start, wall_time
from martkit.operators.dedupe import keep_first, keep_last
from martkit.session import scratch_path

MONTH = "month"


def _file_system(spark: SparkSession, path: str):
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark._jsc.hadoopConfiguration()), location


def _exists(spark: SparkSession, path: str) -> bool:
    fs, location = _file_system(spark, path)
    return fs.exists(location)


def _with_month(df: DataFrame, at: str) -> DataFrame:
    return df.withColumn(MONTH, F.date_format(month_start(at), "yyyy-MM"))


class Staging:
    """Rows written to scratch and read back: worked out once, and without lineage to the table about to change.

    The folder goes when the load has succeeded. After a failure it stays, with the rows a repair may need.
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.root = scratch_path(spark, label)
        self.count = 0

    def __call__(self, df: DataFrame) -> DataFrame:
        self.count += 1
        path = f"{self.root}/{self.count}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def __enter__(self) -> Staging:
        return self

    def __exit__(self, kind, value, trace) -> None:
        if kind is None:
            fs, path = _file_system(self.spark, self.root)
            fs.delete(path, True)


def _months(df: DataFrame) -> set[str]:
    """Months present; one row per month comes to the driver."""
    return {r[MONTH] for r in df.select(MONTH).distinct().collect()}


def _month_sizes(df: DataFrame, inside: Column) -> list:
    """(month, n, inside) of each month present."""
    return df.groupBy(MONTH).agg(F.count(F.lit(1)).alias("n"), F.count_if(inside).alias("inside")).collect()


def _starts_month(at: datetime) -> bool:
    return at == datetime(at.year, at.month, 1)


def _replace_months(staged: DataFrame, path: str, filled: set[str], months: Sequence[str]) -> None:
    """Give each listed month exactly the staged rows, clearing those that are not ``filled``.

    Rebalancing by month keeps the file count down; a month with very many rows is still split over tasks.
    """
    writer = staged.hint("rebalance", MONTH).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(MONTH).parquet(path)
    spark = staged.sparkSession
    # months left without rows go as folders, without a job each; a table without any month keeps its schema in an empty one
    fs, root = _file_system(spark, path)
    cleared = sorted(set(months) - filled)
    for month in cleared:
        fs.delete(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{MONTH}={month}"), True)
    if cleared and not any(f.getPath().getName().startswith(f"{MONTH}=") for f in fs.listStatus(root)):
        spark.createDataFrame([], staged.drop(MONTH).schema).write.mode("overwrite").parquet(f"{path}/{MONTH}={cleared[0]}")


def rebuild(df: DataFrame, path: str) -> DataFrame:
    """Drop and create: the table holds exactly ``df``."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def append_log(df: DataFrame, path: str, stamp: str = "inserted_at") -> None:
    """Append rows, stamped with the write time unless they carry one."""
    out = df if stamp in df.columns else df.withColumn(stamp, F.current_timestamp())
    out.write.mode("append").parquet(path)


def months_between(start: date | datetime, end: date | datetime) -> list[str]:
    """Months touched by the half-open window ``[start, end)``."""
    moment = end if isinstance(end, datetime) else datetime(end.year, end.month, end.day)
    last = moment - timedelta(microseconds=1)
    last = (last.year, last.month)
    out, year, month = [], start.year, start.month
    while (year, month) <= last:
        out.append(f"{year:04d}-{month:02d}")
        year, month = (year, month + 1) if month < 12 else (year + 1, 1)
    return out


def absent_keys(batch: DataFrame, existing: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Batch rows whose key the existing table does not hold.

    The stored table may be huge and the batch small, so the table is first cut to the keys of the batch: with
    a batch under the broadcast bound that is a map-only pass over its key columns, without shuffling it.
    """
    return batch.join(_clashing(batch, existing, keys), list(keys), "left_anti")


def _clashing(batch: DataFrame, existing: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys of the batch found in the table."""
    return existing.select(*keys).join(batch.select(*keys), list(keys), "left_semi").distinct()


def replace_window(
    batch: DataFrame,
    path: str,
    at: str,
    start: datetime,
    end: datetime,
    keys: Sequence[str],
    order: Sequence[str] = (),
) -> dict[str, int]:
    """Delete ``[start, end)`` and insert the batch; keys present elsewhere in the table are ignored.

    Within the batch the first row per key by ``order`` is kept. An empty batch clears the window. Rows of
    the touched months outside the window are kept. Reports distinct keys of the batch and stored rows.
    """
    spark = batch.sparkSession
    lo, hi = wall_time(start), wall_time(end)
    inside = (F.col(at) >= lo) & (F.col(at) < hi)
    months = months_between(start, end)
    with Staging(spark, "window") as stage:
        fresh = stage(_with_month(keep_first(batch, keys, order).drop(*order), at))
        accepted, per_month = fresh, _month_sizes(fresh, inside)
        distinct = sum(r.n for r in per_month)
        # a batch may hold rows outside its window: their months are rewritten too
        touched = sorted({*months, *(r[MONTH] for r in per_month)})
        survivors = None
        if _exists(spark, path):
            # what the rewrite needs from the table is staged: clashing keys, and rows of touched months to be kept
            # months the window covers whole are skipped by partition pruning
            covered = months[(not _starts_month(start)):(len(months) - (not _starts_month(end)))]
            kept = spark.read.schema(fresh.schema).parquet(path).where(~F.col(MONTH).isin(*covered) & ~inside)
            clash = stage(_clashing(fresh, kept, keys))
            if not clash.isEmpty():
                accepted = fresh.join(clash, list(keys), "left_anti")
                per_month = _month_sizes(accepted, inside)
            if touched != covered:
                survivors = stage(kept.where(F.col(MONTH).isin(*touched)))
        filled = {r[MONTH] for r in per_month} | (_months(survivors) if survivors else set())
        _replace_months(accepted.unionByName(survivors) if survivors else accepted, path, filled, touched)
        return {"distinct": distinct, "in_window": sum(r.inside for r in per_month)}


def insert_if_absent(batch: DataFrame, path: str, keys: Sequence[str], order: Sequence[str] = (), at: str | None = None) -> int:
    """Append rows whose key is new; the first writer of a key wins."""
    spark = batch.sparkSession
    fresh = keep_first(batch, keys, order)
    if at:
        fresh = _with_month(fresh, at)
    with Staging(spark, "insert") as stage:
        if _exists(spark, path):
            fresh = stage(fresh)
            fresh = absent_keys(fresh, spark.read.schema(fresh.schema).parquet(path), keys)
        new = stage(fresh)
        if at:
            new.hint("rebalance", MONTH).write.mode("append").partitionBy(MONTH).parquet(path)
        else:
            new.write.mode("append").parquet(path)
        return new.count()


def upsert(batch: DataFrame, path: str, keys: Sequence[str], at: str, version: str = "inserted_at") -> None:
    """Replace the row of a known key, add unknown ones; only months of the batch are rewritten.

    ``at`` must be part of the key, so a key never moves to another month. The batch wins over the table,
    its highest ``version`` over its other rows.
    """
    if at not in keys:
        raise ValueError("the date that partitions the table must be part of the key")
    spark = batch.sparkSession
    fresh = batch if version in batch.columns else batch.withColumn(version, F.current_timestamp())
    fresh = _with_month(keep_last(fresh, keys, [version]), at)
    with Staging(spark, "upsert") as stage:
        fresh = stage(fresh)
        months = _months(fresh)
        if _exists(spark, path):
            table = spark.read.schema(fresh.schema).parquet(path).where(F.col(MONTH).isin(*months))
            fresh = stage(table.join(fresh.select(*keys), list(keys), "left_anti")).unionByName(fresh)
        _replace_months(fresh, path, months, sorted(months))
