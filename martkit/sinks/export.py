"""Exports for reporting tools, manifests and status reads."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martkit.sinks.writers import Staging, _exists
from martkit.sources.tabular import BOM, list_files, read_typed_csv


def _csv_text(c: Column, kind: str) -> Column:
    """Shortest text that reads back as the same value: whole doubles lose ``.0``; those that a plain decimal cannot hold
    keep their exponent."""
    if kind in ("double", "float"):
        plain = c.try_cast("decimal(38,17)").cast("string")
        short = F.regexp_replace(F.regexp_replace(plain, r"(\.\d*?)0+$", "$1"), r"\.$", "")
        return F.when(short.try_cast(kind) == c, short).otherwise(c.cast("string"))
    if kind.startswith("timestamp"):
        return c.cast("string")
    return c


def write_csv(df: DataFrame, path: str, order: Sequence[Column | str] = ()) -> DataFrame:
    """UTF-8 with byte-order mark and header, in the given order.

    The rows are staged first: the sort by range, which looks at them twice, then works nothing out again, and they are
    counted there. A large table becomes several files that continue each other, each with mark and header; a small one
    ends up in a single file when its sort partitions are coalesced. Returns the one-row manifest entry.
    """
    spark = df.sparkSession
    with Staging(spark, "export") as stage:
        staged = stage(df)
        rows = staged.count()
        ordered = staged.orderBy(*order) if order else staged
        plain = ordered.select(*[_csv_text(F.col(f"`{n}`"), t).alias(n) for n, t in df.dtypes])
        first = plain.columns[0]
        out = plain.withColumnRenamed(first, BOM + first)
        writer = out.write.mode("overwrite").option("header", "true").option("escape", '"').option("encoding", "UTF-8")
        # padding belongs to the text
        writer.option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false").csv(path)
    size = list_files(spark, path, "*.csv").agg(F.sum("bytes").alias("bytes"), F.count(F.lit(1)).alias("files"))
    return size.select(F.lit(path.rsplit("/", 1)[-1]).alias("name"), F.lit(rows).cast("bigint").alias("rows"), "files", "bytes")


def export_bundle(tables: Mapping[str, tuple[DataFrame, Sequence]], folder: str) -> DataFrame:
    """Write a named set of (table, order) next to each other; returns one manifest row per table."""
    entries = [write_csv(df, f"{folder.rstrip('/')}/{name}", order).collect()[0] for name, (df, order) in tables.items()]
    spark = next(iter(tables.values()))[0].sparkSession
    return spark.createDataFrame(entries, "name string, rows bigint, files bigint, bytes bigint")


def read_export(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return read_typed_csv(spark, path, schema)


def as_records(df: DataFrame, name: str = "record") -> DataFrame:
    """One JSON object per row: decimals as numbers, dates and times as ISO text, nulls kept."""
    fields = []
    for n, t in df.dtypes:
        c = F.col(f"`{n}`")
        if t.startswith("decimal"):
            c = c.cast("double")
        elif t == "date":
            c = c.cast("string")
        elif t.startswith("timestamp"):
            c = F.replace(c.cast("string"), F.lit(" "), F.lit("T"))
        fields.append(c.alias(n))
    return df.select(F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}).alias(name))


def mart_status(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """(ready, reason, ...): whether a summary was built, and its figures."""
    if not _exists(spark, path):
        return spark.range(1).select(F.lit(False).alias("ready"), F.lit("summary not built yet").alias("reason"))
    stored = spark.read.parquet(path).select(*columns)
    # a summary without rows is as good as none: the one row then says so
    one = spark.range(1).join(stored.withColumn("_there", F.lit(True)), F.lit(True), "left")
    ready = F.coalesce("_there", F.lit(False))
    return one.select(ready.alias("ready"), *columns)
