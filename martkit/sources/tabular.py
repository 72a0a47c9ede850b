"""Delimited files: header harmonising, required files and columns, typed imports."""

from __future__ import annotations

import csv
import io
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from martkit.functions.text import header_key
from martkit.sources.records import first_records, read_csv

BOM = "﻿"


class MissingSource(ValueError):
    """A needed file or column is not there."""


def list_files(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """File name, path and size; the content column is pruned, so no file is read."""
    files = (
        spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(folder)
    )
    return files.select(F.substring_index("path", "/", -1).alias("file_name"), "path", F.col("length").alias("bytes"))


def file_report(spark: SparkSession, folder: str, expected: DataFrame) -> DataFrame:
    """``file_name, found, bytes`` for every expected name (a table ``file_name``), listed without reading a file."""
    found = list_files(spark, folder).groupBy("file_name").agg(F.sum("bytes").alias("bytes"))
    return expected.select("file_name").distinct().join(found, "file_name", "left").select("file_name", F.col("bytes").isNotNull().alias("found"), "bytes")


def check_files(spark: SparkSession, folder: str, expected: Sequence[str]) -> DataFrame:
    """Sizes of the expected files, or an error that lists every missing one."""
    wanted = spark.createDataFrame([(n,) for n in expected], "file_name string")
    missing = [r.file_name for r in file_report(spark, folder, wanted).where("NOT found").orderBy("file_name").collect()]
    if missing:
        raise MissingSource(f"missing in {folder}: {', '.join(missing)}")
    return list_files(spark, folder).join(F.broadcast(wanted), "file_name", "left_semi")


def map_headers(headers: Sequence[str | None], aliases: Mapping[str, str]) -> dict[str, int]:
    """Target column -> position; the first header that stands for a target wins."""
    positions: dict[str, int] = {}
    for i, raw in enumerate(headers):
        target = aliases.get(header_key((raw or "").lstrip(BOM)))
        if target and target not in positions:
            positions[target] = i
    return positions


def require_columns(name: str, positions: Mapping[str, int], required: Sequence[str], headers: Sequence) -> None:
    missing = [c for c in required if c not in positions]
    if missing:
        raise MissingSource(f"{name} lacks {missing}; its headers are {list(headers)}")


def column_report(spark: SparkSession, paths: Sequence[str], aliases: Mapping[str, str], required: Sequence[str]) -> DataFrame:
    """``path, header, missing`` of every file: what its header lacks of the required columns."""
    rows = []
    for path, line in first_records(spark, paths):
        header = next(csv.reader(io.StringIO(line, newline="")))
        found = map_headers(header, aliases)
        rows.append((path, header, [c for c in required if c not in found]))
    return spark.createDataFrame(rows, "path string, header array<string>, missing array<string>")


def read_harmonised(
    spark: SparkSession,
    paths: Sequence[str],
    aliases: Mapping[str, str],
    targets: Sequence[str],
    required: Sequence[str] = (),
    tag: str = "source_file",
) -> DataFrame:
    """Delimited files with differing headers as one table of text columns.

    A path may be a folder, whose files may differ among themselves. A short read of each file's beginning gives its header;
    files with the same header are read by one scan, so the plan grows with the number of layouts, not of files. Absent
    columns are null. A quoted field may span lines, and large files are read by many tasks.
    """
    layouts: dict[str, list[str]] = {}
    for path, line in first_records(spark, paths):
        layouts.setdefault(line, []).append(path)
    if not layouts:
        raise MissingSource(f"no data in {list(paths)}")

    def scan(line: str, files: list[str]) -> DataFrame:
        header = next(csv.reader(io.StringIO(line, newline="")))
        positions = map_headers(header, aliases)
        require_columns(files[0], positions, required, header)
        names = [f"c{i}" for i in range(len(header))]
        raw = read_csv(spark, files, ", ".join(f"{n} string" for n in names))
        columns: list[Column] = [
            (F.col(f"r.{names[positions[t]]}") if t in positions else F.lit(None).cast("string")).alias(t) for t in targets
        ]
        return raw.select(*columns, F.col("name").alias(tag))

    return reduce(DataFrame.unionByName, [scan(h, sorted(f)) for h, f in sorted(layouts.items())])


def drop_blank(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Drop rows in which all of ``keys`` are null, such as the empty tail of a sheet."""
    blank = reduce(lambda a, b: a & b, [F.col(k).isNull() for k in keys])
    return df.where(~blank)


def read_typed_csv(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """UTF-8 with byte-order mark, header line, quoted fields that may span lines, declared types; large files are read by
    many tasks."""
    kind = schema if isinstance(schema, str) else ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    return read_csv(spark, [path], kind).select("r.*")


def read_table(spark: SparkSession, path: str, columns: Sequence[str], where: str | None = None, **args) -> DataFrame:
    """Projection and parameterised filter of a stored table; both reach the scan."""
    table = spark.read.parquet(path)
    if where is None:
        return table.select(*columns)
    names = ", ".join(f"`{c}`" for c in columns)
    return spark.sql(f"SELECT {names} FROM {{table}} WHERE {where}", args=args, table=table)
