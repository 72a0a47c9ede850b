"""Named queries on the test tables, each with the SQL that must give the same rows where SQL can say it."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """Test tables by name: ``t.orders`` reads ``<dir>/orders.parquet``."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


def plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles, so that both engines hand back the same types."""
    return df.select(*[F.col(f"`{n}`").cast("double").alias(n) if t.startswith("decimal") else F.col(f"`{n}`") for n, t in df.dtypes])


def query(name: str, sql: str | None = None):
    def register(build: Callable[[Tables], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return plain(build(Tables(spark, folder)))

        if name in QUERIES:
            raise ValueError(f"two queries named {name}")
        QUERIES[name] = run
        if sql:
            ORACLES[name] = sql
        return build

    return register


def half_up_sql(total: str, count: str, decimals: int, digits: int) -> str:
    """Whole-number SQL for ``total * 10**-decimals / count`` rounded half away from zero to ``digits``."""
    unit, scale = 10**decimals, 10**digits
    return (
        f"(CAST(sign({total}) * ((2 * abs({total})::HUGEINT * {scale} + ({count})::HUGEINT * {unit}) "
        f"// (2 * ({count})::HUGEINT * {unit})) AS DOUBLE) / {scale})"
    )


def units_sql(column: str, decimals: int = 2) -> str:
    return f"CAST(round({column} * {10**decimals}) AS BIGINT)"


def mean_sql(column: str, digits: int, decimals: int = 2) -> str:
    """Exact counterpart of ``fixed_mean``."""
    return half_up_sql(f"sum({units_sql(column, decimals)})", f"count({column})", decimals, digits)


MODULES = ("series", "marts", "scalars", "tables", "star", "storage", "pages", "models", "flows", "edges", "books")


def load_all() -> tuple[dict, dict]:
    """All queries and their SQL."""
    for module in MODULES:
        importlib.import_module(f"martkit.catalog.{module}")
    return QUERIES, ORACLES
