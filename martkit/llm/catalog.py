"""The operators' queries over whole tables, and SQL that must give the same rows where SQL can say it."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def query(name: str, sql: str | None = None):
    def register(build: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = build
        if sql:
            ORACLES[name] = sql
        return build

    return register


MODULES = ("queries",)


def load_all() -> tuple[dict, dict]:
    for module in MODULES:
        importlib.import_module(f"martkit.llm.{module}")
    return QUERIES, ORACLES
