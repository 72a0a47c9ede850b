"""Quality gates: all rules are evaluated, then one error names every problem."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martkit.functions.text import _col
from martkit.operators.calendar import missing_months
from martkit.operators.marts import duplicate_keys


class QualityError(ValueError):
    """At least one rule failed."""


@dataclass(frozen=True)
class RowRule:
    """Counts rows for which ``violates`` is true; null counts as passed."""

    name: str
    violates: Column


@dataclass
class Gate:
    """Rules over one or more tables, reported as (rule, violations, passed).

    What can be counted row by row is counted in one scan for each table, however many calls named it.
    """

    counted: dict[int, tuple[DataFrame, list[tuple[str, Column]]]] = field(default_factory=dict)
    parts: list[DataFrame] = field(default_factory=list)

    def _row_counts(self, df: DataFrame, rules: Sequence[tuple[str, Column]]) -> Gate:
        self.counted.setdefault(id(df), (df, []))[1].extend(rules)
        return self

    def rows(self, df: DataFrame, rules: Sequence[RowRule], not_empty: str | None = None) -> Gate:
        """Rules on single rows, and on there being any."""
        counts = [(r.name, F.count_if(r.violates)) for r in rules]
        if not_empty:
            counts.append((not_empty, (F.count(F.lit(1)) == 0).cast("bigint")))
        return self._row_counts(df, counts)

    def not_empty(self, df: DataFrame, name: str) -> Gate:
        return self.rows(df, [], not_empty=name)

    def unique(self, df: DataFrame, keys: Sequence[str], name: str, fold_case: bool = False) -> Gate:
        """Number of keys found more than once, optionally ignoring case."""
        cols = [F.lower(k).alias(k) if fold_case else F.col(k) for k in keys]
        return self._count(duplicate_keys(df.select(*cols), list(keys)), name)

    def no_missing_months(self, series: DataFrame, name: str, month: str = "month") -> Gate:
        return self._count(missing_months(series, month), name)

    def at_least(self, df: DataFrame, rows: int, name: str) -> Gate:
        """Number of rows short of ``rows``."""
        short = F.greatest(F.lit(0).cast("bigint"), F.lit(rows) - F.count(F.lit(1)))
        return self._row_counts(df, [(name, short)])

    def _count(self, bad: DataFrame, name: str) -> Gate:
        self.parts.append(bad.agg(F.count(F.lit(1)).alias("violations")).select(F.lit(name).alias("rule"), "violations"))
        return self

    def report(self) -> DataFrame:
        tables = []
        for df, rules in self.counted.values():
            counts = df.agg(*[c.alias(f"r{i}") for i, (_, c) in enumerate(rules)])
            pairs = [F.struct(F.lit(n).alias("rule"), F.col(f"r{i}").alias("violations")) for i, (n, _) in enumerate(rules)]
            tables.append(counts.select(F.inline(F.array(*pairs))))
        together = reduce(DataFrame.unionByName, tables + self.parts)
        return together.withColumn("passed", F.col("violations") == 0)

    def enforce(self) -> DataFrame:
        """Raise once with every failed rule; otherwise hand back the report (one row per rule)."""
        report = self.report()
        rows = report.collect()
        failed = [f"{r.rule}: {r.violations}" for r in rows if not r.passed]
        if failed:
            raise QualityError("data did not pass: " + " | ".join(failed))
        return report.sparkSession.createDataFrame(rows, "rule string, violations bigint, passed boolean")


def out_of_range(c: str, low, high) -> Column:
    """Known values outside ``[low, high]``."""
    return _col(c).isNotNull() & ~_col(c).between(low, high)


def off_globe(lat: str, lon: str) -> Column:
    """Coordinates that cannot be; only rows with a latitude are looked at."""
    return _col(lat).isNotNull() & (~_col(lat).between(-90, 90) | ~_col(lon).between(-180, 180))


def require_rows(df: DataFrame, rows: int, what: str) -> int:
    """Row count, or an error when there are too few."""
    n = df.count()
    if n < rows:
        raise QualityError(f"{what}: {n} rows, at least {rows} needed")
    return n
