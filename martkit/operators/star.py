"""Star-schema queries: measures over a fact and its dimensions.

A visual is measures x grouping x slicer x order. Only the dimensions it names are joined, to a fact that is
itself a roll-up of the raw rows. Dimensions carry no broadcast hint: the planner broadcasts them while their
measured size allows, and beyond that joins by shuffle, splitting skewed keys at run time.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martkit.functions.numbers import exact


@dataclass(frozen=True)
class Dimension:
    table: DataFrame
    fact_key: str
    key: str
    fold_case: bool = False
    #: (partition column of a stored fact, the dimension's column with the same value): joined on too, so that a slicer on the
    #: dimension leaves out the fact's other partitions before they are read.
    part: tuple[str, str] | None = None


def store_by_month(fact: DataFrame, path: str, day: str) -> DataFrame:
    """A fact written in folders of its months, and read back with that ``month``."""
    fact.withColumn("month", F.date_format(day, "yyyy-MM")).hint("rebalance", "month").write.partitionBy("month").parquet(path)
    return fact.sparkSession.read.schema(fact.schema.add("month", "string")).parquet(path)


@dataclass(frozen=True)
class Star:
    """``relations`` are many-to-one left joins from the fact."""

    fact: DataFrame
    relations: Mapping[str, Dimension]

    def joined(self, names: Sequence[str], slicers: Mapping[str, Column] | None = None) -> DataFrame:
        """Fact with the named dimensions; a slicer filters its dimension and through it the fact."""
        slicers = slicers or {}
        out = self.fact
        for name in dict.fromkeys([*names, *slicers]):
            dim = self.relations[name]
            table = dim.table.select(*[F.col(c).alias(f"{name}.{c}") for c in dim.table.columns])
            right = F.col(f"`{name}.{dim.key}`")
            left = F.col(dim.fact_key)
            if dim.fold_case:
                left, right = F.lower(left), F.lower(right)
            if name in slicers:
                chosen = dim.table.where(slicers[name])
                table = chosen.select(*[F.col(c).alias(f"{name}.{c}") for c in chosen.columns])
            same = left == right
            if dim.part:
                same = same & (F.col(dim.part[0]) == F.col(f"`{name}.{dim.part[1]}`"))
            out = out.join(table, same, "inner" if name in slicers else "left")
        return out

    def query(
        self,
        measures: Mapping[str, Column],
        by: Mapping[str, tuple[str, str]] | None = None,
        slicers: Mapping[str, Column] | None = None,
        order: Sequence[Column] = (),
    ) -> DataFrame:
        """``by`` maps an output column to (dimension, column); dimension ``""`` means the fact itself."""
        by = by or {}
        names = [d for d, _ in by.values() if d]
        keys = [F.col(f"`{d}.{c}`" if d else c).alias(out) for out, (d, c) in by.items()]
        joined = self.joined(names, slicers)
        grouped = joined.groupBy(*keys) if keys else joined.groupBy()
        out = grouped.agg(*[m.alias(n) for n, m in measures.items()])
        return out.orderBy(*order) if order else out


def total(count: str) -> Column:
    return F.sum(count)


def largest(value: str) -> Column:
    return F.max(value)


def distinct_labels(label: str, fold_case: bool = False) -> Column:
    return F.count_distinct(F.lower(label) if fold_case else F.col(label))


def total_in(count: str, label: str, chosen: Sequence[str]) -> Column:
    """Total restricted to some labels; null when none of them occurs."""
    return F.sum(F.when(F.col(label).isin(*chosen), F.col(count)))


def weighted_mean(mean: str, count: str) -> Column:
    """Mean of group means by group size. A group without mean adds nothing above but counts below."""
    # twelve digits behind the point and as many before it, times counts of up to fourteen digits
    part = (exact(mean).cast("decimal(24,12)") * F.col(count).cast("decimal(13,0)")).cast("decimal(38,12)")
    above = F.sum(F.coalesce(part, F.lit(0).cast("decimal(38,12)")))
    return F.try_divide(above.cast("double"), F.sum(count).cast("double"))


def safe_share(part: Column, whole: Column) -> Column:
    return F.try_divide(part.cast("double"), whole.cast("double"))


def peak_day(fact: DataFrame, day: str, count: str) -> DataFrame:
    """Latest day among those with the largest total."""
    daily = fact.groupBy(day).agg(F.sum(count).alias("peak_total"))
    best = F.max_by(F.struct(F.col(day).alias("peak_day"), "peak_total"), F.struct(F.col("peak_total"), F.col(day)))
    return daily.agg(best.alias("b")).select("b.peak_day", "b.peak_total")
