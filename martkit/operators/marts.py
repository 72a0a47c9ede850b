"""Roll-ups: every mart is one partial-then-final aggregation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martkit.functions.bands import Bands
from martkit.functions.numbers import fixed_sum, round_half_up


def n_rows() -> Column:
    return F.count(F.lit(1))


def count_by(df: DataFrame, keys: Sequence[str | Column] | str, name: str = "n") -> DataFrame:
    keys = [keys] if isinstance(keys, str) else list(keys)
    return df.groupBy(*keys).agg(n_rows().alias(name))


def rollup_by(df: DataFrame, keys: Sequence[str | Column], measures: Mapping[str, Column]) -> DataFrame:
    return df.groupBy(*keys).agg(*[m.alias(n) for n, m in measures.items()])


def summarise(df: DataFrame, measures: Mapping[str, Column], refreshed: bool = True) -> DataFrame:
    """One row; ``refreshed_at`` tells when it was computed."""
    out = df.agg(*[m.alias(n) for n, m in measures.items()])
    return out.withColumn("refreshed_at", F.current_timestamp()) if refreshed else out


def count_bands(df: DataFrame, label: str, bands: Bands, name: str = "n") -> DataFrame:
    """Rows per band with the band's position; bands without rows are absent."""
    return count_by(df, label, name).withColumn("sort_order", bands.order(label))


def duplicate_keys(df: DataFrame, keys: Sequence[str | Column]) -> DataFrame:
    """Keys found more than once, with their count."""
    return count_by(df, keys, "n").where("n > 1")


def with_share(df: DataFrame, value: str, digits: int, name: str = "share_pct", total: Column | None = None) -> DataFrame:
    """Percentage of the grand total, which is a scalar subquery: no join and no one-task window."""
    if total is None:
        total = df.agg(fixed_sum(value).alias("total")).scalar()
    share = F.try_divide(F.col(value).cast("double") * 100, total.cast("double"))
    return df.withColumn(name, round_half_up(share, digits))


def extremes(df: DataFrame, entity: str, value: str) -> DataFrame:
    """Entities with the largest and smallest value; equal values take the first entity in order."""
    top = F.min_by(F.struct(entity, value), F.struct(-F.col(value), F.col(entity)))
    low = F.min_by(F.struct(entity, value), F.struct(F.col(value), F.col(entity)))
    known = df.where(F.col(value).isNotNull())
    return known.agg(top.alias("t"), low.alias("l")).select(
        F.col(f"t.{entity}").alias("top_entity"), F.col(f"t.{value}").alias("top_value"),
        F.col(f"l.{entity}").alias("low_entity"), F.col(f"l.{value}").alias("low_value"),
    )
