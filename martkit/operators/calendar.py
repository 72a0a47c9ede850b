"""Calendar spines, dimensions and gap checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martkit import labels
from martkit.functions.bands import Bands
from martkit.functions.dates import month_attributes, month_start, weekday_attributes
from martkit.functions.text import _col
from martkit.operators.ranking import rank_all


def day_spine(df: DataFrame, at: str, name: str = "day") -> DataFrame:
    """Every day between the first and last date; no rows for an empty table."""
    d = _col(at).cast("date")
    bounds = df.agg(F.min(d).alias("lo"), F.max(d).alias("hi"))
    return bounds.select(F.explode(F.expr("sequence(lo, hi, interval 1 day)")).alias(name))


def month_spine(df: DataFrame, at: str, name: str = "month") -> DataFrame:
    m = month_start(at)
    bounds = df.agg(F.min(m).alias("lo"), F.max(m).alias("hi"))
    return bounds.select(F.explode(F.expr("sequence(lo, hi, interval 1 month)")).alias(name))


def calendar_dimension(
    df: DataFrame, at: str, month_names: Sequence[str] = labels.MONTHS_SHORT,
    weekday_names: Sequence[str] = labels.WEEKDAYS,
) -> DataFrame:
    attributes = month_attributes("day", month_names) | weekday_attributes("day", weekday_names)
    return day_spine(df, at).select("day", *[c.alias(n) for n, c in attributes.items()])


def month_dimension(df: DataFrame, at: str, month_names: Sequence[str] = labels.MONTHS_SHORT) -> DataFrame:
    attributes = month_attributes("month", month_names)
    return month_spine(df, at).select("month", *[c.alias(n) for n, c in attributes.items()])


def missing_months(series: DataFrame, month: str = "month") -> DataFrame:
    """Months between the first and last one of the series that it does not hold."""
    return month_spine(series, month, "month").join(series.select(_col(month).alias("month")), "month", "left_anti")


def missing_days(series: DataFrame, day: str = "day") -> DataFrame:
    return day_spine(series, day, "day").join(series.select(_col(day).alias("day")), "day", "left_anti")


def entity_dimension(mart: DataFrame, entity: str, measure: str, rank: str = "rank") -> DataFrame:
    """Mart rows with their rank by the measure, largest first, label order settling ties."""
    return rank_all(mart, [F.col(measure).desc(), F.col(entity).asc()], rank)


def band_dimension(mart: DataFrame, label: str, bands: Bands) -> DataFrame:
    return mart.withColumn("sort_order", bands.order(label))
