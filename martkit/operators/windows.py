"""Ordered analytics over daily and monthly series.

All operators here take marts with one row per (series, period): the raw rows are aggregated first, with
map-side combining, so a window group holds at most one row per calendar day however skewed the raw rows
are. ``series=()`` means the whole mart is one series, again at most one row per calendar day.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martkit.functions.dates import month_start
from martkit.functions.numbers import exact, half_up
from martkit.functions.text import _col
from martkit.session import shared_root


def period_series(
    df: DataFrame, period: Column, series: Sequence[str] = (), measures: dict[str, Column] | None = None,
    name: str = "day",
) -> DataFrame:
    """Aggregate rows to one per (series, period)."""
    measures = measures or {"n": F.count(F.lit(1))}
    return df.groupBy(*series, period.alias(name)).agg(*[m.alias(n) for n, m in measures.items()])


def daily_series(df: DataFrame, at: str, series: Sequence[str] = (), **kw) -> DataFrame:
    return period_series(df, _col(at).cast("date"), series, **kw)


def monthly_series(df: DataFrame, at: str, series: Sequence[str] = (), **kw) -> DataFrame:
    return period_series(df, month_start(at), series, name="month", **kw)


def _window(series: Sequence[str], order: str):
    return Window.partitionBy(*series).orderBy(order)


def _trailing_days(series: Sequence[str], day: str, days: int):
    return Window.partitionBy(*series).orderBy(F.unix_date(day)).rangeBetween(-(days - 1), 0)


def moving_average_rows(
    df: DataFrame, value: str, order: str = "day", series: Sequence[str] = (), rows: int = 7, digits: int = 1,
    name: str = "moving_avg",
) -> DataFrame:
    """Mean over the last ``rows`` rows. Missing days are not filled; early rows average fewer values."""
    w = _window(series, order).rowsBetween(-(rows - 1), 0)
    return df.withColumn(name, half_up(F.sum(exact(value)).over(w), F.count(exact(value)).over(w), digits))


def calendar_average(
    df: DataFrame, spine: DataFrame, value: str, day: str = "day", days: int = 7, name: str = "calendar_avg"
) -> DataFrame:
    """For every spine day, the total of the last ``days`` calendar days divided by ``days``.

    Days without data count as zero. The spine may end in a slice of the calendar: the totals look back
    past the slice because they are taken before it is cut.
    """
    filled = spine.select(day).join(df.select(day, value), day, "left")
    total = F.coalesce(F.sum(value).over(_trailing_days((), day, days)), F.lit(0))
    return filled.select(day, (total.cast("double") / days).alias(name))


def present_average(
    df: DataFrame, value: str, day: str = "day", series: Sequence[str] = (), days: int = 7, digits: int = 6,
    name: str = "present_avg",
) -> DataFrame:
    """Mean over those of the last ``days`` calendar days that have data."""
    w = _trailing_days(series, day, days)
    return df.withColumn(name, half_up(F.sum(exact(value)).over(w), F.count(exact(value)).over(w), digits))


def lag_features(
    df: DataFrame, value: str, order: str = "day", series: Sequence[str] = (), lags: int = 5
) -> DataFrame:
    """Previous ``lags`` values by position, and their mean; rows without enough predecessors are dropped."""
    w = _window(series, order)
    out = df.select("*", *[F.lag(value, k).over(w).alias(f"lag_{k}") for k in range(1, lags + 1)])
    out = out.where(F.col(f"lag_{lags}").isNotNull())
    return out.withColumn("lag_mean", sum(F.col(f"lag_{k}") for k in range(1, lags + 1)) / lags)


def _last_rows(df: DataFrame, order: str, series: Sequence[str], rows: int) -> DataFrame:
    """Last ``rows`` rows per series, numbered from the newest; each map task keeps only ``rows`` rows."""
    w = Window.partitionBy(*series).orderBy(F.col(order).desc())
    return df.withColumn("_back", F.row_number().over(w)).where(F.col("_back") <= rows)


def latest_features(
    df: DataFrame, value: str, order: str = "day", series: Sequence[str] = (), lags: int = 5
) -> DataFrame:
    """The newest ``lags`` values of each series as one feature row, for scoring the next period."""
    last = _last_rows(df, order, series, lags)
    picks = [F.max(F.when(F.col("_back") == k, F.col(value))).alias(f"lag_{k}") for k in range(1, lags + 1)]
    wide = last.groupBy(*series).agg(F.max(order).alias(f"latest_{order}"), F.count(F.lit(1)).alias("_n"), *picks)
    mean = sum(F.col(f"lag_{k}") for k in range(1, lags + 1)) / lags
    return wide.where(F.col("_n") == lags).drop("_n").withColumn("lag_mean", mean)


def ordered_holdout(
    df: DataFrame, order: str = "day", series: Sequence[str] = (), rows: int = 5, name: str = "is_holdout"
) -> DataFrame:
    """Flag the last ``rows`` rows of each series as holdout."""
    w = Window.partitionBy(*series).orderBy(F.col(order).desc())
    return df.withColumn(name, F.row_number().over(w) <= rows)


def year_markers(df: DataFrame, day: str = "day", series: Sequence[str] = (), every: int = 1) -> DataFrame:
    """First period of each year with its 0-based position; ``every=2`` keeps every second marker."""
    w = _window(series, day)
    placed = df.select(
        *series, day, F.year(day).alias("year_ce"),
        (F.row_number().over(w) - 1).alias("position"),
        F.lag(F.year(day)).over(w).alias("_previous"),
    )
    marks = placed.where(~F.col("year_ce").eqNullSafe(F.col("_previous"))).drop("_previous")
    marks = marks.withColumn("year_be", F.col("year_ce") + 543)
    if every > 1:
        nth = F.row_number().over(_window(series, day)) - 1
        marks = marks.withColumn("_nth", nth).where(F.col("_nth") % every == 0).drop("_nth")
    return marks


def peaks(
    df: DataFrame, value: str, order: str = "day", series: Sequence[str] = (), count: int = 3, apart: int = 45
) -> DataFrame:
    """The ``count`` largest values whose positions differ by more than ``apart`` rows.

    Picking greedily by value is the same as taking the largest remaining row ``count`` times, each time
    leaving out rows near earlier picks. Nothing is collected per series. The numbered series is read once
    per pick, so it is frozen with a checkpoint first. Equal values take the earlier position.
    """
    shared_root(df.sparkSession)
    keys = list(series) or ["_all"]
    placed = df if series else df.withColumn("_all", F.lit(0))
    w = Window.partitionBy(*keys).orderBy(order)
    placed = placed.select(*keys, order, value, (F.row_number().over(w) - 1).alias("position")).checkpoint()
    best = F.max_by(F.struct(order, value, "position"), F.struct(F.col(value), -F.col("position")))
    remaining, picks = placed, None
    for _ in range(count):
        pick = remaining.groupBy(*keys).agg(best.alias("p")).select(*keys, "p.*")
        picks = pick if picks is None else picks.unionByName(pick)
        near = pick.select(*[F.col(k).alias(f"_{k}") for k in keys], F.col("position").alias("_pick"))
        same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])  # a null series is a series
        remaining = remaining.join(near, same).where(F.abs(F.col("position") - F.col("_pick")) > apart).select(*placed.columns)
    return picks if series else picks.drop("_all")
