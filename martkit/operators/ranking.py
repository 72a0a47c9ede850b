"""Top-k reads, ranks over whole marts, and latest rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martkit.session import shared_root

# monotonically_increasing_id keeps the partition above this bit and the row position below it
_POSITION_BITS = 33


def top_n(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    """The feature itself is the limit: each task keeps ``n`` rows (TakeOrderedAndProject)."""
    return df.orderBy(*order).limit(n)


def number_top(df: DataFrame, order: Sequence[Column], n: int, name: str = "rank") -> DataFrame:
    """Top ``n`` rows with their rank; the window only ever sees those ``n`` rows."""
    return top_n(df, order, n).withColumn(name, F.row_number().over(Window.orderBy(*order)))


def rank_all(df: DataFrame, order: Sequence[Column], name: str = "rank") -> DataFrame:
    """Rank every row of a mart of any size, without a one-task window.

    The rows are range-sorted across tasks and frozen with a checkpoint, because a second run of a range
    sort may cut its partitions elsewhere. A row's rank is its position inside its partition plus the rows
    of the partitions before it; that running total has one row per partition. ``order`` should be total.
    """
    shared_root(df.sparkSession)
    frozen = df.orderBy(*order).withColumn("_at", F.monotonically_increasing_id()).checkpoint()
    part = F.shiftright("_at", _POSITION_BITS)
    before = F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = (
        frozen.groupBy(part.alias("_part"))
        .agg(F.count(F.lit(1)).alias("_n"))
        .select("_part", F.coalesce(before, F.lit(0)).alias("_before"))
    )
    position = F.col("_at").bitwiseAND((1 << _POSITION_BITS) - 1) + 1
    # one offset per partition of the sort: bounded by the shuffle partition count
    return (
        frozen.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .withColumn(name, position + F.col("_before"))
        .drop("_part", "_before", "_at")
    )


def latest_row(df: DataFrame, order: str, columns: Sequence[str]) -> DataFrame:
    """The row with the largest ``order``, as one aggregation."""
    best = F.max_by(F.struct(*columns), F.struct(order, *[c for c in columns if c != order]))
    return df.agg(best.alias("best")).select("best.*")


def latest_where(df: DataFrame, condition: Column, value: str, order: str) -> Column:
    """Scalar: ``value`` of the newest row that meets ``condition``, null when there is none; the least of equally new ones."""
    newest = F.min_by(value, F.struct(-F.unix_micros(F.col(order).cast("timestamp")), F.col(value)))
    return df.where(condition).agg(newest.alias(value)).scalar()


def with_leaders(
    summary: DataFrame, leaders: Sequence[tuple[DataFrame, Sequence[Column], dict[str, str]]]
) -> DataFrame:
    """Add to a one-row summary values of the first row of other marts.

    Each leader is (mart, order, new column -> mart column): one top-1 scalar subquery per mart.
    """
    out = summary
    for i, (mart, order, columns) in enumerate(leaders):
        first = top_n(mart, order, 1).select(F.struct(*[F.col(c).alias(n) for n, c in columns.items()]).alias("first"))
        out = out.withColumn(f"_{i}", first.scalar())
    values = [F.col(f"_{i}.{n}") for i, (_, _, columns) in enumerate(leaders) for n in columns]
    return out.select(*summary.columns, *values)
