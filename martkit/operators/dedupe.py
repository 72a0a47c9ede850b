"""Keeping one row per key.

``row_number() == 1`` lets Spark prune each map task to one row per key before the shuffle
(WindowGroupLimit), so a key that holds a third of all rows sends one row per task, not its whole group.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _first_by(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def _ties(df: DataFrame, used: Sequence[str]) -> list[Column]:
    """Remaining columns, so that equal order values still give one certain winner."""
    plain = [f.name for f in df.schema.fields if f.dataType.typeName() not in ("map", "variant")]
    return [F.col(f"`{c}`").asc_nulls_last() for c in plain if c not in used]


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """First row per key by ``order``; ties are settled by the other columns."""
    return _first_by(df, keys, [*[F.col(c).asc() for c in order], *_ties(df, [*keys, *order])])


def keep_last(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    return _first_by(df, keys, [*[F.col(c).desc() for c in order], *_ties(df, [*keys, *order])])


def merge_by_precedence(
    sources: Sequence[DataFrame], keys: Sequence[str], order: Sequence[str] = ()
) -> DataFrame:
    """Union of the sources, later sources overriding earlier ones for the same key."""
    tagged = [s.withColumn("_priority", F.lit(i)) for i, s in enumerate(sources)]
    merged = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)
    return keep_last(merged, keys, ["_priority", *order]).drop("_priority")


def canonical_labels(df: DataFrame, label: str) -> DataFrame:
    """Most frequent spelling per case-folded label; equal counts take the first in binary order.

    Two partial aggregations: rows are counted per spelling before anything is compared.
    """
    counts = df.groupBy(F.col(label).alias("spelling")).agg(F.count(F.lit(1)).alias("n"))
    return counts.groupBy(F.lower("spelling").alias(f"{label}_key")).agg(
        F.min_by("spelling", F.struct(-F.col("n"), F.col("spelling"))).alias(f"{label}_label")
    )


def apply_canonical(df: DataFrame, label: str) -> DataFrame:
    """Overwrite ``label`` with its most frequent spelling, as ``canonical_labels`` picks it.

    The join only carries spellings that change. No broadcast hint: the lookup grows with the number of
    labels, and the planner broadcasts it when its measured size allows, else joins by shuffle with skew
    splitting. A window group holds the spellings of one label.
    """
    counts = df.groupBy(F.col(label).alias("_spelling")).agg(F.count(F.lit(1)).alias("n"))
    best = Window.partitionBy(F.lower("_spelling")).orderBy(F.desc("n"), F.asc("_spelling"))
    changed = (
        counts.select("_spelling", F.first("_spelling").over(best).alias("_canonical"))
        .where(F.col("_spelling") != F.col("_canonical"))
    )
    return (
        df.join(changed, F.col(label) == F.col("_spelling"), "left")
        .withColumn(label, F.coalesce("_canonical", label))
        .drop("_spelling", "_canonical")
    )
