"""Distinct counts that can be stored by period and merged: a new month does not count the history anew.

The values of a group are bits in bitmaps of a fixed size, one for each range of values, so that a group of any number of
values is many small rows. Bitmaps of several periods are merged by their bits; counts are those of the bits.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def distinct_bitmaps(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """``keys, bucket, bits`` of a whole-number column; nulls are no value."""
    known = df.where(F.col(value).isNotNull()).select(*keys, F.col(value).cast("bigint").alias("v"))
    placed = known.select(*keys, F.bitmap_bucket_number("v").alias("bucket"), F.bitmap_bit_position("v").alias("at"))
    return placed.groupBy(*keys, "bucket").agg(F.bitmap_construct_agg("at").alias("bits"))


def merge_bitmaps(bitmaps: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The bitmaps of coarser groups."""
    return bitmaps.groupBy(*keys, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def count_bitmaps(bitmaps: DataFrame, keys: Sequence[str], name: str = "n") -> DataFrame:
    """Distinct values of each group, merged first."""
    return merge_bitmaps(bitmaps, keys).groupBy(*keys).agg(F.sum(F.bitmap_count("bits")).alias(name))
