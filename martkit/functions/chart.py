"""Values a chart needs next to the data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martkit.functions.text import _col


def map_position(lon: Column | str, lat: Column | str, width: int = 1060, height: int = 540) -> dict[str, Column]:
    """Plate carree position on a canvas with the origin top left."""
    return {
        "x": F.round((_col(lon) + 180) / 360 * width, 1),
        "y": F.round((F.lit(90) - _col(lat)) / 180 * height, 1),
    }


def marker_radius(magnitude: Column | str, base: float = 1.6, floor: float = 6.0, step: float = 1.5) -> Column:
    return F.round(F.lit(base) + (_col(magnitude) - floor) * step, 1)


def axis_ticks(df: DataFrame, value: str, fractions=(0.0, 0.25, 0.5, 0.75, 1.0)) -> DataFrame:
    """Tick marks at fractions of the largest value, rounded half up: one row per fraction."""
    top = df.agg(F.max(value).cast("double").alias("top"))
    parts = F.explode(F.array(*[F.lit(float(f)) for f in fractions]))
    return top.select("top", parts.alias("fraction")).select(
        "fraction", F.floor(F.col("top") * F.col("fraction") + 0.5).cast("bigint").alias("tick")
    )


def bar_fraction(df: DataFrame, value: str, name: str = "fraction") -> DataFrame:
    """Each value relative to the largest one."""
    top = df.agg(F.max(value).alias("top")).scalar()
    return df.withColumn(name, F.col(value).cast("double") / top)
