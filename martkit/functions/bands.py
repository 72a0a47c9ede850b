"""Ordered bands: value -> label, label -> position, and the dimension table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martkit.functions.text import _col


@dataclass(frozen=True)
class Bands:
    """``labels[i]`` holds values below ``edges[i]``; the last label holds the rest.

    Every edge belongs to the band above it. Nulls get ``null_label``, ordered last.
    """

    edges: tuple[float, ...]
    labels: tuple[str, ...]
    null_label: str | None = None

    def __post_init__(self):
        if len(self.labels) != len(self.edges) + 1:
            raise ValueError("bands need one label more than edges")

    def label(self, c: Column | str) -> Column:
        value = _col(c)
        out = F.when(value.isNull(), F.lit(self.null_label))
        for edge, name in zip(self.edges, self.labels):
            out = out.when(value < edge, name)
        return out.otherwise(self.labels[-1])

    def order(self, label: Column | str) -> Column:
        """1-based position of a label; unknown labels come last."""
        out = None
        for i, name in enumerate(self.labels, 1):
            hit = _col(label) == name
            out = F.when(hit, i) if out is None else out.when(hit, i)
        return out.otherwise(len(self.labels) + 1)

    def table(self, spark: SparkSession, label: str = "label", order: str = "sort_order") -> DataFrame:
        names = [*self.labels, *([self.null_label] if self.null_label else [])]
        return spark.createDataFrame(
            [(n, i) for i, n in enumerate(names, 1)], f"{label} string, {order} int"
        )
