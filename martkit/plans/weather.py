"""Weather readings -> category -> append -> read-back check."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martkit import labels
from martkit.operators.quality import require_rows
from martkit.operators.ranking import top_n
from martkit.sinks.writers import append_log
from martkit.sources.feed import parse_readings


def categorise(readings: DataFrame) -> DataFrame:
    return readings.withColumn("temperature_category", labels.TEMPERATURE_BANDS.label("temperature"))


def store_readings(raw: DataFrame, path: str) -> DataFrame:
    """Append the readings, then read the newest rows back."""
    append_log(categorise(parse_readings(raw, "value", "province")), path, "ingested_at")
    stored = raw.sparkSession.read.parquet(path)
    require_rows(stored, 1, "stored readings")
    return top_n(
        stored, [F.col("ingested_at").desc(), F.col("recorded_at").desc(), F.col("province")], 4
    )
