"""Event feed pages and nested readings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martkit import labels
from martkit.functions.casts import iso_utc_timestamp, lenient_double
from martkit.functions.text import strip, strip_or_null

FEED_COLUMNS = (
    "time", "latitude", "longitude", "depth", "mag", "magType", "place", "type", "net", "status", "id", "updated",
)
FEED_SCHEMA = ", ".join(f"`{c}` string" for c in FEED_COLUMNS)


def read_feed(spark: SparkSession, path: str) -> DataFrame:
    """Landed header-line pages, all text, with the position of each row in the feed.

    ``feed_order`` is (file, byte block, position in the block), so a re-read gives the same order.
    """
    pages = spark.read.schema(FEED_SCHEMA).option("header", "true").option("enforceSchema", "false").csv(path)
    place = F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )
    return pages.withColumn("feed_order", place)


def parse_events(feed: DataFrame) -> DataFrame:
    """Feed text to the typed event columns; bad numbers and times are null."""
    keep = [c for c in ("feed_order",) if c in feed.columns]
    return feed.select(
        F.nullif(strip("id"), F.lit("")).alias("event_id"),
        iso_utc_timestamp("time").alias("occurred_at"),
        lenient_double("latitude").alias("latitude"),
        lenient_double("longitude").alias("longitude"),
        lenient_double("depth").alias("depth_km"),
        lenient_double("mag").alias("magnitude"),
        strip_or_null("magType").alias("mag_type"),
        strip_or_null("place").alias("place"),
        strip_or_null("type").alias("event_type"),
        strip_or_null("net").alias("network"),
        strip_or_null("status").alias("status"),
        iso_utc_timestamp("updated").alias("updated_at"),
        *keep,
    )


def is_loadable(event_id: str = "event_id", at: str = "occurred_at") -> Column:
    """Rows without id or time are rejected."""
    return F.col(event_id).isNotNull() & F.col(at).isNotNull()


READING_SCHEMA = (
    "current_weather struct<temperature: double, windspeed: double, weathercode: int, time: string>"
)


def parse_readings(raw: DataFrame, body: str, entity: str) -> DataFrame:
    """Nested reading next to its place name; the field list prunes everything else in the document."""
    doc = F.from_json(F.col(body), READING_SCHEMA)
    return raw.select(F.col(entity).alias("province"), doc.alias("doc")).select(
        "province",
        "doc.current_weather.temperature",
        "doc.current_weather.windspeed",
        "doc.current_weather.weathercode",
        F.col("doc.current_weather.time").try_cast("timestamp_ntz").alias("recorded_at"),
    )


def province_table(spark: SparkSession) -> DataFrame:
    """The fixed list of places read."""
    return spark.createDataFrame(labels.PROVINCES, "province string, slug string, lat double, lon double")
