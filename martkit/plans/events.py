"""Event table -> enriched events -> canonical regions -> summary tables -> gate -> star-schema export."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martkit import labels
from martkit.functions.dates import month_start
from martkit.functions.numbers import at_least, fixed_mean
from martkit.functions.text import aliased_segment
from martkit.operators.calendar import entity_dimension, month_dimension
from martkit.operators.dedupe import apply_canonical
from martkit.operators.marts import count_bands, rollup_by, summarise
from martkit.operators.quality import Gate, RowRule, off_globe, out_of_range
from martkit.operators.ranking import top_n
from martkit.sinks.export import export_bundle


def enrich_events(events: DataFrame, kind: str = "earthquake") -> DataFrame:
    """Cleaned magnitude, region from the place text, bands, date and month; other kinds are dropped."""
    magnitude = at_least("magnitude", labels.MAGNITUDE_FLOOR)
    return events.where(F.col("event_type") == kind).select(
        "event_id",
        "occurred_at",
        F.to_date("occurred_at").alias("occurred_on"),
        month_start("occurred_at").alias("occurred_month"),
        "latitude",
        "longitude",
        "depth_km",
        magnitude.alias("magnitude"),
        "mag_type",
        "place",
        aliased_segment("place", labels.REGION_CODES, labels.UNSPECIFIED).alias("region"),
        labels.MAGNITUDE_BANDS.label(magnitude).alias("magnitude_band"),
        labels.DEPTH_BANDS.label("depth_km").alias("depth_band"),
    )


def with_canonical_regions(enriched: DataFrame) -> DataFrame:
    return apply_canonical(enriched, "region")


def _magnitude_mean():
    return fixed_mean("magnitude", 2)


def _depth_mean():
    return fixed_mean("depth_km", 1)


def event_marts(enriched: DataFrame) -> dict[str, DataFrame]:
    events = F.count(F.lit(1))
    strong = enriched.where(
        (F.col("magnitude") >= labels.STRONG_MAGNITUDE) & F.col("latitude").isNotNull() & F.col("longitude").isNotNull()
    )
    return {
        "monthly": rollup_by(enriched, [F.col("occurred_month").alias("month")], {
            "events": events,
            "avg_magnitude": _magnitude_mean(),
            "max_magnitude": F.max("magnitude"),
            "avg_depth_km": _depth_mean(),
            "events_m5_plus": F.count_if(F.col("magnitude") >= 5),
        }),
        "by_magnitude": count_bands(enriched, "magnitude_band", labels.MAGNITUDE_BANDS, "events"),
        "by_region": rollup_by(enriched, ["region"], {
            "events": events, "max_magnitude": F.max("magnitude"), "avg_depth_km": _depth_mean(),
        }),
        "by_depth": count_bands(enriched, "depth_band", labels.DEPTH_BANDS, "events"),
        "strongest": top_n(
            enriched.where(F.col("magnitude").isNotNull()),
            [F.col("magnitude").desc(), F.col("occurred_at").desc(), F.col("event_id")], 20,
        ).select("event_id", "occurred_at", "magnitude", "depth_km", "place", "region", "latitude", "longitude"),
        "map_points": strong.select(
            "event_id", "occurred_at", "latitude", "longitude", "magnitude", "depth_km", "place"
        ),
        "summary": summarise(enriched, {
            "total_events": events,
            "first_event": F.min("occurred_at"),
            "last_event": F.max("occurred_at"),
            "max_magnitude": F.max("magnitude"),
            "avg_magnitude": _magnitude_mean(),
            "avg_depth_km": _depth_mean(),
            "region_count": F.count_distinct("region"),
            "events_m6_plus": F.count_if(F.col("magnitude") >= 6),
        }),
    }


def event_gate(enriched: DataFrame, marts: dict[str, DataFrame]) -> Gate:
    return (
        Gate()
        .rows(
            enriched,
            [
                RowRule("coordinates off the globe", off_globe("latitude", "longitude")),
                RowRule("magnitude out of range", out_of_range("magnitude", labels.MAGNITUDE_FLOOR, 10)),
            ],
            not_empty="events empty",
        )
        .unique(enriched, ["event_id"], "event_id repeated")
        .unique(marts["by_region"], ["region"], "regions differ only in case", fold_case=True)
        .not_empty(marts["monthly"], "monthly summary empty")
        .no_missing_months(marts["monthly"], "months missing")
    )


def event_fact(enriched: DataFrame) -> DataFrame:
    return rollup_by(enriched, ["occurred_month", "region", "magnitude_band", "depth_band"], {
        "events": F.count(F.lit(1)),
        "avg_magnitude": _magnitude_mean(),
        "max_magnitude": F.max("magnitude"),
        "avg_depth_km": _depth_mean(),
    })


def event_star(enriched: DataFrame, marts: dict[str, DataFrame]) -> dict[str, tuple[DataFrame, Sequence]]:
    monthly = marts["monthly"].select("month", "events", "avg_magnitude", "max_magnitude", "events_m5_plus")
    strongest = marts["strongest"].select(
        "occurred_at", "magnitude", "depth_km", "place", "region", "latitude", "longitude"
    )
    bands = ("magnitude", "depth")
    return {
        "fact_events": (event_fact(enriched), ["occurred_month", "region"]),
        "dim_month": (month_dimension(enriched, "occurred_month"), ["month"]),
        "dim_region": (entity_dimension(marts["by_region"], "region", "events"), ["rank"]),
        **{
            f"dim_{b}_band": (marts[f"by_{b}"].select(f"{b}_band", "sort_order", "events"), ["sort_order"])
            for b in bands
        },
        "summary_monthly": (monthly, ["month"]),
        "strongest_events": (strongest, [F.col("magnitude").desc(), F.col("occurred_at").desc()]),
    }


def run_report(marts: dict[str, DataFrame]) -> DataFrame:
    """One row: events and their span, the region with most of them (of equal ones the first), the strongest event."""
    top = F.min_by(F.struct("region", "events"), F.struct(-F.col("events"), F.col("region")))
    first = F.struct(-F.col("magnitude"), -F.unix_micros(F.col("occurred_at").cast("timestamp")), F.col("event_id"))
    strongest = F.min_by(F.struct("event_id", "magnitude", "place"), first)
    one = marts["summary"].select(
        F.col("total_events").alias("events"), "first_event", "last_event",
        marts["by_region"].agg(top.alias("r")).scalar().alias("r"), marts["strongest"].agg(strongest.alias("s")).scalar().alias("s"),
    )
    return one.select(
        "events", "first_event", "last_event", F.col("r.region").alias("top_region"), F.col("r.events").alias("top_region_events"),
        F.col("s.event_id").alias("strongest_event"), F.col("s.magnitude").alias("strongest_magnitude"), F.col("s.place").alias("strongest_place"),
    )


def build_events(spark: SparkSession, events: DataFrame, out: str) -> DataFrame:
    """The whole flow: enriched events are written once, canonical regions once, every mart reads those."""
    enrich_events(events).write.mode("overwrite").parquet(f"{out}/enriched_raw")
    raw = spark.read.parquet(f"{out}/enriched_raw")
    with_canonical_regions(raw).write.mode("overwrite").parquet(f"{out}/enriched")
    enriched = spark.read.parquet(f"{out}/enriched")
    marts = {}
    for name, mart in event_marts(enriched).items():
        mart.write.mode("overwrite").parquet(f"{out}/{name}")
        marts[name] = spark.read.parquet(f"{out}/{name}")
    run_report(marts).write.mode("overwrite").parquet(f"{out}/run_report")
    event_gate(enriched, marts).enforce()
    return export_bundle(event_star(enriched, marts), f"{out}/export")
