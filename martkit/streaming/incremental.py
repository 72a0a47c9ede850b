"""Which windows still have to be loaded, loading one or many, and the micro-batch form."""

from __future__ import annotations

from collections.abc import Callable
from datetime import UTC, date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from martkit.functions.dates import wall_time
from martkit.operators.quality import require_rows
from martkit.sinks import snapshots
from martkit.sinks.writers import Staging, _exists, append_log, insert_if_absent, upsert
from martkit.sources.feed import FEED_SCHEMA, is_loadable, parse_events

EVENT_KEYS = ("event_id",)


def month_windows(spark: SparkSession, start: date, until: date) -> DataFrame:
    """(window_start, window_end) of every full month from ``start`` to ``until``."""
    months = max(0, (until.year - start.year) * 12 + until.month - start.month)
    first = F.trunc(F.lit(start).cast("date"), "MM")
    starts = spark.range(months).select(F.add_months(first, F.col("id").cast("int")).alias("window_start"))
    return starts.withColumn("window_end", F.add_months("window_start", 1))


def pending_windows(windows: DataFrame, load_log: DataFrame, column: str = "window_start") -> DataFrame:
    """Windows the load log does not hold yet."""
    return windows.join(load_log.select(column), column, "left_anti")


def load_window(feed: DataFrame, path: str, start: datetime, end: datetime) -> dict[str, int]:
    """One feed window into the event table, a snapshot table: parse, reject, first occurrence per id, replace the window.

    The pages are parsed once, into the scratch area, and written once, into the table; attempted, rejected, distinct and stored rows are
    reported separately.
    """
    with Staging(feed.sparkSession, "feed") as stage:
        events = stage(parse_events(feed))
        order = [c for c in ("feed_order",) if c in events.columns]
        counts = events.agg(F.count_if(is_loadable()).alias("good"), F.count_if(~is_loadable()).alias("bad")).first()
        good = _dealt(events.where(is_loadable()), counts.good).withColumn("ingested_at", wall_time(datetime.now(UTC)))
        result = snapshots.replace_window(good, path, "occurred_at", start, end, list(EVENT_KEYS), order, counts.good)
    return result | {"attempted": counts.good, "rejected": counts.bad}


def _dealt(staged: DataFrame, rows: int) -> DataFrame:
    """Staged rows, about ``snapshots.ROWS`` to a task, which sorts them to drop repeated ids before the shuffle: a split of a
    file is bounded in compressed bytes only. A row goes by its place in the files, so rows of one id are spread, too."""
    if rows <= snapshots.ROWS:
        return staged
    return staged.withColumn("_place", F.monotonically_increasing_id()).repartition(-(-rows // snapshots.ROWS), "_place").drop("_place")


LOAD_LOG = "window_start date, window_end date, stored bigint, loaded_at timestamp_ntz"


def backfill(
    spark: SparkSession, fetch: Callable[[datetime, datetime], DataFrame], path: str, log_path: str, start: date, until: date
) -> DataFrame:
    """Load every full month from ``start`` to ``until`` that the load log lacks, and log it.

    Neighbouring months are fetched, parsed, deduplicated and written together: the number of jobs follows the number of
    gaps in the log, not that of months. A month is logged after it has been stored; a load that died is done again.
    """
    log = spark.read.schema(LOAD_LOG).parquet(log_path) if _exists(spark, log_path) else spark.createDataFrame([], LOAD_LOG)
    pending = [r.window_start for r in pending_windows(month_windows(spark, start, until), log).orderBy("window_start").collect()]
    spans: list[list[date]] = []
    for month in pending:
        if spans and spans[-1][1] == month:
            spans[-1][1] = _next_month(month)
        else:
            spans.append([month, _next_month(month)])
    for first, end in spans:
        lo, hi = datetime(first.year, first.month, 1), datetime(end.year, end.month, 1)
        load_window(fetch(lo, hi), path, lo, hi)
        at = F.col("occurred_at")
        stored = snapshots.read(spark, path).where((at >= wall_time(lo)) & (at < wall_time(hi)))
        counts = stored.groupBy(F.trunc("occurred_at", "MM").alias("window_start")).agg(F.count(F.lit(1)).alias("stored"))
        months = month_windows(spark, first, end).join(counts, "window_start", "left")
        months.select(
            "window_start", "window_end", F.coalesce("stored", F.lit(0)).cast("bigint").alias("stored"), wall_time(datetime.now(UTC)).alias("loaded_at")
        ).write.mode("append").parquet(log_path)
    return spark.read.schema(LOAD_LOG).parquet(log_path) if spans or _exists(spark, log_path) else log


def _next_month(month: date) -> date:
    return date(month.year + month.month // 12, month.month % 12 + 1, 1)


def ingest_totals(events: DataFrame) -> DataFrame:
    return events.agg(
        F.count(F.lit(1)).alias("total"), F.min("occurred_at").alias("first_event"), F.max("occurred_at").alias("last_event")
    )


def stream_feed(spark: SparkSession, landing: str, path: str, checkpoint: str, counts: str | None = None) -> StreamingQuery:
    """Load newly landed pages as micro-batches, then stop: each event id is stored once, first writer wins.

    The sink is a snapshot table: a batch is seen as a whole, and one repeated after a failure finds its ids in the table and
    adds nothing. ``counts``: a log that gets a row for each batch with its good and bad lines.
    """
    pages = spark.readStream.schema(FEED_SCHEMA).option("header", "true").option("enforceSchema", "false").csv(landing)

    def store(batch: DataFrame, number: int) -> None:
        events = parse_events(batch)
        snapshots.insert_if_absent(events.where(is_loadable()), path, list(EVENT_KEYS), ["occurred_at"], at="occurred_at")
        if counts:
            tally = events.agg(F.count_if(is_loadable()).alias("attempted"), F.count_if(~is_loadable()).alias("rejected"))
            append_log(tally.withColumn("batch", F.lit(number).cast("bigint")), counts)

    return (
        pages.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def bootstrap_or_update(
    stored: DataFrame | None, history: DataFrame, latest: DataFrame, path: str, rows: int, at: str, keys: list[str]
) -> str:
    """Fill a short history once without touching known rows, then only upsert the newest value."""
    have = 0 if stored is None else stored.count()
    if have < rows:
        require_rows(history, rows, "bootstrap history")
        insert_if_absent(history, path, keys, at=at)
    upsert(latest, path, keys, at)
    return "updated" if have >= rows else "bootstrapped"
