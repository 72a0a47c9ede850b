"""Price pages -> history -> lag features -> regression -> champion choice -> next-day forecast."""

from __future__ import annotations

from datetime import datetime

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martkit import labels
from martkit.operators.dedupe import keep_last, merge_by_precedence
from martkit.operators.forecast import check_history, log_run, promote, score, train_and_select
from martkit.operators.ranking import latest_row
from martkit.operators.windows import lag_features, latest_features, ordered_holdout
from martkit.sinks.writers import _exists
from martkit.sources.html import extract_price, extract_prices
from martkit.streaming.incremental import bootstrap_or_update

METRICS = "model_name string, rmse double, deployed boolean, run_at timestamp"


def current_prices(pages: DataFrame) -> DataFrame:
    """Prices of the current-price pages; the later record on a page wins its date."""
    return keep_last(extract_prices(pages), ["date"], ["table_no", "row_no"]).select("date", "price")


def archived_prices(pages: DataFrame, date: str = "date", html: str = "html") -> DataFrame:
    """One price per archived day page."""
    found = pages.select(F.col(date).alias("date"), extract_price(html).alias("price"))
    return found.where("price is not null")


def price_history(current: DataFrame, archive: DataFrame) -> DataFrame:
    """Archive first, the current source overriding the same date."""
    merged = merge_by_precedence([archive, current], ["date"])
    return merged.select("date", F.lit(labels.FUEL_SYMBOL).alias("symbol"), "price")


def store_prices(spark: SparkSession, current: DataFrame, archive: DataFrame, path: str) -> str:
    known = spark.read.parquet(path) if _exists(spark, path) else None
    stored = None if known is None else known.where(F.col("symbol") == labels.FUEL_SYMBOL)
    stamp = F.lit(datetime.now()).cast("timestamp")
    history = price_history(current, archive).withColumn("inserted_at", stamp)
    latest = latest_row(history.join(current.select("date"), "date", "left_semi"), "date",
                        ["date", "symbol", "price", "inserted_at"])
    return bootstrap_or_update(stored, history, latest, path, labels.MIN_HISTORY_ROWS, "date", ["date", "symbol"])


def train_prices(spark: SparkSession, history: DataFrame, model_path: str, log_path: str) -> tuple[float, bool]:
    """Train, evaluate, promote when better, log the run."""
    check_history(history)
    features = ordered_holdout(
        lag_features(history, "price", "date", lags=labels.LAG_COUNT), "date", rows=labels.HOLDOUT_ROWS
    )
    log = spark.read.parquet(log_path) if _exists(spark, log_path) else spark.createDataFrame([], METRICS)
    model, error, go = train_and_select(features, "price", "is_holdout", log, labels.FUEL_SYMBOL)
    if go:
        promote(model, model_path)
    log_run(spark, log_path, labels.FUEL_SYMBOL, error, go)
    return error, go


def forecast_next(history: DataFrame, model_path: str) -> DataFrame:
    """Next-day forecast of the stored model from the newest prices."""
    return score(PipelineModel.load(model_path), latest_features(history, "price", "date", lags=labels.LAG_COUNT))
