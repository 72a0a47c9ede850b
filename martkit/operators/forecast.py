"""Training, evaluation, champion/challenger choice and scoring on Spark ML."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martkit import labels
from martkit.functions.numbers import difference, round_half_up
from martkit.functions.text import _col
from martkit.operators.quality import QualityError, require_rows
from martkit.operators.ranking import latest_where
from martkit.operators.windows import lag_features, ordered_holdout
from martkit.sinks.writers import append_log

LAG_COLUMNS = tuple(f"lag_{k}" for k in range(1, labels.LAG_COUNT + 1))
FEATURES = (*LAG_COLUMNS, "lag_mean")


def check_history(history: DataFrame, rows: int = labels.MIN_HISTORY_ROWS) -> int:
    """Enough rows for lags and holdout, or an error."""
    return require_rows(history, max(rows, labels.LAG_COUNT + labels.HOLDOUT_ROWS + 1), "history")


def check_series(history: DataFrame, value: str, series: Sequence[str], order: str = "day") -> DataFrame:
    """The same checks for every series of a long table at once: its rows, whether they are enough for a history and for a
    holdout, and whether the features left for training are."""
    rows = history.groupBy(*series).agg(F.count(F.lit(1)).alias("days"))
    features = ordered_holdout(lag_features(history, value, order, series, labels.LAG_COUNT), order, series, labels.HOLDOUT_ROWS)
    train = features.groupBy(*[F.col(c).alias(f"_{c}") for c in series]).agg(F.count_if(~F.col("is_holdout")).alias("train"))
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in series])
    holdout = labels.LAG_COUNT + labels.HOLDOUT_ROWS + 1
    return rows.join(train, same, "left").select(
        *series, "days", (F.col("days") >= max(labels.MIN_HISTORY_ROWS, holdout)).alias("enough_history"), (F.col("days") >= holdout).alias("enough_for_holdout"),
        (F.coalesce("train", F.lit(0)) >= labels.MIN_TRAIN_ROWS).alias("enough_to_train"),
    )


def regressions_by_series(train: DataFrame, target: str, series: Sequence[str], inputs: Sequence[str] = LAG_COLUMNS) -> DataFrame:
    """Ordinary least squares for every series in one job: ``w0`` (intercept), ``w1`` and so on.

    The sums of the normal equations combine before the shuffle; each series is then one row, whose equations are solved by
    elimination, step by step, in column expressions. A series whose inputs depend on one another has null weights.
    """
    terms, size = [F.lit(1.0), *map(F.col, inputs)], len(inputs) + 1
    right = [*terms, F.col(target)]
    sums = [F.sum(terms[i] * right[j]).alias(f"m{i}_{j}") for i in range(size) for j in range(i, size + 1)]
    rows = train.groupBy(*series).agg(*sums)
    rows = rows.withColumns({f"m{i}_{j}": F.col(f"m{j}_{i}") for i in range(size) for j in range(i)})
    for k in range(size):
        scaled = {f"m{k}_{j}": F.try_divide(F.col(f"m{k}_{j}"), F.col(f"m{k}_{k}")) for j in range(k, size + 1)}
        rows = rows.withColumns(scaled)
        rows = rows.withColumns({f"m{i}_{j}": F.col(f"m{i}_{j}") - F.col(f"m{i}_{k}") * F.col(f"m{k}_{j}") for i in range(size) if i != k for j in range(k + 1, size + 1)})
    return rows.select(*series, *[F.col(f"m{i}_{size}").alias(f"w{i}") for i in range(size)])


def predict_by_series(rows: DataFrame, weights: DataFrame, series: Sequence[str], inputs: Sequence[str] = LAG_COLUMNS) -> DataFrame:
    """Rows with the ``prediction`` of their series' own weights."""
    names = [f"w{i}" for i in range(len(inputs) + 1)]
    own = weights.select(*[F.col(c).alias(f"_{c}") for c in series], *names)
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in series])
    value = F.col("w0")
    for k, c in enumerate(inputs, 1):
        value = value + F.col(f"w{k}") * F.col(c)
    return rows.join(own, same, "left").withColumn("prediction", value).drop(*names, *[f"_{c}" for c in series])


def train_regression(train: DataFrame, target: str, features: Sequence[str] = FEATURES) -> PipelineModel:
    """Ordinary least squares. The mean is an exact combination of the lags, so weights are not unique;
    predictions are."""
    assembler = VectorAssembler(inputCols=list(features), outputCol="features")
    model = LinearRegression(featuresCol="features", labelCol=target, predictionCol="prediction")
    return Pipeline(stages=[assembler, model]).fit(train)


def check_training(train: DataFrame, rows: int = labels.MIN_TRAIN_ROWS) -> int:
    return require_rows(train, rows, "training rows")


def rmse(predicted: DataFrame, target: str, prediction: str = "prediction") -> DataFrame:
    """Root of the mean squared error, one row."""
    error = F.col(prediction) - F.col(target)
    return predicted.agg(F.sqrt(F.avg(error * error)).alias("rmse"))


def champion_rmse(log: DataFrame, model_name: str) -> Column:
    """Scalar: error of the newest deployed model of that name, null when there is none."""
    return latest_where(log, (F.col("model_name") == model_name) & F.col("deployed"), "rmse", "run_at")


def is_promoted(candidate: Column | float, champion: Column) -> Column:
    """True without a champion or when the candidate's error is strictly lower."""
    error = candidate if isinstance(candidate, Column) else F.lit(candidate)
    return champion.isNull() | (error < champion)


def replay_promotions(log: DataFrame, model: str = "model_name", error: str = "rmse", at: str = "run_at") -> DataFrame:
    """Which runs of a metric log were promoted, had each met the champion of its time.

    A champion is only replaced by a strictly lower error, so a run is promoted when its error is below every
    earlier one. A log has one row per run and model.
    """
    earlier = Window.partitionBy(model).orderBy(at).rowsBetween(Window.unboundedPreceding, -1)
    champion = F.min(error).over(earlier)
    return log.withColumn("champion_rmse", champion).withColumn("deployed", is_promoted(F.col(error), F.col("champion_rmse")))


def promote(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def log_run(spark, path: str, model_name: str, error: float, deployed: bool) -> None:
    row = spark.createDataFrame([(model_name, error, deployed)], "model_name string, rmse double, deployed boolean")
    append_log(row, path, "run_at")


def is_scorable(columns: Sequence[str]) -> Column:
    """Every input is a finite, non-negative number."""
    out = F.lit(True)
    for c in columns:
        v = _col(c)
        out = out & F.coalesce(~F.isnan(v) & (v >= 0) & (v < float("inf")), F.lit(False))
    return out


def with_lag_mean(requests: DataFrame) -> DataFrame:
    mean = sum(F.col(c) for c in LAG_COLUMNS) / len(LAG_COLUMNS)
    return requests.withColumn("lag_mean", mean)


def split_scorable(requests: DataFrame, columns: Sequence[str] = LAG_COLUMNS) -> tuple[DataFrame, DataFrame]:
    """(requests that can be scored, the others with the names of the inputs at fault)."""
    bad = F.array_compact(F.array(*[F.when(~is_scorable([c]), F.lit(c)) for c in columns]))
    fine = is_scorable(columns)
    return requests.where(fine), requests.where(~fine).withColumn("rejected_inputs", F.array_join(bad, ","))


def score(model: PipelineModel, requests: DataFrame, unit: str = labels.PRICE_UNIT, model_time=None) -> DataFrame:
    """Forecast floored at zero and rounded to 2 digits, its change against the last price and direction.

    Requests that cannot be scored are left out, so that one of them does not fail the others; ``split_scorable`` has them.
    """
    scored = model.transform(with_lag_mean(split_scorable(requests)[0])).drop("features")
    out = scored.withColumn("forecast", floored_forecast("prediction")).drop("prediction")
    return forecast_change(out.withColumn("unit", F.lit(unit)).withColumn("model_time", F.lit(model_time).cast("string")))


def floored_forecast(prediction: Column | str) -> Column:
    """Never below zero, two digits."""
    return round_half_up(F.greatest(F.lit(0.0), _col(prediction)), 2).cast("double")


def forecast_change(df: DataFrame, forecast: str = "forecast", last: str = "lag_1") -> DataFrame:
    """The change against the last value, of the decimals both show, and its direction."""
    delta = difference(forecast, last)
    return df.withColumn("delta", F.round(delta, 2).cast("double")).withColumn("direction", F.when(delta >= 0, "up").otherwise("down"))


def split_by_key(df: DataFrame, key: str, train_share: float = 0.8, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Seeded split on a digest of the key, one that other engines know, too: the same rows fall on the same side however
    the table is laid out, and also after a task is run again. Rows without a key go to the first side."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit(""))))
    slot = F.conv(F.left(digest, F.lit(8)), 16, 10).cast("bigint") % 10_000
    slot = F.when(F.col(key).isNotNull(), slot).otherwise(0)
    cut = round(train_share * 10_000)
    return df.where(slot < cut), df.where(slot >= cut)


def train_forest(train: DataFrame, label: str, features: Sequence[str]) -> PipelineModel:
    assembler = VectorAssembler(inputCols=list(features), outputCol="features")
    forest = RandomForestClassifier(
        featuresCol="features", labelCol=label, numTrees=labels.FOREST_TREES, seed=labels.FOREST_SEED
    )
    return Pipeline(stages=[assembler, forest]).fit(train)


def accuracy(predicted: DataFrame, label: str) -> float:
    return MulticlassClassificationEvaluator(labelCol=label, predictionCol="prediction", metricName="accuracy").evaluate(predicted)


def passes_accuracy(value: float, bound: float = labels.ACCURACY_BOUND) -> bool:
    return value > bound


def sample_check(model: PipelineModel, sample: DataFrame, label: str) -> DataFrame:
    """(correct, checked) over a few known rows: proof that the stored model answers."""
    hit = F.col("prediction") == F.col(label)
    return model.transform(sample).agg(F.count_if(hit).alias("correct"), F.count(F.lit(1)).alias("checked"))


def train_and_select(
    features: DataFrame, target: str, holdout: str, log: DataFrame, model_name: str
) -> tuple[PipelineModel, float, bool]:
    """Fit on the non-holdout rows, measure on the holdout, compare with the champion.

    The error is taken to nine digits: the order in which tasks finish moves the last bits of a fit, and that
    must not count as a better model.
    """
    train, held = features.where(~F.col(holdout)), features.where(F.col(holdout))
    if held.isEmpty():
        raise QualityError("no holdout rows")
    check_training(train)
    model = train_regression(train, target)
    error = rmse(model.transform(held), target).select(F.round("rmse", 9).alias("rmse"))
    row = error.select("rmse", is_promoted(F.col("rmse"), champion_rmse(log, model_name)).alias("go")).first()
    return model, row.rmse, row.go
