"""Feature checks, champion choice, regression and classifier queries."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from martkit import labels
from martkit.catalog import ORACLES, half_up_sql, mean_sql, query
from martkit.catalog.series import LAG_SQL, daily_prices, lag_features, ordered_holdout
from martkit.functions.dates import month_start
from martkit.functions.numbers import fixed_mean
from martkit.operators import forecast
from martkit.operators.windows import latest_features
from martkit.session import scratch_path
from martkit.sinks import writers

_SPOILED = f"""SELECT event_type, day, CASE WHEN day(day) % 7 = 1 THEN -lag_1 WHEN day(day) % 7 = 2 THEN 'NaN'::DOUBLE
    WHEN day(day) % 7 = 3 THEN NULL WHEN day(day) % 7 = 4 THEN 'Infinity'::DOUBLE ELSE lag_1 END AS lag_1,
    lag_2, lag_3, lag_4, lag_5 FROM ({LAG_SQL})"""


@query("score_input_check", f"""
    SELECT event_type, day, coalesce(lag_1 >= 0 AND NOT isnan(lag_1) AND NOT isinf(lag_1), false) AS scorable FROM ({_SPOILED})""")
def score_input_check(t):
    day = F.dayofmonth("day") % 7
    first = F.when(day == 1, -F.col("lag_1")).when(day == 2, F.lit(float("nan"))).when(day == 3, F.lit(None))
    rows = lag_features(t).withColumn("lag_1", first.when(day == 4, F.lit(float("inf"))).otherwise(F.col("lag_1")))
    return rows.select("event_type", "day", forecast.is_scorable(forecast.LAG_COLUMNS).alias("scorable"))


# The log: one run per ship month and return flag, its "error" the mean discount of that month.
_LOG = f"""SELECT l_returnflag AS model_name, CAST(date_trunc('month', l_shipdate) AS DATE) AS run_at,
    {mean_sql('l_discount', 6)} AS rmse FROM lineitem GROUP BY 1, 2"""
_REPLAY = f"""
    WITH l AS ({_LOG}), c AS (SELECT *, min(rmse) OVER (PARTITION BY model_name ORDER BY run_at
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS champion_rmse FROM l)
    SELECT *, champion_rmse IS NULL OR rmse < champion_rmse AS deployed FROM c"""


def _metric_log(t):
    error = fixed_mean("l_discount", 6).cast("double").alias("rmse")
    return t.lineitem.groupBy(F.col("l_returnflag").alias("model_name"), month_start("l_shipdate").alias("run_at")).agg(error)


@query("champion_replay", _REPLAY)
def champion_replay(t):
    return forecast.replay_promotions(_metric_log(t))


@query("champion_select", f"""
    WITH r AS ({_REPLAY}),
    champion AS (SELECT rmse FROM r WHERE model_name = 'A' AND deployed ORDER BY run_at DESC LIMIT 1)
    SELECT model_name, run_at, rmse, (SELECT rmse FROM champion) AS champion_rmse, rmse < (SELECT rmse FROM champion) AS promoted
    FROM r WHERE model_name IS DISTINCT FROM 'A'""")
def champion_select(t):
    """Would the runs of the other models beat the current champion of one?"""
    log = champion_replay(t)
    champion = forecast.champion_rmse(log, "A")
    candidates = log.where("NOT model_name <=> 'A'").select("model_name", "run_at", "rmse", champion.alias("champion_rmse"))
    return candidates.withColumn("promoted", forecast.is_promoted(F.col("rmse"), F.col("champion_rmse")))


@query("holdout_rmse", f"""
    WITH h AS (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY day DESC) <= 5 AS is_holdout FROM ({LAG_SQL}))
    SELECT round(sqrt(avg((lag_1 - price) ** 2)), 6) AS rmse FROM h WHERE is_holdout""")
def holdout_rmse(t):
    """Holdout error of the forecast "same as yesterday", which any model has to beat."""
    held = ordered_holdout(t).where("is_holdout").withColumn("prediction", F.col("lag_1"))
    return forecast.rmse(held, "price").select(F.round("rmse", 6).alias("rmse"))


_UNITS = "CAST(round(({}) * 10000) AS BIGINT)"
_FORECAST = half_up_sql(f"({_UNITS.format('lag_1')} + {_UNITS.format('lag_2')} + {_UNITS.format('lag_3')} + {_UNITS.format('lag_4')} + {_UNITS.format('lag_5')})", "5", 4, 2)


@query("forecast_change", f"""
    WITH f AS (SELECT event_type, day, lag_1, {_FORECAST} AS forecast FROM ({LAG_SQL}))
    SELECT event_type, day, lag_1, forecast, {half_up_sql('(' + _UNITS.format('forecast') + ' - ' + _UNITS.format('lag_1') + ')', '1', 4, 2)} AS delta,
           CASE WHEN forecast - lag_1 >= 0 THEN 'up' ELSE 'down' END AS direction FROM f""")
def forecast_change(t):
    rows = lag_features(t).select("event_type", "day", "lag_1", forecast.floored_forecast("lag_mean").alias("forecast"))
    return forecast.forecast_change(rows)


def _least_squares_sql(train: str, inputs: list[str], target: str, by: str = "") -> str:
    """CTEs ending in ``fit``: one row (for each ``by``) with weights ``w0`` (intercept) .. ``wN``.

    The normal equations, solved by elimination step by step. The mean of the lags is left out: it adds
    nothing to the predictions.
    """
    terms, size = ["1.0", *inputs], len(inputs) + 1
    cells = [f"sum({terms[i]} * {terms[j] if j < size else target}) AS m{i}_{j}" for i in range(size) for j in range(size + 1)]
    key, group = (f"{by}, ", f" GROUP BY {by}") if by else ("", "")
    steps = [f"s0 AS (SELECT {key}{', '.join(cells)} FROM ({train}){group})"]
    for k in range(size):
        scaled = {j: f"(m{k}_{j} / m{k}_{k})" for j in range(size + 1)}
        out = [
            f"{scaled[j]} AS m{i}_{j}" if i == k else f"m{i}_{j} - m{i}_{k} * {scaled[j]} AS m{i}_{j}"
            for i in range(size) for j in range(size + 1)
        ]
        steps.append(f"s{k + 1} AS (SELECT {key}{', '.join(out)} FROM s{k})")
    weights = ", ".join(f"m{i}_{size} AS w{i}" for i in range(size))
    return ", ".join([*steps, f"fit AS (SELECT {key}{weights} FROM s{size})"])


_LAG_NAMES = [f"lag_{k}" for k in range(1, 6)]
_PREDICTED = "w0 + " + " + ".join(f"w{k} * lag_{k}" for k in range(1, 6))
_HELD = f"SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY day DESC) <= 5 AS is_holdout FROM ({LAG_SQL})"
_FLOORED = "CAST(round(CAST(greatest(p, 0) AS DECIMAL(18, 9)), 2) AS DOUBLE)"
_SCORED = f"""SELECT * EXCLUDE (p), CAST('บาท/ลิตร' AS VARCHAR) AS unit, CAST(NULL AS VARCHAR) AS model_time, {_FLOORED} AS forecast,
    CAST(round(CAST({_FLOORED} - lag_1 AS DECIMAL(18, 9)), 2) AS DOUBLE) AS delta,
    CASE WHEN {_FLOORED} >= lag_1 THEN 'up' ELSE 'down' END AS direction"""


@query("price_regression", f"""
    WITH h AS ({_HELD}), {_least_squares_sql('SELECT * FROM h WHERE NOT is_holdout', _LAG_NAMES, 'price')},
    r AS (SELECT h.*, {_PREDICTED} AS p FROM h, fit WHERE is_holdout) {_SCORED} FROM r""")
def price_regression(t):
    """One regression over all series: holdout rows with forecast, floor, change and direction."""
    rows = ordered_holdout(t)
    model = forecast.train_regression(rows.where("not is_holdout"), "price")
    return forecast.score(model, rows.where("is_holdout"))


@query("model_rmse", f"""
    WITH h AS ({_HELD}), {_least_squares_sql('SELECT * FROM h WHERE NOT is_holdout', _LAG_NAMES, 'price')}
    SELECT round(sqrt(avg(({_PREDICTED} - price) ** 2)), 4) AS rmse, true AS promoted FROM h, fit WHERE is_holdout""")
def model_rmse(t):
    """The candidate's holdout error and whether it becomes champion of an empty log."""
    log = t.spark.createDataFrame([], "model_name string, rmse double, deployed boolean, run_at timestamp")
    model, _, promoted = forecast.train_and_select(ordered_holdout(t), "price", "is_holdout", log, "daily")
    error = forecast.rmse(model.transform(ordered_holdout(t).where("is_holdout")), "price")
    return error.select(F.round("rmse", 4).alias("rmse"), F.lit(promoted).alias("promoted"))


@query("regression_by_type", f"""
    WITH h AS ({_HELD}), {_least_squares_sql('SELECT * FROM h WHERE NOT is_holdout', _LAG_NAMES, 'price', 'event_type')}
    SELECT event_type, count(*) AS held, round(sqrt(avg(({_PREDICTED} - price) ** 2)), 4) AS rmse FROM h JOIN fit USING (event_type) WHERE is_holdout GROUP BY 1""")
def regression_by_type(t):
    """A model of its own for every series, all in one job, measured on the series' last rows."""
    rows = ordered_holdout(t)
    weights = forecast.regressions_by_series(rows.where("NOT is_holdout"), "price", ["event_type"])
    held = forecast.predict_by_series(rows.where("is_holdout"), weights, ["event_type"])
    error = F.col("prediction") - F.col("price")
    return held.groupBy("event_type").agg(F.count(F.lit(1)).alias("held"), F.round(F.sqrt(F.avg(error * error)), 4).alias("rmse"))


@query("promotion_log", f"""
    WITH h AS ({_HELD}), {_least_squares_sql('SELECT * FROM h WHERE NOT is_holdout', _LAG_NAMES, 'price')},
    r AS (SELECT round(sqrt(avg(({_PREDICTED} - price) ** 2)), 4) AS rmse FROM h, fit WHERE is_holdout)
    SELECT 'daily' AS model_name, rmse, unnest([true, false]) AS deployed FROM r""")
def promotion_log(t):
    """Two runs over the same features, each logged: the first is promoted and stored, the second is not better.

    The stored model then gives the logged error again."""
    model_path, log_path = scratch_path(t.spark, "model"), scratch_path(t.spark, "model-log")
    features = writers.rebuild(ordered_holdout(t), scratch_path(t.spark, "features"))
    log = t.spark.createDataFrame([], "model_name string, rmse double, deployed boolean, run_at timestamp")
    for _ in range(2):
        model, error, go = forecast.train_and_select(features, "price", "is_holdout", log, "daily")
        if go:
            forecast.promote(model, model_path)
        forecast.log_run(t.spark, log_path, "daily", error, go)
        log = t.spark.read.parquet(log_path)
    stored = PipelineModel.load(model_path).transform(features.where("is_holdout"))
    checked = forecast.rmse(stored, "price").select(F.round("rmse", 4)).scalar()
    same = F.round("rmse", 4) == checked
    return log.where(same).select("model_name", checked.alias("rmse"), "deployed")


@query("next_forecast", f"""
    WITH l AS ({LAG_SQL}), {_least_squares_sql('SELECT * FROM l', _LAG_NAMES, 'price')},
    r AS (SELECT f.*, {_PREDICTED} AS p FROM ({ORACLES["latest_features"]}) f, fit) {_SCORED} FROM r""")
def next_forecast(t):
    """Forecast of the day after the last one, per series."""
    model = forecast.train_regression(lag_features(t), "price")
    return forecast.score(model, latest_features(daily_prices(t), "price", series=["event_type"]))


_TEXT_FEATURES = ("n_chars", "words", "lines", "digit_share", "odd_share")


def _text_features(t):
    """Labelled documents with what the classifier looks at; they are joined by id before any text is looked at."""
    size = F.greatest(F.length("text"), F.lit(1))
    docs = t.documents.select("doc_id", "text", "n_chars").join(t.labels.select("doc_id", "quality"), "doc_id")
    return docs.select(
        "doc_id", F.col("quality").cast("double").alias("quality"), "n_chars",
        F.size(F.split("text", r"\s+")).alias("words"), F.size(F.split("text", "\n")).alias("lines"),
        (F.length(F.regexp_replace("text", r"\D", "")) / size).alias("digit_share"),
        (F.length(F.regexp_replace("text", r"(?U)[\w\s.,]", "")) / size).alias("odd_share"),
    )


_TEXT_SLOT = "CAST('0x' || left(md5('42:' || doc_id), 8) AS UBIGINT) % 10000"


@query("classifier_features", rf"""
    SELECT doc_id, quality::DOUBLE AS quality, n_chars, CAST(len(regexp_split_to_array(text, '\s+')) AS INTEGER) AS words, CAST(len(string_split(text, chr(10))) AS INTEGER) AS lines,
           length(regexp_replace(text, '[^0-9]', '', 'g')) / greatest(length(text), 1) AS digit_share,
           length(regexp_replace(text, '[\p{{L}}\p{{M}}\p{{Nd}}\p{{Nl}}\p{{Pc}}\s\x0b\x85\p{{Z}}.,]', '', 'g')) / greatest(length(text), 1) AS odd_share, {_TEXT_SLOT} < 8000 AS is_train
    FROM documents JOIN labels USING (doc_id)""")
def classifier_features(t):
    """The classifier's rows and the side of the split on which each lies."""
    train, test = forecast.split_by_key(_text_features(t), "doc_id")
    return train.withColumn("is_train", F.lit(True)).unionByName(test.withColumn("is_train", F.lit(False)))


@query("quality_classifier")
def quality_classifier(t):  # its rows have SQL in classifier_features; a forest has none
    """Labelled documents: seeded split, forest, accuracy against its bound, and a check on known rows."""
    rows = _text_features(t)
    train, test = forecast.split_by_key(rows, "doc_id")
    model = forecast.train_forest(train, "quality", _TEXT_FEATURES)
    reached = forecast.accuracy(model.transform(test), "quality")
    checked = forecast.sample_check(model, test.orderBy("doc_id").limit(3), "quality")
    counts = rows.agg(F.count(F.lit(1)).alias("labelled"))
    return checked.select(
        counts.scalar().alias("labelled"), F.lit(reached).alias("accuracy"),
        F.lit(forecast.passes_accuracy(reached, labels.ACCURACY_BOUND)).alias("deployed"), "correct", "checked",
    )
