"""One session exports, trains, scores and evaluates, in any order."""

from pyspark.sql import functions as F

from martkit.operators import forecast
from martkit.sinks import export


def test_export_then_classifier(spark, tmp_path):
    rows = spark.range(400).select((F.col("id") % 20).cast("double").alias("a"), (F.col("id") % 7).cast("double").alias("b"))
    rows = rows.withColumn("y", (F.col("a") > 9).cast("double"))
    manifest = export.write_csv(rows, str(tmp_path / "rows"), ["a"]).first()
    assert manifest.rows == 400
    model = forecast.train_forest(rows, "y", ["a", "b"])
    scored = model.transform(rows)
    assert forecast.accuracy(scored, "y") > 0.95 and scored.agg(F.count("prediction")).first()[0] == 400
    export.write_csv(scored.select("a", "prediction"), str(tmp_path / "scored"), ["a"])
    check = forecast.sample_check(model, rows.where("a in (0, 19)"), "y").first()
    assert check.correct == check.checked > 0
