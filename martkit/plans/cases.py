"""Case files -> clean cases -> summary tables -> gate -> star-schema export."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martkit import labels
from martkit.functions.casts import lenient_date, lenient_long
from martkit.functions.numbers import fixed_mean, within
from martkit.functions.text import canonical_synonym, default_label, member_label, squeeze_or_null
from martkit.operators.calendar import band_dimension, calendar_dimension, entity_dimension
from martkit.operators.dedupe import keep_first
from martkit.operators.marts import count_by, rollup_by, summarise
from martkit.operators.quality import Gate, RowRule, out_of_range
from martkit.operators.windows import daily_series, moving_average_rows
from martkit.sinks.export import export_bundle
from martkit.sources.tabular import drop_blank, read_harmonised
from martkit.sources.workbook import read_workbooks


def load_cases(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Typed raw cases of all files, workbooks and delimited ones."""
    books = [p for p in paths if p.lower().endswith(".xlsx")]
    parts = [
        _typed(read(spark, files, labels.CASE_HEADERS, labels.CASE_COLUMNS, labels.CASE_REQUIRED), read is read_workbooks)
        for read, files in ((read_workbooks, books), (read_harmonised, [p for p in paths if p not in books])) if files
    ]
    return drop_blank(reduce(DataFrame.unionByName, parts), ["case_no", "announce_date", "province_of_isolation"])


def _typed(text: DataFrame, day_numbers: bool) -> DataFrame:
    longs, dates = ("case_no", "age"), ("announce_date", "notified_date")
    typed = []
    for c in labels.CASE_COLUMNS:
        if c in longs:
            typed.append(lenient_long(c).alias(c))
        elif c in dates:
            typed.append(lenient_date(c, serial_numbers=day_numbers).alias(c))
        else:
            typed.append(squeeze_or_null(c).alias(c))
    return text.select(*typed, "source_file")


def clean_cases(raw: DataFrame) -> DataFrame:
    """Valid rows only, first row per case number, normalised labels.

    Rows are filtered and deduplicated before any label is computed: dropped rows cost nothing more.
    """
    low, high = labels.CASE_DATE_RANGE
    valid = raw.where(F.col("announce_date").between(F.lit(low), F.lit(high)) & F.col("case_no").isNotNull())
    first = keep_first(valid, ["case_no"], ["announce_date", "source_file"])
    age = within("age", *labels.AGE_RANGE)
    return first.select(
        "case_no",
        "announce_date",
        "notified_date",
        member_label("sex", labels.SEX_SPELLINGS, labels.UNSPECIFIED).alias("sex"),
        age.alias("age"),
        labels.AGE_BANDS.label(age).alias("age_group"),
        canonical_synonym("nationality", labels.NATIONALITY_SYNONYMS, labels.UNSPECIFIED).alias("nationality"),
        default_label("province_of_isolation", labels.UNSPECIFIED).alias("province"),
        default_label("risk", labels.UNSPECIFIED).alias("risk"),
        default_label("district_of_onset", labels.UNSPECIFIED).alias("district"),
        "source_file",
    )


def case_marts(cases: DataFrame) -> dict[str, DataFrame]:
    daily = daily_series(cases, "announce_date", measures={"cases": F.count(F.lit(1))})
    marts = {"daily": moving_average_rows(daily, "cases", name="moving_avg_7d")}
    for key in ("province", "age_group", "sex", "nationality"):
        marts[f"by_{key}"] = count_by(cases, key, "cases")
    marts["summary"] = summarise(cases, {
        "total_cases": F.count(F.lit(1)),
        "first_date": F.min("announce_date"),
        "last_date": F.max("announce_date"),
        "avg_age": fixed_mean("age", 1),
        "province_count": F.count_distinct("province"),
    })
    return marts


def case_gate(cases: DataFrame, daily: DataFrame) -> Gate:
    return (
        Gate()
        .rows(
            cases,
            [
                RowRule("announce_date is null", F.col("announce_date").isNull()),
                RowRule("age out of range", out_of_range("age", *labels.AGE_RANGE)),
            ],
            not_empty="cases empty",
        )
        .unique(cases, ["case_no"], "case_no repeated")
        .not_empty(daily, "daily summary empty")
    )


def case_star(cases: DataFrame, marts: dict[str, DataFrame]) -> dict[str, tuple[DataFrame, Sequence]]:
    fact_keys = ["announce_date", "province", "sex", "age_group", "nationality"]
    fact = rollup_by(cases, fact_keys, {"cases": F.count(F.lit(1))})
    ages = band_dimension(marts["by_age_group"], "age_group", labels.AGE_BANDS)
    return {
        "fact_cases": (fact, ["announce_date", "province"]),
        "dim_date": (calendar_dimension(cases, "announce_date"), ["day"]),
        "dim_province": (entity_dimension(marts["by_province"], "province", "cases"), ["rank"]),
        "dim_age_group": (ages.select("age_group", "sort_order", "cases"), ["sort_order"]),
        "summary_daily": (marts["daily"], ["day"]),
        "summary_overall": (marts["summary"], []),
    }


def run_report(raw: DataFrame, cases: DataFrame, marts: dict[str, DataFrame]) -> DataFrame:
    """Loaded, clean and dropped rows, date range, mean age, and the largest province."""
    loaded = raw.agg(F.count(F.lit(1)).alias("n")).scalar()
    # of equal provinces the first label, as in the ranks
    top = F.min_by("province", F.struct(-F.col("cases"), F.col("province")))
    return marts["summary"].select(
        loaded.alias("loaded"),
        F.col("total_cases").alias("clean"),
        (loaded - F.col("total_cases")).alias("dropped"),
        "first_date", "last_date", "avg_age", "province_count",
        marts["by_province"].agg(top.alias("p")).scalar().alias("top_province"),
    )


def build_cases(spark: SparkSession, paths: Sequence[str], out: str) -> DataFrame:
    """The whole flow. The clean table is written once; every mart reads that, not the files."""
    raw = load_cases(spark, paths)
    clean_cases(raw).write.mode("overwrite").parquet(f"{out}/cases")
    cases = spark.read.parquet(f"{out}/cases")
    marts = {}
    for name, mart in case_marts(cases).items():
        mart.write.mode("overwrite").parquet(f"{out}/{name}")
        marts[name] = spark.read.parquet(f"{out}/{name}")
    run_report(raw, cases, marts).write.mode("overwrite").parquet(f"{out}/run_report")
    case_gate(cases, marts["daily"]).enforce()
    return export_bundle(case_star(cases, marts), f"{out}/export")
