"""Mixing sources to target weights along a time-varying curriculum, in DataFrame functions only.

Each source has a weight schedule over training time from 0 to 1. Its integral up to a time is what has been asked of the
source by then; inverted, it gives each taken document its position. Documents are sorted by range of position.

Cases: null texts have size 0. A null source is a source, after all others. Repeated rows each count. Sources without words
take nothing. Ties in the order of a source's documents go by id, then size, then the text's hash; equal rows are
interchangeable. Extra columns, whatever their names, are ignored by ``plan`` and ``curriculum`` and kept by ``apply``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martkit.llm.common import TOKEN, free_names, need, stage

#: Digits of the order key's prefix that split a source: 16**3 parts, so that no source is one window.
PART_DIGITS = 3


def _slope(place: Column) -> Column:
    """How a source's weight moves over time: weight * (1 + slope * (2 t - 1)). Sources by turns fade, stay and grow; the
    integral over all of training is the plain weight."""
    return F.element_at(F.array(F.lit(-0.5), F.lit(0.0), F.lit(0.5)), (place % 3 + 1).cast("int"))


def demand(t: Column, slope: Column) -> Column:
    """Share of a source's words asked for up to time ``t``: the integral of its schedule."""
    return (1 - slope) * t + slope * t * t


def position(share: Column, slope: Column) -> Column:
    """The time by which ``share`` of a source's words is asked for: ``demand`` inverted."""
    root = F.sqrt(F.greatest((1 - slope) * (1 - slope) + 4 * slope * share, F.lit(0.0)))
    return F.when(F.abs(slope) < 1e-9, share).otherwise(2 * share / (1 - slope + root))


def targets(sizes: DataFrame, weights: tuple[float, ...], most_times: float) -> DataFrame:
    """``source, source_size`` with rank, slope and target: all words shared by weight, no target above ``most_times`` the
    source's size, the excess reshared by weight. One row a source, so that its windows are small."""
    named = Window.orderBy(F.col("source").asc_nulls_last())
    ranked = sizes.withColumn("place", (F.row_number().over(named) - 1).cast("long"))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    ranked = ranked.withColumn("weight", weight).withColumn("cap", F.col("source_size") * F.lit(float(most_times)))
    ranked = ranked.withColumn("ratio", F.col("cap") / F.col("weight"))
    # with sources in order of cap / weight, the first ones are capped; the level is the lowest that suits the rest
    by = Window.orderBy("ratio", "place")
    before = by.rowsBetween(Window.unboundedPreceding, -1)
    rest = by.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    whole = Window.partitionBy()
    level = (F.sum("source_size").over(whole) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(rest)
    ranked = ranked.withColumn("level", level)
    level = F.min(F.when(F.col("level") <= F.col("ratio"), F.struct("ratio", "place", "level"))).over(whole)["level"]
    ranked = ranked.withColumn("target", F.least(F.col("cap"), F.coalesce(level * F.col("weight"), F.col("cap"))))
    return ranked.select("source", "source_size", "place", "target", _slope(F.col("place")).alias("slope"))


def plan(
    docs: DataFrame, weights: tuple[float, ...] = (1, 2, 3), most_times: float = 3, id_col: str = "doc_id", text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """Per document its size, its source's size and target, how many passes take it, and the positions of those passes.

    Within a source, documents lie in the order of a digest of their id; a pass takes them from the start until the target
    is met, the document across the end by whichever total is nearer. ``h``, the text's hash, tells apart texts of one id.
    """
    need(docs, id_col, text_col, source_col)
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    size = F.size(F.regexp_extract_all(text, F.lit(TOKEN), F.lit(0)))
    rows = docs.select(
        F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{source_col}`").alias("source"), size.cast("long").alias("size"),
        F.md5(F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit(""))).alias("turn"), F.xxhash64(text).alias("h"),
    ).withColumn("part", F.substring("turn", 1, PART_DIGITS))
    rows = stage(rows, "mix")
    parts = stage(rows.groupBy("source", "part").agg(F.sum("size").alias("part_size")), "mix-parts")
    by_source = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    aim = targets(parts.groupBy("source").agg(F.sum("part_size").alias("source_size")), weights, most_times)
    starts = parts.withColumn("start", F.coalesce(F.sum("part_size").over(by_source), F.lit(0)))
    starts = starts.join(aim, starts.source.eqNullSafe(aim.source)).drop(aim.source).drop("part_size")
    starts = starts.withColumnRenamed("source", "_source").withColumnRenamed("part", "_part")
    own = Window.partitionBy("source", "part").orderBy("turn", "doc_id", "size", "h").rowsBetween(Window.unboundedPreceding, -1)
    df = rows.withColumn("inside", F.coalesce(F.sum("size").over(own), F.lit(0)))
    df = df.join(starts, df.source.eqNullSafe(F.col("_source")) & (df.part == F.col("_part"))).drop("_source", "_part")
    # words of the source up to the middle of this document, in the first pass
    middle = F.col("start") + F.col("inside") + F.col("size") / 2
    # a pass begins at each whole multiple of the source's size; it takes what has its middle before the target
    passes = F.ceil((F.col("target") - middle) / F.nullif(F.col("source_size"), F.lit(0)))
    df = df.withColumn("middle", middle).withColumn("passes", F.when(F.col("size") > 0, F.least(F.greatest(passes, F.lit(0)), F.floor(F.lit(most_times)))).otherwise(0).cast("int"))
    share = lambda k: F.least((F.col("middle") + k * F.col("source_size")) / F.col("target"), F.lit(1.0))
    times = F.when(F.col("passes") > 0, F.transform(F.sequence(F.lit(0), F.col("passes") - 1), lambda k: position(share(k), F.col("slope"))))
    return df.select(
        "doc_id", "source", "size", "source_size", "target", (F.col("passes") * F.col("size")).cast("long").alias("taken"), "passes",
        F.coalesce(times, F.array().cast("array<double>")).alias("positions"), "h",
    )


def schedule(planned: DataFrame) -> DataFrame:
    """Every use of a document as a row, sorted by training position over the range of partitions."""
    uses = planned.withColumn("position", F.explode_outer("positions")).where("position IS NOT NULL").drop("positions")
    return uses.repartitionByRange("position", "doc_id").sortWithinPartitions("position", "doc_id")


def curriculum(docs: DataFrame, **settings) -> DataFrame:
    """``plan`` with ``taken`` and ``positions`` as gathered from the uses in the written schedule, sorted over the range of
    partitions by first use; documents without a use come last."""
    planned = stage(plan(docs, **settings).withColumn("row", F.monotonically_increasing_id()), "mix-plan")
    uses = stage(schedule(planned.select("row", "doc_id", "size", "positions")), "mix-uses")
    met = uses.groupBy("row").agg(F.sum("size").alias("taken"), F.sort_array(F.collect_list("position")).alias("positions"))
    whole = planned.drop("taken", "passes", "positions").join(met, "row", "left")
    whole = whole.withColumn("taken", F.coalesce("taken", F.lit(0).cast("long"))).withColumn("_first", F.get("positions", F.lit(0)))
    by = (F.col("_first").asc_nulls_last(), F.col("doc_id"), F.col("row"))
    ordered = whole.repartitionByRange(*by).sortWithinPartitions(*by)
    return ordered.select(
        "doc_id", "source", "size", "source_size", "target", "taken", F.coalesce("positions", F.array().cast("array<double>")).alias("positions")
    )


def apply(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **settings) -> DataFrame:
    """The documents with all their columns, once for each use, sorted by training position over the range of partitions."""
    planned = stage(plan(docs, id_col=id_col, text_col=text_col, source_col=source_col, **settings), "mix-plan")
    its_id, its_source, its_hash, at, own_hash = free_names(docs, "its_id", "its_source", "its_hash", "position", "own_hash")
    uses = planned.select(
        F.col("doc_id").alias(its_id), F.col("source").alias(its_source), F.col("h").alias(its_hash), F.explode_outer("positions").alias(at)
    ).where(F.col(at).isNotNull())
    own = docs.withColumn(own_hash, F.xxhash64(F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))))
    if not planned.groupBy("doc_id", "source", "h").count().where("count > 1").isEmpty():
        own = own.dropDuplicates([id_col, source_col, own_hash])  # each of equal rows brings its uses; one of them meets them all
    same = F.col(f"`{id_col}`").eqNullSafe(F.col(its_id)) & F.col(f"`{source_col}`").eqNullSafe(F.col(its_source)) & (F.col(own_hash) == F.col(its_hash))
    used = own.join(uses, same)
    ordered = used.repartitionByRange(at, own_hash).sortWithinPartitions(at, own_hash)
    return ordered.select(*[f"`{c}`" for c in docs.columns])
