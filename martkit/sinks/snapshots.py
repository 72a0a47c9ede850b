"""Tables of months whose contents are named by a manifest: a load shows all at once or not at all.

A load writes its rows into a folder of its own, ``data/load=<id>/month=<month>``, and then publishes a manifest that names
the folders of every month, by one rename that fails if another load has published meanwhile. What is stored is never changed
or moved. Readers that have begun keep the folders they know; a load that dies leaves folders that no manifest names, and
needs no repair. ``vacuum`` removes what the last manifests do not name.

The manifest keeps for each month's part its rows and the range of its first key, so that a load looks for clashing keys only
in parts whose range meets its own. It has one entry for each month and load; ``compact`` joins a month's parts.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping, Sequence
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martkit.functions.dates import wall_time
from martkit.operators.dedupe import keep_first, keep_last
from martkit.sinks.writers import MONTH, Staging, _exists, _file_system, _starts_month, _with_month, months_between


def changed_months(known: dict, before: dict | None) -> list[str]:
    """Months whose parts differ between two manifests of a table; all of them without an earlier one."""
    old = before["months"] if before else {}
    return sorted(m for m in {*old, *known["months"]} if old.get(m) != known["months"].get(m))


def follow(source: str, target: str, spark: SparkSession, build: Callable[[DataFrame], DataFrame], key: str) -> list[str]:
    """Bring a table made month by month from another up to its newest version: ``build`` is given the rows of the months that
    have changed since, and no others are read. ``build`` keeps ``month``. Returns those months."""
    newest, known = manifest(spark, source), manifest(spark, target)
    seen = known["about"].get("source_version") if known else None
    if seen == newest["version"]:
        return []
    changed = changed_months(newest, manifest(spark, source, seen) if seen else None)
    rows = build(_parts(spark, source, newest["schema"], {m: newest["months"][m] for m in changed if m in newest["months"]}))
    load = _Load(spark, target, _schema(rows))
    load.write(rows)
    kept = {m: p for m, p in (known["months"] if known else {}).items() if m not in changed}
    _publish(spark, target, known, load.schema, kept | {m: [p] for m, p in load.parts(key).items()}, {"source_version": newest["version"]})
    return changed


#: About as many rows as a task sorts or writes of a batch whose size is known.
ROWS = 1_000_000


class Conflict(RuntimeError):
    """Another load has published since this one began; it can be run again."""


def _manifests(spark: SparkSession, path: str) -> list[int]:
    fs, folder = _file_system(spark, f"{path}/manifests")
    if not fs.exists(folder):
        return []
    names = [f.getPath().getName() for f in fs.listStatus(folder)]
    return sorted(int(n.split(".")[0]) for n in names if n.endswith(".json") and not n.startswith("."))


def manifest(spark: SparkSession, path: str, version: int | None = None) -> dict | None:
    """``version, schema, months``: for each month its parts, the newest manifest if none is named."""
    found = _manifests(spark, path)
    if version is None and not found:
        return None
    fs, file = _file_system(spark, f"{path}/manifests/{version or found[-1]:012d}.json")
    stream = fs.open(file)
    try:
        return json.loads(bytes(stream.readAllBytes()))
    finally:
        stream.close()


def _publish(spark: SparkSession, path: str, known: dict | None, schema: str, months: Mapping[str, list], about: Mapping | None = None) -> int:
    """``about``: what else the manifest is to say of this version."""
    version = (known["version"] if known else 0) + 1
    jvm = spark._jvm
    fs, written = _file_system(spark, f"{path}/manifests/.{uuid.uuid4().hex}")
    stream = fs.create(written)
    stream.write(bytearray(json.dumps({"version": version, "schema": schema, "months": dict(sorted(months.items())), "about": dict(about or {})}).encode()))
    stream.close()
    final = jvm.org.apache.hadoop.fs.Path(f"{path}/manifests/{version:012d}.json")
    files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
    try:  # without the option to overwrite
        files.rename(written, final, spark._sc._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0))
    except Exception as e:
        fs.delete(written, False)
        if fs.exists(final):
            raise Conflict(f"{path} has a version {version} already") from e
        raise
    return version


def _parts(spark: SparkSession, path: str, schema: str, months: Mapping[str, list]) -> DataFrame:
    """The rows of some parts; the folders are listed by name, so that nothing else is looked at."""
    folders = [f"{path}/data/load={p['load']}/{MONTH}={m}" for m, parts in months.items() for p in parts]
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", f"{path}/data").parquet(*folders).drop("load")


def read(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The table as its newest (or the named) manifest has it; later loads do not change it. ``month`` is its partition."""
    known = manifest(spark, path, version)
    if known is None:
        raise ValueError(f"no table at {path}")
    return _parts(spark, path, known["schema"], known["months"])


def _schema(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)


class _Load:
    """The folder of one load."""

    def __init__(self, spark: SparkSession, path: str, schema: str):
        self.spark, self.schema, self.id = spark, schema, uuid.uuid4().hex[:16]
        self.folder = f"{path}/data/load={self.id}"
        self.base = f"{path}/data"

    def write(self, df: DataFrame, key: str | None = None, most: int | None = None) -> DataFrame:
        """Rebalancing by month keeps the file count down; a month with very many rows is still split over tasks. Splits go by
        compressed bytes, though, and narrow rows by the million take little of those: where there may be more than ``ROWS``
        (at most ``most``), tasks get about that many each, by ranges of month and key."""
        parts = -(-most // ROWS) if most and key else 1
        dealt = df.repartitionByRange(parts, MONTH, f"`{key}`") if parts > 1 else df.hint("rebalance", MONTH)
        dealt.write.mode("append").partitionBy(MONTH).parquet(self.folder)
        return self.rows()

    def rows(self) -> DataFrame:
        return self.spark.read.schema(self.schema).option("basePath", self.base).parquet(self.folder).drop("load")

    def parts(self, key: str, inside=None) -> dict[str, dict]:
        """For each month written: its part, with rows and the key's range; one row a month comes to the driver. ``inside``: a
        condition whose rows are counted, too, into ``self.inside``."""
        condition = F.lit(True) if inside is None else inside
        known = self.rows().groupBy(MONTH).agg(
            F.count(F.lit(1)).alias("n"), F.min(key).alias("low"), F.max(key).alias("high"), F.count_if(condition).alias("inside"),
            # least and greatest strings alone would have all rows sorted by month; next to a collected set they are hashed
            F.collect_set(F.lit(1)),
        ).collect()
        self.inside = sum(r.inside for r in known)
        return {r[MONTH]: {"load": self.id, "rows": r.n, "low": _plain(r.low), "high": _plain(r.high)} for r in known}


def _plain(value):
    """A bound that JSON holds and that sorts as the key does; none for other kinds of keys."""
    if isinstance(value, (date, datetime)):
        return value.isoformat(" ") if isinstance(value, datetime) else value.isoformat()
    return value if isinstance(value, (int, str)) and not isinstance(value, bool) else None


def meeting(months: Mapping[str, list], parts: Mapping[str, dict]) -> dict[str, list]:
    """The parts in ``months`` whose key range meets that of the new ``parts``; parts without a range always do."""
    bounds = [(p["low"], p["high"]) for p in parts.values() if p["low"] is not None]
    unknown = len(bounds) < len(parts)
    low, high = (min(b[0] for b in bounds), max(b[1] for b in bounds)) if bounds else (None, None)

    def meets(p: dict) -> bool:
        return unknown or p["low"] is None or (bool(bounds) and p["low"] <= high and p["high"] >= low)

    found = {m: [p for p in own if meets(p)] for m, own in months.items()}
    return {m: own for m, own in found.items() if own} if parts else {}


def _without_known(load: _Load, parts: dict, path: str, months: Mapping[str, list], keys: Sequence[str], stage: Staging, where=None, most: int | None = None) -> _Load:
    """The load without rows whose key the stored parts hold, where ``where`` is true: mostly it itself, else one written anew."""
    spark = load.spark
    near = meeting(months, parts)
    if not near:
        return load
    stored = _parts(spark, path, load.schema, near)
    stored = stored.where(where) if where is not None else stored
    # the table is cut to the keys of the load: a map-only pass over its key columns while the load is small
    clash = stage(stored.select(*keys).join(load.rows().select(*keys), list(keys), "left_semi").distinct())
    if clash.isEmpty():
        return load
    again = _Load(spark, path, load.schema)
    again.write(load.rows().join(clash, list(keys), "left_anti"), keys[0], most)
    return again


def replace_window(batch: DataFrame, path: str, at: str, start: datetime, end: datetime, keys: Sequence[str], order: Sequence[str] = (), most: int | None = None) -> dict[str, int]:
    """Delete ``[start, end)`` and insert the batch, in one step for readers; keys present elsewhere in the table are ignored.
    ``most``: the number of rows of the batch, or a bound, where it is known.

    Within the batch the first row per key by ``order`` is kept. An empty batch clears the window. Rows of the touched months
    outside the window are kept. Reports distinct keys of the batch and stored rows. The batch is written once, unless some of
    its keys are stored elsewhere.
    """
    spark = batch.sparkSession
    known = manifest(spark, path)
    lo, hi = wall_time(start), wall_time(end)
    inside = (F.col(at) >= lo) & (F.col(at) < hi)
    months = months_between(start, end)
    fresh = _with_month(keep_first(batch, keys, order).drop(*order), at)
    first = load = _Load(spark, path, _schema(fresh))
    load.write(fresh, keys[0], most)
    parts = load.parts(keys[0], inside)
    distinct = sum(p["rows"] for p in parts.values())
    stored = known["months"] if known else {}
    covered = set(months[(not _starts_month(start)):(len(months) - (not _starts_month(end)))])
    with Staging(spark, "clash") as stage:
        load = _without_known(load, parts, path, {m: p for m, p in stored.items() if m not in covered}, keys, stage, ~inside, most)
        if load is not first:
            parts = load.parts(keys[0], inside)
        # a batch may hold rows outside its window: their months are written anew, too
        touched = {*months, *parts}
        partly = {m: p for m, p in stored.items() if m in touched - covered}
        if partly:
            load.write(_parts(spark, path, load.schema, partly).where(~inside))
            parts = load.parts(keys[0], inside)
    _publish(spark, path, known, load.schema, {m: p for m, p in stored.items() if m not in touched} | {m: [p] for m, p in parts.items()})
    return {"distinct": distinct, "in_window": load.inside}


def insert_if_absent(batch: DataFrame, path: str, keys: Sequence[str], order: Sequence[str] = (), at: str = "at") -> int:
    """Add rows whose key is new; the first writer of a key wins."""
    spark = batch.sparkSession
    known = manifest(spark, path)
    fresh = _with_month(keep_first(batch, keys, order), at)
    first = load = _Load(spark, path, _schema(fresh))
    load.write(fresh)
    parts = load.parts(keys[0])
    stored = known["months"] if known else {}
    with Staging(spark, "clash") as stage:
        load = _without_known(load, parts, path, stored, keys, stage)
    if load is not first:
        parts = load.parts(keys[0])
    if parts or not known:
        _publish(spark, path, known, load.schema, {m: stored.get(m, []) + ([parts[m]] if m in parts else []) for m in {*stored, *parts}})
    return sum(p["rows"] for p in parts.values())


def upsert(batch: DataFrame, path: str, keys: Sequence[str], at: str, version: str = "inserted_at") -> None:
    """Replace the row of a known key, add unknown ones; only months of the batch are written anew. ``at`` must be part of the
    key, so a key never moves to another month. The batch wins over the table, its highest ``version`` over its other rows."""
    if at not in keys:
        raise ValueError("the date that partitions the table must be part of the key")
    spark = batch.sparkSession
    known = manifest(spark, path)
    fresh = batch if version in batch.columns else batch.withColumn(version, F.current_timestamp())
    fresh = _with_month(keep_last(fresh, keys, [version]), at)
    load = _Load(spark, path, _schema(fresh))
    load.write(fresh)
    stored = known["months"] if known else {}
    own = load.parts(keys[0])
    touched = {m: p for m, p in stored.items() if m in own}
    if touched:
        with Staging(spark, "upsert") as stage:
            mine = stage(load.rows().select(*keys))
            load.write(_parts(spark, path, load.schema, touched).join(mine, list(keys), "left_anti"))
    parts = load.parts(keys[0])
    if parts or not known:
        _publish(spark, path, known, load.schema, {**stored, **{m: [p] for m, p in parts.items()}})


def compact(spark: SparkSession, path: str, key: str, most: int = 1) -> int:
    """Months of more than ``most`` parts get one part with the same rows; returns their number."""
    known = manifest(spark, path)
    many = {m: p for m, p in known["months"].items() if len(p) > most}
    if many:
        load = _Load(spark, path, known["schema"])
        load.write(_parts(spark, path, known["schema"], many))
        _publish(spark, path, known, known["schema"], {**known["months"], **{m: [p] for m, p in load.parts(key).items()}})
    return len(many)


def vacuum(spark: SparkSession, path: str, keep: int = 1) -> int:
    """Remove older manifests and the folders that the last ``keep`` do not name; to be run when no load is under way and no
    reader of an older version is. Returns the number of folders removed."""
    versions = _manifests(spark, path)
    named = {p["load"] for v in versions[-keep:] for parts in manifest(spark, path, v)["months"].values() for p in parts}
    fs, data = _file_system(spark, f"{path}/data")
    gone = [f.getPath() for f in fs.listStatus(data) if f.getPath().getName().removeprefix("load=") not in named] if fs.exists(data) else []
    for folder in gone:
        fs.delete(folder, True)
    for v in versions[:-keep]:
        fs.delete(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/manifests/{v:012d}.json"), False)
    return len(gone)


def exists(spark: SparkSession, path: str) -> bool:
    return _exists(spark, f"{path}/manifests") and bool(_manifests(spark, path))
