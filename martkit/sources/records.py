"""Records of delimited files whose quoted fields may hold line breaks, read by as many tasks as the files have splits.

Where a line begins inside a quoted field depends on all quotes before it. A split therefore first tells, for either answer,
whether it ends inside such a field. These small functions are composed along each file, one row for each split, which says
how every split begins; then each task puts its own records together. Records that lie across splits leave their parts,
which are few, to be joined.

A quote opens a field only where a field begins, and a doubled one inside is a character. Lines end with ``\\n`` or ``\\r\\n``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from martkit.session import scratch_path

#: Beyond so many splits that begin inside a field they are no longer sent to all tasks.
MOST_OPEN = 100_000
_FIRST_READ = 1 << 16

_CLOSED = r'[^"]*+(?:""[^"]*+)*+'
#: From a field's beginning: whole fields, then a quote that no other closes.
_OPENS = re.compile(rf'(?:(?:"{_CLOSED}"[^,]*+|[^",][^,]*+)?+,)*+"{_CLOSED}$')
_CLOSES = re.compile(rf'{_CLOSED}"[^,]*+')


def ends_inside(line: str, inside: bool = False) -> bool:
    """Whether a quoted field is open at the line's end."""
    if '"' not in line:
        return inside
    at = 0
    if inside:
        closing = _CLOSES.match(line)
        if not closing:
            return True
        at = closing.end() + 1
        if at > len(line):
            return False
    return _OPENS.match(line, at) is not None


def _parts(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Slices whose rows come from one split."""
    n = batch.num_rows
    if not n:
        return
    path, start = batch.column("path"), batch.column("start")
    if start[0] == start[n - 1] and path[0] == path[n - 1] and pc.all(pc.equal(start, start[0])).as_py() and pc.all(pc.equal(path, path[0])).as_py():
        yield batch
        return
    keys = list(zip(path.to_pylist(), start.to_pylist()))
    edges = [0, *(k for k in range(1, n) if keys[k] != keys[k - 1]), n]
    for a, b in zip(edges, edges[1:]):
        yield batch.slice(a, b - a)


ENDS = "path string, start long, from_outside boolean, from_inside boolean"


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    key, outside, inside = None, False, True

    def row():
        columns = [pa.array([x], k) for x, k in zip((*key, outside, inside), (pa.string(), pa.int64(), pa.bool_(), pa.bool_()))]
        return pa.RecordBatch.from_arrays(columns, names=["path", "start", "from_outside", "from_inside"])

    for batch in batches:
        for part in _parts(batch):
            now = (part.column("path")[0].as_py(), part.column("start")[0].as_py())
            if now != key:
                if key is not None:
                    yield row()
                key, outside, inside = now, False, True
            value = part.column("value")
            for line in value.filter(pc.match_substring(value, '"')).to_pylist():
                same = outside == inside
                outside = ends_inside(line, outside)
                inside = outside if same else ends_inside(line, inside)
    if key is not None:
        yield row()


def _lines(spark: SparkSession, files: Sequence[str]) -> DataFrame:
    lines = spark.read.option("lineSep", "\n").text(list(files))
    return lines.select("value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_name").alias("name"), F.col("_metadata.file_block_start").alias("start"), F.col("_metadata.file_size").alias("size"))


def _bytes(spark: SparkSession, key: str) -> int:
    """A size setting, however it is written."""
    return spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(key))


def open_splits(spark: SparkSession, lines: DataFrame) -> DataFrame:
    """``path, start`` of the splits that begin inside a quoted field. Files too small to be split are not read for this."""
    least = min(_bytes(spark, "spark.sql.files.maxPartitionBytes"), _bytes(spark, "spark.sql.files.openCostInBytes"))
    found = lines.where(F.col("size") > least).select("value", "path", "start").mapInArrow(_ends, ENDS)
    path = scratch_path(spark, "split-ends")
    found.write.parquet(path)
    by = Window.partitionBy("path").orderBy("start")
    before = by.rowsBetween(Window.unboundedPreceding, -1)
    swaps = F.sum((F.col("from_outside") & ~F.col("from_inside")).cast("int"))
    ends = spark.read.schema(ENDS).parquet(path).withColumn("swaps", swaps.over(by.rowsBetween(Window.unboundedPreceding, 0)))
    # the last split that ends the same way however it begins, and the splits since that turn the answer round
    sure = F.last(F.when(F.col("from_outside") == F.col("from_inside"), F.struct("from_outside", "swaps")), ignorenulls=True).over(before)
    ends = ends.withColumn("sure", sure).withColumn("swapped", F.coalesce(F.lag("swaps").over(by), F.lit(0)))
    turned = (F.col("swapped") - F.coalesce("sure.swaps", F.lit(0))) % 2 == 1
    return ends.where(F.coalesce("sure.from_outside", F.lit(False)) != turned).select("path", "start")


#: What a row is: a whole record, or a record's first, last or a middle part, or the first part of a header.
WHOLE, FIRST, LAST, MIDDLE, HEADER = range(5)
ASSEMBLED = "path string, name string, start long, record string, part int"


def _assemble(header: bool):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, name, pending, begun, skip = None, None, None, WHOLE, False

        def rows(records, part):
            n = len(records)
            columns = [pa.array([key[0]] * n, pa.string()), pa.array([name] * n, pa.string()), pa.array([key[1]] * n, pa.int64())]
            return pa.RecordBatch.from_arrays([*columns, records if isinstance(records, pa.Array) else pa.array(records, pa.string()), pa.array([part] * n, pa.int32())], names=["path", "name", "start", "record", "part"])

        def left():
            return rows(["\n".join(pending)], {WHOLE: FIRST, LAST: MIDDLE, HEADER: HEADER}[begun])

        for batch in batches:
            for part in _parts(batch):
                now = (part.column("path")[0].as_py(), part.column("start")[0].as_py())
                if now != key:
                    if pending:
                        yield left()
                    key, name = now, part.column("name")[0].as_py()
                    skip = header and key[1] == 0
                    pending, begun = ([], LAST) if part.column("inside")[0].as_py() else (None, WHOLE)
                value = part.column("value")
                if pending is None and not pc.any(pc.match_substring(value, '"')).as_py():
                    ready = pc.utf8_rtrim(value, "\r")
                    ready = ready.filter(pc.not_equal(ready, ""))
                    if skip and len(ready):
                        ready, skip = ready.slice(1), False
                    yield rows(ready, WHOLE)
                    continue
                done = []
                for line in value.to_pylist():
                    if pending is None:
                        if ends_inside(line):
                            pending, begun = [line], HEADER if skip else WHOLE
                            skip = False
                        elif line.rstrip("\r"):
                            if skip:
                                skip = False
                            else:
                                done.append(line.rstrip("\r"))
                        continue
                    pending.append(line)
                    if not ends_inside(line, True):
                        record = "\n".join(pending).rstrip("\r")
                        if begun == LAST:
                            yield rows([record], LAST)
                        elif begun == WHOLE:
                            done.append(record)
                        pending = None
                if done:
                    yield rows(done, WHOLE)
        if pending:
            yield left()

    return work


def read_records(spark: SparkSession, files: Sequence[str], header: bool = True) -> DataFrame:
    """``path, name, record``: each record of the files as text, their first ones left out as ``header`` says.

    A pass over the files of more than one split finds those that begin inside a field; mostly there are none, and the
    records come from one further pass. Else the parts of records across splits are read from the files concerned alone.
    """
    lines = _lines(spark, files)
    path = scratch_path(spark, "open-splits")
    open_splits(spark, lines).write.parquet(path)
    begins_inside = spark.read.schema("path string, start long").parquet(path)
    n = begins_inside.count()
    if not n:
        whole = lines.withColumn("inside", F.lit(False)).select("value", "path", "name", "start", "inside").mapInArrow(_assemble(header), ASSEMBLED)
        return whole.where(F.col("part") == WHOLE).select("path", "name", "record")
    marked = begins_inside.withColumn("inside", F.lit(True))
    if n <= MOST_OPEN:  # the lines keep their order where the other side is sent to them
        lines = lines.join(F.broadcast(marked), ["path", "start"], "left")
    else:
        lines = lines.withColumn("at", F.monotonically_increasing_id()).join(marked, ["path", "start"], "left")
        lines = lines.repartition("path", "start").sortWithinPartitions("path", "start", "at")
    lines = lines.withColumn("inside", F.coalesce("inside", F.lit(False)))
    columns = ["value", "path", "name", "start", "inside"]
    whole = lines.select(columns).mapInArrow(_assemble(header), ASSEMBLED).where(F.col("part") == WHOLE)
    concerned = lines.join(F.broadcast(begins_inside.select("path").distinct()), "path", "left_semi") if n <= MOST_OPEN else lines
    parts = concerned.select(columns).mapInArrow(_assemble(header), ASSEMBLED).where(F.col("part") != WHOLE)
    begun = F.sum(F.col("part").isin(FIRST, HEADER).cast("int")).over(Window.partitionBy("path").orderBy("start", F.desc(F.col("part") == LAST)))
    joined = parts.withColumn("k", begun).groupBy("path", "name", "k").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("start", "record"))), lambda p: p["record"]), "\n").alias("record"), F.max(F.col("part") == HEADER).alias("header")
    )
    return whole.select("path", "name", "record").unionByName(joined.where("NOT header").select("path", "name", "record"))


def read_csv(spark: SparkSession, files: Sequence[str], schema: str, header: bool = True) -> DataFrame:
    """Struct ``r`` of the declared columns for each record, and the ``name`` of its file."""
    options = {"escape": '"', "multiLine": "true", "mode": "PERMISSIVE"}
    return read_records(spark, files, header).select(F.from_csv("record", schema, options).alias("r"), "name")


def first_records(spark: SparkSession, paths: Sequence[str]) -> list[tuple[str, str]]:
    """(path, first record) of every file that holds one: a short read of each file's beginning through its own file system,
    without a Spark job."""
    listed = spark.read.text(list(paths)).inputFiles()
    jvm, settings = spark._jvm, spark._jsc.hadoopConfiguration()

    def first(uri: str) -> tuple[str, str | None]:
        path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(uri))
        codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(settings).getCodec(path)
        raw = path.getFileSystem(settings).open(path)
        stream = codec.createInputStream(raw) if codec else raw
        try:
            data = b""
            while True:
                more = stream.readNBytes(max(_FIRST_READ, len(data)))
                data += more
                text = data.decode("utf-8-sig", "replace")
                lines = text.split("\n")
                record, inside = [], False
                for line in lines if not more else lines[:-1]:
                    if not record and not line.strip("\r"):
                        continue
                    record.append(line)
                    inside = ends_inside(line, inside)
                    if not inside:
                        return path.toString(), "\n".join(record).rstrip("\r")
                if not more:
                    return path.toString(), "\n".join(record).rstrip("\r") if record else None
        finally:
            stream.close()

    with ThreadPoolExecutor(16) as pool:
        return [(path, line) for path, line in pool.map(first, sorted(listed)) if line is not None]
