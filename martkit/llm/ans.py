"""Token-id files coded with a static range asymmetric numeral system (rANS).

Ids are written in ascending order of documents, in shards of some million ids. A shard has one frequency table for all its
blocks; a block is coded on its own by interleaved lanes, and its entry - first id, place in the word stream, lane states,
checksum of its ids - is a checkpoint from which it can be decoded without the others. Files are Parquet with one shard to a
row, so any store that Spark writes to will do; the shard itself is a binary blob with the layout below.

    shard blob: magic, lanes, block size, number of ids, number of blocks, number of symbols (u32 each)
                symbols (u32), frequencies (u32; they add up to 2**20), first word of each block (u32),
                checksum of each block (u32), lane states (u64, blocks x lanes), words (u32)

Cases: null texts count as empty: an end id alone. A null id sorts first. Rows with equal ids are ordered by text; equal
rows are interchangeable. An empty table gives no shards. Clashing extra columns are ignored. A text longer than a shard
gets a shard as long as itself; memory is bounded by the longest text.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martkit.llm.common import chunks_of, id_text
from martkit.llm.tokens import encoder

MAGIC = 0x534E4152
BITS = 20
LANES = 64
BLOCK = 1 << 15
SHARD = 1 << 20
_LOW = 1 << 31
_HEAD = "<6I"

SHARDS = "part int, shard int, n_ids long, doc_ids array<long>, lengths array<long>, data binary"
IDS = "doc_id long, part int, shard int, first long, n_tokens long, ids_crc32 long"


class DamagedBlock(ValueError):
    """A block's ids do not have the checksum written with them."""


def frequencies(counts: np.ndarray) -> np.ndarray:
    """Counts scaled to add up to 2**BITS, each at least 1; the largest ones take up what rounding leaves."""
    if len(counts) > 1 << BITS:
        raise ValueError(f"more than {1 << BITS} different ids in a shard")
    freq = np.maximum(1, counts * (1 << BITS) // counts.sum()).astype(np.int64)
    over = int(freq.sum()) - (1 << BITS)
    by_size = np.argsort(-freq, kind="stable")
    if over < 0:
        freq[by_size[0]] -= over
    for k in by_size:
        if over <= 0:
            break
        cut = min(over, int(freq[k]) - 1)
        freq[k] -= cut
        over -= cut
    return freq


def _symbols(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct ids in order, place of each id among them, counts): by counting where ids are those of a vocabulary, else by
    sorting."""
    if not len(ids) or int(ids.max()) >= 1 << 22:
        return np.unique(ids, return_inverse=True, return_counts=True)
    every = np.bincount(ids)
    symbols = np.flatnonzero(every)
    place = np.zeros(len(every), np.int64)
    place[symbols] = np.arange(len(symbols))
    return symbols.astype(ids.dtype), place[ids], every[symbols]


def encode(ids: np.ndarray, lanes: int = LANES, block: int = BLOCK) -> bytes:
    """A shard blob. All blocks advance together, one id for each lane at a time, so each step works on a whole matrix."""
    symbols, code, counts = _symbols(ids)
    blocks = -(-len(ids) // block)
    steps = -(-block // lanes)
    if not blocks:
        return struct.pack(_HEAD, MAGIC, lanes, block, 0, 0, 0)
    freq = frequencies(counts.astype(np.int64)).astype(np.uint64)
    start = (np.cumsum(freq) - freq).astype(np.uint64)
    grid = np.full(blocks * steps * lanes, -1, np.int64).reshape(blocks, steps * lanes)
    for b in range(blocks):
        part = code[b * block : (b + 1) * block]
        grid[b, : len(part)] = part
    grid = grid.reshape(blocks, steps, lanes)
    state = np.full((blocks, lanes), _LOW, np.uint64)
    sent, masks = [], []
    top = np.uint64(63 - BITS)
    full = len(ids) // block  # blocks without empty places
    for s in range(steps - 1, -1, -1):
        at = grid[:, s]
        f = freq[at]
        c = start[at]
        spill = state >= (f << top)
        last = full < blocks and at[-1, -1] < 0
        if last:
            spill[-1] &= at[-1] >= 0
        masks.append(spill)
        sent.append((state[spill] & np.uint64(0xFFFFFFFF)).astype(np.uint32))
        moved = np.where(spill, state >> np.uint64(32), state)
        q = moved // f
        after = (q << np.uint64(BITS)) + (moved - q * f) + c
        if last:
            after[-1] = np.where(at[-1] >= 0, after[-1], state[-1])
        state = after
    # the decoder goes forward: steps in order and lanes in order, each block's words together
    masks = np.stack(masks[::-1])
    words = np.concatenate(sent[::-1])
    owner = np.nonzero(masks)[1]
    # small numbers are sorted by their digits
    words = words[np.argsort(owner.astype(np.uint16) if blocks <= 1 << 16 else owner, kind="stable")]
    per_block = np.bincount(owner, minlength=blocks)
    first = (np.cumsum(per_block) - per_block).astype("<u4")
    little = ids.astype("<u4")
    sums = np.array([zlib.crc32(little[b * block : (b + 1) * block]) for b in range(blocks)], "<u4")
    head = struct.pack(_HEAD, MAGIC, lanes, block, len(ids), blocks, len(symbols))
    return b"".join([head, symbols.astype("<u4").tobytes(), freq.astype("<u4").tobytes(), first.tobytes(), sums.tobytes(), state.astype("<u8").tobytes(), words.astype("<u4").tobytes()])


def decode(blob: bytes, only: range | None = None) -> np.ndarray:
    """The ids of a shard, or those of some of its blocks, from their checkpoints. Checksums are verified."""
    magic, lanes, block, n, blocks, size = struct.unpack_from(_HEAD, blob)
    if magic != MAGIC:
        raise DamagedBlock("not a shard of token ids")
    if not blocks:
        return np.zeros(0, np.uint32)
    take, at = [], struct.calcsize(_HEAD)
    for kind, count in (("<u4", size), ("<u4", size), ("<u4", blocks), ("<u4", blocks), ("<u8", blocks * lanes)):
        take.append(np.frombuffer(blob, kind, count, at))
        at += take[-1].nbytes
    symbols, freq, first, sums, state = take
    words = np.frombuffer(blob, "<u4", offset=at).astype(np.uint64)
    only = only if only is not None else range(blocks)
    if not len(only):
        return np.zeros(0, np.uint32)
    rows = slice(only.start, only.stop)
    state = state.reshape(blocks, lanes)[rows].astype(np.uint64)
    place = first[rows].astype(np.int64)[:, None]
    freq = freq.astype(np.uint64)
    begin = np.cumsum(freq) - freq
    slot = np.repeat(np.arange(size, dtype=np.int32), freq.astype(np.int64))  # which symbol each of the 2**BITS slots is
    steps = -(-block // lanes)
    out = np.empty((len(only), steps, lanes), np.int32)
    mask = np.uint64((1 << BITS) - 1)
    words = np.append(words, np.uint64(0))
    end = len(words) - 1
    for s in range(steps):
        low = state & mask
        code = slot[low]
        out[:, s] = code
        state = freq[code] * (state >> np.uint64(BITS)) + low - begin[code]
        more = state < np.uint64(_LOW)
        turn = np.cumsum(more, axis=1)
        # a short last block reads on past its end here; what that gives is cut off below
        word = words[np.minimum(place + turn - 1, end)]
        state = np.where(more, (state << np.uint64(32)) | word, state)
        place = place + turn[:, -1:]
    codes = out.reshape(len(only), steps * lanes)[:, :block].reshape(-1)
    ids = symbols[codes[: min(n, only.stop * block) - only.start * block]].astype(np.uint32)
    for k, b in enumerate(only):
        if zlib.crc32(ids[k * block : (k + 1) * block].astype("<u4")) != sums[b]:
            raise DamagedBlock(f"block {b} of a shard fails its checksum")
    return ids


def _write_partition(tokenizer: str, end_id: int, shard_ids: int):
    def work(batches):
        from pyspark import TaskContext

        part, shard = TaskContext.get().partitionId(), 0
        known = encoder(tokenizer)
        docs, lengths, held, size = [], [], [], 0
        end = np.array([end_id], "<u4").tobytes()

        def close():
            nonlocal shard, docs, lengths, held, size
            ids = np.frombuffer(b"".join(held), "<u4")
            columns = ([part], [shard], [len(ids)], [docs], [lengths], [encode(ids)])
            shard, docs, lengths, held, size = shard + 1, [], [], [], 0
            kinds = (pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["part", "shard", "n_ids", "doc_ids", "lengths", "data"])

        for names, texts in chunks_of(batches):
            for i, ids in zip(names, known.ids(texts)):
                docs.append(i)
                lengths.append(len(ids) // 4 + 1)
                held += (ids, end)
                size += lengths[-1]
                if size >= shard_ids:
                    yield close()
        if docs:
            yield close()

    return work


def write(docs: DataFrame, path: str, tokenizer: str, end_id: int, id_col: str = "doc_id", text_col: str = "text", shard_ids: int = SHARD, partitions: int | None = None, order: tuple[str, ...] = ()) -> None:
    """Token files of all documents in ascending order of ``order`` (else of ids), each followed by ``end_id``."""
    spark = docs.sparkSession
    keys = [f"_k{k}" for k in range(len(order))] + ["doc_id", "text"]
    rows = docs.select(*[F.col(f"`{c}`").alias(f"_k{k}") for k, c in enumerate(order)], F.col(f"`{id_col}`"), F.col(f"`{text_col}`"))
    texts = id_text(rows, id_col, text_col) if not order else rows.select(
        *keys[:-2], F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text")
    )
    by = keys[:-1]
    ranged = texts.repartitionByRange(partitions, *by) if partitions else texts.repartitionByRange(*by)
    ordered = ranged.sortWithinPartitions(*keys).select("doc_id", "text")
    coded = ordered.mapInArrow(_write_partition(tokenizer, end_id, shard_ids), SHARDS)
    # coded shards do not compress further; small row groups let many tasks read a file
    coded.write.option("parquet.block.size", 8 << 20).option("compression", "uncompressed").parquet(path)


def offsets(shards: DataFrame) -> DataFrame:
    """``part, shard, offset``: ids before each shard. Sums of parts first, so no task sees all shards."""
    parts = shards.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = parts.select(F.col("part").alias("_part"), F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    own = Window.partitionBy("part").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    inside = shards.select("part", "shard", F.coalesce(F.sum("n_ids").over(own), F.lit(0)).alias("inside"))
    return inside.join(before, F.col("part") == F.col("_part")).select("part", "shard", (F.col("before") + F.col("inside")).alias("offset"))


def _read_shards(batches):
    kinds = (pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
    names = ["doc_id", "part", "shard", "first", "n_tokens", "ids_crc32"]
    for b in batches:
        for at in range(b.num_rows):
            row = b.slice(at, 1).to_pylist()[0]
            ids = decode(row["data"]).astype("<u4")
            sizes = np.array(row["lengths"], np.int64)
            first = np.cumsum(sizes) - sizes
            sums = [zlib.crc32(ids[a : a + n]) for a, n in zip(first.tolist(), row["lengths"])]
            n = len(sizes)
            columns = (row["doc_ids"], [row["part"]] * n, [row["shard"]] * n, first, sizes, sums)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)


def read(spark, path: str) -> DataFrame:
    """Shard rows as written."""
    return spark.read.schema(SHARDS).parquet(path)


def decoded(shards: DataFrame) -> DataFrame:
    """Per document, from its decoded ids: where it starts among all ids, how many it has, and their checksum."""
    found = shards.mapInArrow(_read_shards, IDS)
    place = offsets(shards.select("part", "shard", "n_ids"))
    return found.join(place, ["part", "shard"]).select("doc_id", (F.col("offset") + F.col("first")).alias("start"), "n_tokens", "ids_crc32")
