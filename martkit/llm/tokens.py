"""Token counts with a digest cache, and the encoders that tasks use.

The cache maps (digest of the tokenizer, digest of the normalised content) to a count. Only distinct contents that it lacks
are encoded, and appended. Byte-level tokenizers see every byte, so their normalised content is the text itself.

Cases: null texts count as empty (no bytes, no tokens). Repeated rows and texts are encoded once and each get their count.
An empty table gives an empty result and an empty cache. Clashing extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import re
import struct
from collections.abc import Callable
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martkit.llm.common import chunks_of, id_text, remembered, stage

CACHE = "digest binary, n_tokens long"
OFTEN = 1000

_LETTERS = "A-Za-zÀ-ÖØ-öø-ɏ"
#: Before a space that follows a printable character: no run of white space is cut.
_CUT = re.compile("(?<=[!-~])(?= )")
#: Texts of these characters alone fall into words by the plain pattern below just as by the public one with Unicode classes.
_SIMPLE = re.compile(f"[\\n !-~{_LETTERS}]+")
_WORDS = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTERS}]+| ?[0-9]+| ?[^\\s0-9{_LETTERS}]+|\\s+(?!\\S)|\\s+")


#: Characters of plain texts, and pieces, that are worked on at once.
AT_ONCE = 4 << 20

# kinds of bytes in plain texts, white space last
_LETTER, _DIGIT, _MARK, _APOSTROPHE, _SPACE, _LINE = range(6)
_KINDS = np.array([_LETTER if b >= 128 or chr(b).isalpha() else _DIGIT if chr(b).isdigit() else {32: _SPACE, 10: _LINE, 39: _APOSTROPHE}.get(b, _MARK) for b in range(256)], np.uint8)
#: Whether a word begins at a byte of the second kind that follows one of the first.
_BEGINS = np.array([[a < _SPACE and (b >= _SPACE or (a != _APOSTROPHE and a != b and (a, b) != (_MARK, _APOSTROPHE))) for b in range(6)] for a in range(6)])


class _Memo(dict):
    def __init__(self, work: Callable[[str], bytes]):
        super().__init__()
        self.work = work

    def __missing__(self, key):
        value = self[key] = self.work(key)
        return value


class _Lately:
    """Ids of the pieces met lately, in arrays: beyond ``most`` pieces, the half that was met last stays."""

    def __init__(self, work: Callable[[str], bytes], most: int):
        self.work, self.most, self.now = work, most, 0
        self.pieces = pa.array([], pa.large_string())
        self.ids, self.sizes, self.met = np.zeros(0, "<u4"), np.zeros(0, np.int32), np.zeros(0, np.int32)

    def places(self, pieces: pa.Array) -> np.ndarray:
        """Where each of some distinct pieces stands here; those that are new are worked out and added."""
        self._forget()
        place = pc.index_in(pieces, value_set=self.pieces).fill_null(-1).to_numpy().copy()
        new = place < 0
        if new.any():
            added = pieces.filter(pa.array(new))
            ids = [self.work(p) for p in added.to_pylist()]
            place[new] = np.arange(len(self.pieces), len(self.pieces) + len(ids))
            self.pieces = pa.concat_arrays([self.pieces, added])
            self.ids = np.concatenate([self.ids, np.frombuffer(b"".join(ids), "<u4")])
            self.sizes = np.concatenate([self.sizes, np.array([len(x) // 4 for x in ids], np.int32)])
            self.met = np.concatenate([self.met, np.zeros(len(ids), np.int32)])
        self.now += 1
        self.met[place] = self.now
        return place

    def _forget(self) -> None:
        if len(self.pieces) <= self.most:
            return
        stay = np.sort(np.argsort(self.met, kind="stable")[-(self.most // 2) :])
        kept = np.zeros(len(self.pieces), bool)
        kept[stay] = True
        self.ids = self.ids[np.repeat(kept, self.sizes)]
        self.pieces, self.sizes, self.met = self.pieces.take(pa.array(stay)), self.sizes[stay], self.met[stay]

    def dealt(self, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the pieces at ``place`` one after the other, and how many each piece has."""
        size = self.sizes[place]
        before = np.cumsum(size, dtype=np.int64) - size
        firsts = np.cumsum(self.sizes, dtype=np.int64) - self.sizes
        # each id lies as far behind its piece's first one here as it does in the result
        return self.ids[np.arange(size.sum()) + np.repeat(firsts[place] - before, size)], size


@lru_cache(256)
def _packer(n: int) -> Callable[..., bytes]:
    return struct.Struct(f"<{n}I").pack


class Encoder:
    """Token ids of whole texts as the library of the file's kind gives them: ``tokenizers`` for .json, ``sentencepiece`` for
    .model, without added special tokens, truncation or padding.

    A byte-level vocabulary with the usual word pattern merges within words alone. Texts of plain characters are cut into
    words here, many texts at once, and the library's model encodes each distinct word once (up to ``most`` are remembered).
    Other texts are cut at spaces that follow printable characters, which no word crosses, and what is not plain goes to the
    library whole.
    """

    def __init__(self, path: str, most: int = 400_000):
        self.most = most
        self.by_piece = False
        if path.endswith(".model"):
            import sentencepiece

            library = sentencepiece.SentencePieceProcessor(model_file=path)
            self._whole = lambda texts: library.encode(texts, num_threads=1)
        else:
            from tokenizers import Tokenizer

            self.library = library = Tokenizer.from_file(path)
            library.no_truncation()
            library.no_padding()
            self._whole = lambda texts: [e.ids for e in library.encode_batch_fast(texts, add_special_tokens=False)]
            about = json.loads(library.to_str())
            self.special = [t["content"] for t in about["added_tokens"]]
            words = about["pre_tokenizer"] or {}
            self.by_piece = (
                about["normalizer"] is None and words.get("type") == "ByteLevel" and not words["add_prefix_space"] and words["use_regex"]
                and about["model"]["type"] == "BPE" and not about["model"]["dropout"] and not about["model"]["ignore_merges"]
                and not any(t["lstrip"] or t["rstrip"] or t["single_word"] or " " in t["content"] for t in about["added_tokens"])
            )
        if self.by_piece:
            self.model = library.model
            self.bytes_of = _byte_letters()
            self.words = _Memo(self._word)
            self.lately = _Lately(self._piece, most)
            self.marks = re.compile("|".join(map(re.escape, self.special)) or r"(?!)")

    def _word(self, word: str) -> bytes:
        if word.isascii():  # of the plain characters only these two do not stand for themselves
            letters = word.replace(" ", self.bytes_of[32]).replace("\n", self.bytes_of[10])
        else:
            letters = "".join(map(self.bytes_of.__getitem__, word.encode()))
        ids = [t.id for t in self.model.tokenize(letters)]
        return _packer(len(ids))(*ids)

    def _piece(self, piece: str) -> bytes:
        """Of one or more words of plain characters."""
        found = _WORDS.findall(piece)
        return b"".join(map(self._word, found))

    def _other(self, text: str) -> bytes:
        """Of a text that is not plain, or has a special string."""
        out = []
        for piece in _CUT.split(text):
            if self._is_plain(piece):
                out += map(self.words.__getitem__, _WORDS.findall(piece))
            elif piece:
                out.append(np.array(self._whole([piece])[0], "<u4").tobytes())
        return b"".join(out)

    def _is_plain(self, text: str) -> bool:
        return bool(_SIMPLE.fullmatch(text)) and not self.marks.search(text)

    def _plain(self, texts: list[str]) -> list[bytes]:
        """Of texts of plain characters: cut all at once, each distinct piece is looked up once and its ids are dealt out."""
        raw = [t.encode() for t in texts]
        data = np.frombuffer(b"".join(raw), np.uint8)
        ends = np.cumsum([len(r) for r in raw])
        begins = _piece_starts(data, ends[:-1])
        bounds = np.append(begins, len(data)).astype(np.int64)
        every = pa.LargeStringArray.from_buffers(len(begins), pa.py_buffer(bounds), pa.py_buffer(data))
        ids, sizes = [], []
        for at in range(0, len(every), AT_ONCE):  # one round, but for very long texts
            pieces = every.slice(at, AT_ONCE).dictionary_encode()
            some, size = self.lately.dealt(self.lately.places(pieces.dictionary)[pieces.indices.to_numpy()])
            ids.append(some.tobytes())
            sizes.append(size)
        stops = (4 * np.cumsum(np.concatenate(sizes), dtype=np.int64)[np.searchsorted(begins, ends) - 1]).tolist()
        joined = b"".join(ids)
        return [joined[a:b] for a, b in zip([0, *stops], stops)]

    def ids(self, texts: list[str]) -> list[bytes]:
        """For each text its ids as little-endian unsigned 32-bit integers."""
        if not self.by_piece:
            return [np.array(x, "<u4").tobytes() for x in self._whole(texts)]
        out: list[bytes] = [b""] * len(texts)
        plain, size = [], 0
        for k, text in enumerate(texts):
            if not self._is_plain(text):  # nor is an empty one
                if len(self.words) > self.most:
                    self.words.clear()
                out[k] = self._other(text)
                continue
            plain.append(k)
            size += len(text)
            if size >= AT_ONCE:
                self._deal(texts, plain, out)
                plain, size = [], 0
        if plain:
            self._deal(texts, plain, out)
        return out

    def _deal(self, texts: list[str], plain: list[int], out: list[bytes]) -> None:
        for k, ids in zip(plain, self._plain([texts[k] for k in plain])):
            out[k] = ids


def _piece_starts(data: np.ndarray, texts: np.ndarray) -> np.ndarray:
    """Places in the bytes of plain texts, which begin at 0 and at ``texts``, where a word surely begins, nearly all that do.

    Kinds of characters: letters (all bytes beyond ASCII are parts of such), digits, spaces, line ends, apostrophes and other
    marks. A word begins where a letter, digit or mark is followed by one of another kind, or by white space; not so after an
    apostrophe, which may begin an ending. White space of more than one character stays with what follows it.
    """
    kind = _KINDS[data]
    starts = np.zeros(len(data), bool)
    starts[1:] = _BEGINS[kind[:-1], kind[1:]]
    # a line end alone is a word; what follows more white space is not cut off
    line = np.flatnonzero(kind[1:-1] == _LINE) + 1
    starts[line + 1] = (kind[line - 1] < _SPACE) & (kind[line + 1] < _SPACE)
    starts[0] = True
    starts[texts] = True
    return np.flatnonzero(starts)


def _byte_letters() -> list[str]:
    """The public byte-level alphabet: printable bytes stand for themselves, the others for letters from U+0100 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    free = iter(range(0x100, 0x200))
    return [chr(b) if b in own else chr(next(free)) for b in range(256)]


def encoder(path: str) -> Encoder:
    """One for each worker process: what it remembers serves later tasks, too."""
    kept = remembered("tokens")
    return kept.get(path) or kept.setdefault(path, Encoder(path))


def tokenizer_digest(path: str) -> str:
    """Of the file and of the library's version: counts of another version are other counts."""
    import sentencepiece
    import tokenizers

    version = sentencepiece.__version__ if path.endswith(".model") else tokenizers.__version__
    with open(path, "rb") as file:
        return hashlib.sha256(version.encode() + b"\0" + file.read()).hexdigest()[:32]


def content_digest(text: Column) -> Column:
    return F.unhex(F.sha2(text.cast("binary"), 256))


def read_cache(spark, path: str) -> DataFrame:
    """The cache; two runs at once may both have added a content, which counts once."""
    return spark.read.schema(CACHE).parquet(path).groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))


def count(docs: DataFrame, tokenizer: str, cache: str, id_col: str = "doc_id", text_col: str = "text", normalise: Callable[[Column], Column] = lambda c: c) -> DataFrame:
    """``doc_id, digest, n_bytes, n_tokens`` for each row; ``cache``, a folder in a store that all executors reach, grows by
    what was new. ``normalise`` must not change what the tokenizer gives."""
    spark = docs.sparkSession
    folder = f"{cache.rstrip('/')}/tokenizer={tokenizer_digest(tokenizer)}"
    spark.createDataFrame([], CACHE).write.mode("append").parquet(folder)
    texts = id_text(docs, id_col, text_col)
    keyed = texts.withColumn("content", normalise(F.col("text"))).withColumn("digest", content_digest(F.col("content")))
    # one text for each digest leaves each task, however often it occurs there
    single = keyed.groupBy("digest").agg(F.first("content").alias("text"))
    misses = single.join(read_cache(spark, folder), "digest", "left_anti")

    def encode(batches):
        for digests, found in chunks_of((b.rename_columns(["doc_id", "text"]) for b in batches)):
            known = encoder(tokenizer)  # one a worker, and none where nothing is missing
            yield pa.RecordBatch.from_arrays([pa.array(digests, pa.binary()), pa.array([len(x) // 4 for x in known.ids(found)], pa.int64())], names=["digest", "n_tokens"])

    misses.select("digest", "text").mapInArrow(encode, CACHE).write.mode("append").parquet(folder)
    rows = stage(keyed.select("doc_id", "digest", F.octet_length("text").cast("long").alias("n_bytes")), "token-rows")
    # no more than OFTEN contents can each make up one row in OFTEN; their counts are sent to the rows, which else would all
    # meet in one task
    often = rows.groupBy("digest").agg(F.count("*").alias("rows")).where(F.col("rows") * OFTEN >= rows.count()).where("rows > 1")
    sent = stage(read_cache(spark, folder).join(F.broadcast(often), "digest").select("digest", F.col("n_tokens").alias("sent")), "token-often")
    marked = rows.join(F.broadcast(sent), "digest", "left")
    rest = marked.where("sent IS NULL").join(read_cache(spark, folder), "digest", "left")
    return rest.drop("sent").unionByName(marked.where("sent IS NOT NULL").withColumnRenamed("sent", "n_tokens"))
