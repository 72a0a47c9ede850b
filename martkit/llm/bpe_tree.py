"""Byte-level BPE as a monoid: texts are encoded by halves, and neighbours are joined at their boundary alone.

A text is cut in halves down to leaves of a few thousand characters, wherever the cuts fall. A segment's value is its list
of words (matches of the public pattern) with their ids. Two neighbours are joined in two layers:

* Words. The left ones that have fewer than ``LOOK`` characters after them may still change, all others not: a match looks no
  further ahead. From there words are matched anew in a window that grows into the right segment until a match starts where
  one of the right segment's does; the pattern never looks back, so all that follows stays.
* Ids within a word that both sides share. Ids around the boundary are encoded anew, in a window that doubles until the id
  before it fits the window's first and the window's last fits the id after it. Two ids fit if the bytes of the pair encode
  to the pair. A sequence of ids whose neighbours all fit is the encoding of its bytes: while no merge has crossed a border of
  ids, the merges inside a pair run as if the pair stood alone, so the first one to cross would do so there, too.

A word that is an entry of the vocabulary is that id, whatever the merges give. Decoding concatenates the ids' bytes in
blocks, and the blocks up a tree.

Cases: null texts count as empty and have no ids. Repeated rows are encoded each. Long words (a run of letters without a
space) are encoded through the tree like long texts. An empty table gives an empty result; clashing extra columns are
ignored. Ids outside the vocabulary are an error when decoded. A task holds a batch of texts and a bounded memory of words.
"""

from __future__ import annotations

import base64
import heapq
import re
from collections.abc import Callable

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martkit.llm.common import chunks_of, id_text, need, remembered
from martkit.llm.tokens import _SIMPLE, _WORDS

#: Characters of a leaf; ids that are decoded at once.
LEAF, BLOCK = 2048, 4096
#: How far a match of the pattern may look beyond its end: the two letters after an apostrophe, or the last character of a
#: run of white space and the one behind it.
LOOK = 2
ENCODED = "doc_id long, n_tokens long, ids binary"
DECODED = "doc_id long, n_tokens long, ids binary, decoded binary"


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as file:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}


def _as_characters(found: list[str]) -> str:
    return "[" + "".join(f"\\U{ord(c):08x}" for c in found) + "]"


def newer_characters() -> str:
    """Letters and numbers that ``regex`` knows and the library, of an earlier Unicode, does not: to it they are signs."""
    import tiktoken

    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    single = {bytes([k]): k for k in range(256)}
    library = tiktoken.Encoding("classes", pat_str=r"[\p{L}\p{N}]+", mergeable_ranks=single, special_tokens={})
    theirs = set(bytes(library.encode_ordinary(every)).decode())
    return "".join(c for c in regex.findall(r"[\p{L}\p{N}]", every) if c not in theirs)


class Tree:
    """Encoder and decoder of one vocabulary of ranks; ``most`` words are remembered."""

    def __init__(self, ranks: dict[bytes, int], leaf: int = LEAF, most: int = 400_000):
        self.ranks, self.leaf, self.most = ranks, max(leaf, 2), most
        self.bytes_of = {v: k for k, v in ranks.items()}
        #: Longer words are no entry of the vocabulary; their ids are joined, not looked up.
        self.short = max(64, *map(len, ranks))
        self.known: dict[str, tuple[int, ...]] = {}
        self.fitting: dict[tuple[int, int], bool] = {}
        self.pattern = regex.compile(public_tokenizers.PATTERN)
        self.newer = None

    # ids of bytes

    def merge(self, data: bytes) -> list[int]:
        """The merges alone: always the pair of lowest rank, of equal ones the leftmost."""
        if len(data) > 128:
            return self._merge_long(data)
        rank = self.ranks.get
        parts = [data[k : k + 1] for k in range(len(data))]
        pairs = [rank(a + b) for a, b in zip(parts, parts[1:])]
        while True:
            low, at = None, -1
            for k, r in enumerate(pairs):
                if r is not None and (low is None or r < low):
                    low, at = r, k
            if low is None:
                return [self.ranks[p] for p in parts]
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            del pairs[at]
            if at < len(pairs):
                pairs[at] = rank(parts[at] + parts[at + 1])
            if at:
                pairs[at - 1] = rank(parts[at - 1] + parts[at])

    def _merge_long(self, data: bytes) -> list[int]:
        """The same with a heap of (rank, place) over a linked list of parts."""
        rank, n = self.ranks.get, len(data)
        end, before = list(range(1, n + 1)), list(range(-1, n - 1))  # by start of a part; an end of 0 means merged away
        heap = [(r, k, k + 2) for k in range(n - 1) if (r := rank(data[k : k + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, k, to = heapq.heappop(heap)
            if not end[k] or end[k] >= to or end[end[k]] != to:
                continue  # one of the two parts has been merged since
            end[end[k]], end[k] = 0, to
            if to < n:
                before[to] = k
                if (r := rank(data[k : end[to]])) is not None:
                    heapq.heappush(heap, (r, k, end[to]))
            if (b := before[k]) >= 0 and (r := rank(data[b:to])) is not None:
                heapq.heappush(heap, (r, b, to))
        out, k = [], 0
        while k < n:
            out.append(self.ranks[data[k : end[k]]])
            k = end[k]
        return out

    def fits(self, a: int, b: int) -> bool:
        found = self.fitting.get((a, b))
        if found is None:
            if len(self.fitting) > self.most:
                self.fitting.clear()
            found = self.fitting[a, b] = self.merge(self.bytes_of[a] + self.bytes_of[b]) == [a, b]
        return found

    def join_ids(self, left: tuple[int, ...], right: tuple[int, ...]) -> tuple[int, ...]:
        """The encoding of the bytes of two encodings, worked out around their boundary."""
        if not left or not right:
            return left or right
        size = 1
        while True:
            i, j = max(len(left) - size, 0), min(size, len(right))
            window = self.merge(b"".join(map(self.bytes_of.__getitem__, left[i:] + right[:j])))
            if (not i or self.fits(left[i - 1], window[0])) and (j == len(right) or self.fits(window[-1], right[j])):
                return left[:i] + tuple(window) + right[j:]
            size *= 2

    def word(self, word: str) -> tuple[int, ...]:
        """Ids of a short word."""
        found = self.known.get(word)
        if found is None:
            if len(self.known) > self.most:
                self.known.clear()
            data = word.encode()
            whole = self.ranks.get(data)
            found = self.known[word] = tuple(self.merge(data)) if whole is None else (whole,)
        return found

    def long_word(self, word: str) -> tuple[int, ...]:
        """Ids of any word, by halves of its bytes."""
        data = word.encode()
        if len(data) <= self.short:
            return self.word(word)
        return self._halves(data, 0, len(data))

    def _halves(self, data: bytes, a: int, b: int) -> tuple[int, ...]:
        if b - a <= self.short:
            return tuple(self.merge(data[a:b]))
        middle = (a + b) // 2
        return self.join_ids(self._halves(data, a, middle), self._halves(data, middle, b))

    # words of texts

    def _words_of(self, text: str) -> Callable[[str], list[str]]:
        if _SIMPLE.fullmatch(text):
            return _WORDS.findall
        if self.newer is None:
            found = newer_characters()
            self.newer = (re.compile(_as_characters(found)) if found else re.compile("(?!)"))
        if not self.newer.search(text):
            return self.pattern.findall

        def find(part: str) -> list[str]:
            out, at = [], 0
            for seen in self.pattern.findall(self.newer.sub("�", part)):
                out.append(part[at : at + len(seen)])
                at += len(seen)
            return out

        return find

    def _leaf(self, text: str, find) -> tuple[list[str], list[tuple[int, ...]]]:
        words = find(text)
        known = self.known.get
        return words, [known(w) or self.long_word(w) for w in words]

    def _tree(self, text: str, a: int, b: int, find):
        if b - a <= self.leaf:
            return self._leaf(text[a:b], find)
        middle = (a + b) // 2
        return self.join(self._tree(text, a, middle, find), self._tree(text, middle, b, find), find)

    def join(self, left, right, find):
        """(words, ids of each) of two neighbouring segments."""
        words, ids = left
        tail, tail_ids, size = [], [], 0
        while words and size < LOOK:
            tail.append(words.pop())
            tail_ids.append(ids.pop())
            size += len(tail[-1])
        tail.reverse()
        tail_ids.reverse()
        more, more_ids = right
        take = min(2, len(more))
        while True:
            window = "".join(tail) + "".join(more[:take])
            starts, at = {}, size  # where the right segment's words start in the window
            for k in range(take):
                starts[at] = k
                at += len(more[k])
            starts[at] = take
            new, at, kept = [], 0, None
            for found in find(window):
                new.append(found)
                at += len(found)
                if at >= size and at in starts and (at <= len(window) - LOOK or take == len(more)):
                    kept = starts[at]
                    break
            if kept is not None:
                break
            take = min(2 * take, len(more))
        words += new
        ids += self._ids_of(new, tail + more[:kept], tail_ids + more_ids[:kept])
        words += more[kept:]
        ids += more_ids[kept:]
        return words, ids

    def _ids_of(self, new: list[str], parts: list[str], part_ids: list) -> list[tuple[int, ...]]:
        """Ids of the words of a window; a long one is joined from the ids of the whole parts that it covers."""
        out, at, edge, k = [], 0, 0, 0  # edge: where part k starts
        for word in new:
            to = at + len(word)
            if 4 * len(word) <= self.short:
                out.append(self.word(word))
                while k < len(parts) and edge + len(parts[k]) <= to:
                    edge += len(parts[k])
                    k += 1
                at = to
                continue
            if len(word.encode()) <= self.short:
                total = self.word(word)
            else:
                total, here = (), at
                while here < to:
                    while edge + len(parts[k]) <= here:
                        edge += len(parts[k])
                        k += 1
                    end = min(to, edge + len(parts[k]))
                    piece = parts[k][here - edge : end - edge]
                    data = piece.encode()
                    if len(data) <= self.short:  # its ids may be those of a vocabulary entry that no merge gives
                        own = tuple(self.merge(data))
                    else:
                        own = part_ids[k] if len(piece) == len(parts[k]) else self.long_word(piece)
                    total = self.join_ids(total, own)
                    here = end
            out.append(total)
            at = to
        return out

    def encode(self, text: str) -> bytes:
        """Ids of a whole text as little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        ids = self._tree(text, 0, len(text), self._words_of(text))[1]
        return np.fromiter((x for some in ids for x in some), "<u4").tobytes()

    def decode(self, ids: bytes) -> bytes:
        found = np.frombuffer(ids, "<u4").tolist()
        blocks = [b"".join(map(self.bytes_of.__getitem__, found[k : k + BLOCK])) for k in range(0, len(found), BLOCK)]
        while len(blocks) > 1:
            blocks = [b"".join(blocks[k : k + 2]) for k in range(0, len(blocks), 2)]
        return blocks[0] if blocks else b""


def tree(path: str, leaf: int = LEAF) -> Tree:
    """One for each worker process: what it remembers serves later tasks, too."""
    kept = remembered("trees")
    return kept.get((path, leaf)) or kept.setdefault((path, leaf), Tree(read_ranks(path), leaf))


def encode(docs: DataFrame, ranks: str, id_col: str = "doc_id", text_col: str = "text", leaf: int = LEAF) -> DataFrame:
    """``doc_id, n_tokens, ids`` of each row; ``ids`` are little-endian unsigned 32-bit integers."""

    def work(batches):
        known = tree(ranks, leaf)
        for found, texts in chunks_of(batches):
            ids = [known.encode(t) for t in texts]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64()), pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary())], names=["doc_id", "n_tokens", "ids"])

    return id_text(docs, id_col, text_col).mapInArrow(work, ENCODED)


def decode(encoded: DataFrame, ranks: str) -> DataFrame:
    """The rows of ``encode`` with the bytes that their ids stand for."""
    need(encoded, "doc_id", "n_tokens", "ids")

    def work(batches):
        known = tree(ranks)
        for b in batches:
            step = max(1, int(b.num_rows * (4 << 20) / max(1, b.nbytes)))
            for at in range(0, b.num_rows, step):
                some = b.slice(at, step)
                texts = pa.array([known.decode(x or b"") for x in some.column("ids").to_pylist()], pa.binary())
                yield pa.RecordBatch.from_arrays([*some.columns, texts], names=["doc_id", "n_tokens", "ids", "decoded"])

    return encoded.select(F.col("doc_id").cast("long"), F.col("n_tokens").cast("long"), "ids").mapInArrow(work, DECODED)
