"""Benchmark decontamination with a generalised suffix automaton over the words of all test items.

Training texts stream through the automaton; at each word it knows the longest run of words, ending there, that some item
has. Runs of ``window`` words, or whole shorter items, mark their words; marked spans are reported and cut out, and texts
with too large a marked share are dropped.

Cases: null, empty or wordless texts and items have no words, so nothing is hit. Items that repeat each count. With no items
nothing is hit. Null item ids are left out of the list of ids but their words count. Clashing extra columns are ignored by
``scan`` and kept by ``clean``.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martkit.llm.common import TO_LOWER, WORD, chunks_of, free_names, id_text, need, remembered, stage

_WORD = re.compile(WORD)

SCAN = (
    "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean, longest long, items array<string>, "
    "spans array<struct<first_word:int,last_word:int,start:int,end:int>>"
)


def words_of(text: str | None) -> list[str]:
    return _WORD.findall((text or "").translate(TO_LOWER))


@dataclass
class Automaton:
    """States of all substrings of all items; ``length`` and ``link`` as usual, ``items`` for states a window can end in."""

    vocabulary: dict[str, int]
    window: int
    step: list[dict[int, int]] = field(default_factory=lambda: [{}])
    length: list[int] = field(default_factory=lambda: [0])
    link: list[int] = field(default_factory=lambda: [-1])
    #: items that hold the state's strings as windows of full length
    items: dict[int, frozenset[str]] = field(default_factory=dict)
    #: state -> [(length, items)] of whole short items that end wherever the state's longest string does
    short: dict[int, list[tuple[int, frozenset[str]]]] = field(default_factory=dict)
    shortest: int = 0

    def _extend(self, last: int, word: int) -> int:
        """One more word of an item; the branch for a known transition is what makes it generalised."""
        step, length, link = self.step, self.length, self.link
        if word in step[last]:
            q = step[last][word]
            return q if length[q] == length[last] + 1 else self._clone(last, q, word)
        new = len(length)
        length.append(length[last] + 1)
        step.append({})
        link.append(0)
        p = last
        while p != -1 and word not in step[p]:
            step[p][word] = new
            p = link[p]
        if p != -1:
            q = step[p][word]
            link[new] = q if length[q] == length[p] + 1 else self._clone(p, q, word)
        return new

    def _clone(self, p: int, q: int, word: int) -> int:
        step, length, link = self.step, self.length, self.link
        copy = len(length)
        length.append(length[p] + 1)
        step.append(dict(step[q]))
        link.append(link[q])
        link[q] = copy
        while p != -1 and step[p].get(word) == q:
            step[p][word] = copy
            p = link[p]
        return copy

    @classmethod
    def build(cls, items: list[tuple[str | None, str | None]], window: int) -> Automaton:
        texts = [(i, words_of(t)) for i, t in items]
        texts = [(i, w) for i, w in texts if w]
        vocabulary: dict[str, int] = {}
        coded = [(i, [vocabulary.setdefault(x, len(vocabulary)) for x in w]) for i, w in texts]
        self = cls(vocabulary, window)
        for _, word_ids in coded:
            last = 0
            for x in word_ids:
                last = self._extend(last, x)
        held: dict[int, set[str]] = {}
        ends: dict[int, dict[int, set[str]]] = {}
        for i, word_ids in coded:
            name = set() if i is None else {str(i)}
            state = 0
            for x in word_ids:
                state = self.step[state][x]  # the whole prefix
                if self.length[state] >= window:
                    held.setdefault(self.at_length(state, window), set()).update(name)
            if len(word_ids) < window:
                ends.setdefault(self.at_length(state, len(word_ids)), {}).setdefault(len(word_ids), set()).update(name)
        self.items = {s: frozenset(n) for s, n in held.items()}
        for s in sorted(range(len(self.length)), key=self.length.__getitem__):  # links lead to shorter strings
            own = [(n, frozenset(x)) for n, x in ends.get(s, {}).items()]
            if found := self.short.get(self.link[s], []) + own:
                self.short[s] = found
        self.shortest = min([min(window, len(w)) for _, w in coded], default=0)
        return self

    def at_length(self, state: int, n: int) -> int:
        """The state of the last ``n`` words of ``state``'s longest string."""
        while state and self.length[self.link[state]] >= n:
            state = self.link[state]
        return state

    def matches(self, coded: list[int]) -> Iterator[tuple[int, int, int]]:
        """(position, state, longest matching length) for each word of a text; -1 codes a word that no item has."""
        step, length, link = self.step, self.length, self.link
        state, matched = 0, 0
        for at, x in enumerate(coded):
            while state and x not in step[state]:
                state = link[state]
                matched = length[state]
            if x in step[state]:
                state = step[state][x]
                matched += 1
            else:
                matched = 0
            yield at, state, matched

    def scan(self, words: list[str]) -> tuple[np.ndarray, set[str], int]:
        """Which words are hit, the items with occurring windows, the longest match of at least a window."""
        hit = np.zeros(len(words), dtype=bool)
        found: set[str] = set()
        longest = 0
        if not self.shortest or len(words) < self.shortest:
            return hit, found, longest
        codes = np.fromiter(map(self.vocabulary.get, words, iter(lambda: -1, None)), np.int64, len(words))
        known = np.concatenate(([False], codes >= 0, [False]))
        edge = np.flatnonzero(known[1:] != known[:-1])
        # a match lies within a run of known words; runs shorter than the shortest window hold none
        for first, end in zip(edge[::2].tolist(), edge[1::2].tolist()):
            if end - first < self.shortest:
                continue
            for at, state, matched in self.matches(codes[first:end].tolist()):
                if matched >= self.window:
                    hit[first + at - self.window + 1 : first + at + 1] = True
                    found |= self.items.get(self.at_length(state, self.window), frozenset())
                    longest = max(longest, matched)
                for n, names in self.short.get(state, ()):
                    if matched >= n:
                        hit[first + at - n + 1 : first + at + 1] = True
                        found |= names
                        longest = max(longest, n)
        return hit, found, longest


def runs(hit: np.ndarray) -> list[tuple[int, int]]:
    """(first, last) of each run of marked words."""
    edge = np.flatnonzero(np.diff(np.concatenate(([0], hit.view(np.int8), [0]))))
    return [(a, b - 1) for a, b in zip(edge[::2].tolist(), edge[1::2].tolist())]


#: States that a task holds at once; one takes some 500 bytes in Python.
MOST_STATES = 200_000


def automata(benchmark: DataFrame, window: int, id_col: str, text_col: str, most_bytes: int) -> Iterator[list[Automaton]]:
    """One automaton, or several over parts of the items where they exceed ``most_bytes``; together no more than ``MOST_STATES``
    states at a time (a single automaton apart), the bound on what is sent out and held."""
    need(benchmark, id_col, text_col)
    items = benchmark.select(F.col(f"`{id_col}`").cast("string").alias("i"), F.col(f"`{text_col}`").alias("t"))
    parts = max(1, -(-int(items.select(F.coalesce(F.sum(F.octet_length("t")), F.lit(0))).first()[0]) // most_bytes))
    split = items.withColumn("part", F.pmod(F.xxhash64("i", "t"), F.lit(parts)))
    if parts > 1:
        split = stage(split.repartition(parts, "part"), "leak-items")
    group, states = [], 0
    for p in range(parts):
        one = Automaton.build([(r.i, r.t) for r in split.where(F.col("part") == p).toLocalIterator()], window)
        if group and states + len(one.length) > MOST_STATES:
            yield group
            group, states = [], 0
        group.append(one)
        states += len(one.length)
    yield group


def _marked(known: list[Automaton], words: list[str], before: dict | None) -> tuple[np.ndarray, set[str], int]:
    """What these automata and those of the passes before find in a text."""
    hit, found, longest = np.zeros(len(words), dtype=bool), set(), 0
    if before is not None:
        for first, last in before["runs"]:
            hit[first : last + 1] = True
        found, longest = set(before["items"]), before["longest"]
    for a in known:
        h, f, n = a.scan(words)
        hit |= h
        found |= f
        longest = max(longest, n)
    return hit, found, longest


_BEFORE = pa.struct([("runs", pa.list_(pa.list_(pa.int32()))), ("items", pa.list_(pa.string())), ("longest", pa.int64())])
BEFORE = "row long, runs array<array<int>>, items array<string>, longest long"


def _found(rows: DataFrame, known: list[Automaton]) -> DataFrame:
    """What a pass finds in the texts of ``row, text`` in which it finds something. Staged."""

    def work(batches):
        for ids, texts in chunks_of(b.rename_columns(["doc_id", "text"]) for b in batches):
            out = []
            for row, text in zip(ids, texts):
                hit, found, longest = _marked(known, _WORD.findall((text or "").translate(TO_LOWER)), None)
                if hit.any():
                    out.append((row, [list(r) for r in runs(hit)], sorted(found), longest))
            columns = [pa.array(c, k) for c, k in zip(zip(*out), (pa.int64(), pa.list_(pa.list_(pa.int32())), pa.list_(pa.string()), pa.int64()))]
            if out:
                yield pa.RecordBatch.from_arrays(columns, names=["row", "runs", "items", "longest"])

    return stage(rows.mapInArrow(work, BEFORE), "leak-pass")


def _last_pass(docs: DataFrame, text_col: str, mark: str, row: str, groups: Iterator[list[Automaton]]) -> tuple[DataFrame, list[Automaton], int | None]:
    """``docs`` with what the passes of all groups but the last found, in column ``mark``, the last group, and the least length
    of a window before it. With more than one group the documents are written once, numbered; a pass then reads texts alone and
    writes what it finds."""
    known, least, passes = next(groups), None, None
    for following in groups:
        if passes is None:
            docs = stage(docs.withColumn(row, F.monotonically_increasing_id()), "leak-docs")
        found = _found(docs.select(F.col(row).alias("row"), F.col(f"`{text_col}`").cast("string").alias("text")), known)
        passes = found if passes is None else passes.unionByName(found)
        least = min((n for n in (least, *(a.shortest for a in known)) if n), default=None)
        known = following
    if passes is None:
        return docs, known, least
    merged = passes.groupBy(F.col("row").alias(row)).agg(
        F.struct(F.flatten(F.collect_list("runs")).alias("runs"), F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"), F.max("longest").alias("longest")).alias(mark)
    )
    return docs.join(stage(merged, "leak-marks"), row, "left").drop(row), known, least


def scan(
    docs: DataFrame, benchmark: DataFrame, window: int = 10, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text_col: str = "text", most_bytes: int = 1 << 18,
) -> DataFrame:
    """Per document what occurs of which item, with the spans in words and in code points (end exclusive)."""
    groups = automata(benchmark, window, item_col, item_text_col, most_bytes)
    rows, known, _ = _last_pass(id_text(docs, id_col, text_col), "text", "_before", "_row", groups)
    has_mark = "_before" in rows.columns

    def work(batches):
        remembered("leaks")  # nothing; what other operators keep goes
        for ids, texts, marks in _with_marks(batches, has_mark):
            out = []
            for i, text, own in zip(ids, texts, marks):
                low = text.translate(TO_LOWER)
                words = _WORD.findall(low)
                hit, found, longest = _marked(known, words, own)
                spans = runs(hit)
                if spans:
                    at = [m.span() for m in _WORD.finditer(low)]
                    spans = [{"first_word": a, "last_word": b, "start": at[a][0], "end": at[b][1]} for a, b in spans]
                names = sorted(found)
                digest = hashlib.sha256(",".join(names).encode()).hexdigest()
                out.append((i, len(words), int(hit.sum()), len(names), digest, bool(spans), longest, names, spans))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), _TYPES)], names=_NAMES)

    return rows.mapInArrow(work, SCAN)


def _with_marks(batches: Iterator[pa.RecordBatch], has_mark: bool) -> Iterator[tuple[list, list, list]]:
    """``chunks_of`` with what passes before have found."""
    for b in batches:
        at = 0
        for ids, texts in chunks_of(iter([b])):
            yield ids, texts, b.column("_before").slice(at, len(ids)).to_pylist() if has_mark else [None] * len(ids)
            at += len(ids)


_NAMES = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated", "longest", "items", "spans"]
_TYPES = [
    pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.bool_(), pa.int64(), pa.list_(pa.string()),
    pa.list_(pa.struct([("first_word", pa.int32()), ("last_word", pa.int32()), ("start", pa.int32()), ("end", pa.int32())])),
]


def clean(docs: DataFrame, benchmark: DataFrame, window: int = 10, min_span: int = 10, max_coverage: float = 0.2, most_bytes: int = 1 << 18) -> DataFrame:
    """Documents with all their columns: marked spans of at least ``min_span`` words (or whole shorter items) cut out, and
    those dropped whose marked share exceeds ``max_coverage``. ``n_chars``, where there is one, follows the text."""
    need(docs, "text")
    schema, has_size = docs.schema, "n_chars" in docs.columns
    mark, row = free_names(docs, "before", "row")
    docs, known, least = _last_pass(docs, "text", mark, row, automata(benchmark, window, "item_id", "text", most_bytes))
    has_mark = mark in docs.columns

    def work(batches):
        remembered("leaks")  # nothing; what other operators keep goes
        for b in batches:
            marks = b.column(mark).to_pylist() if has_mark else [None] * b.num_rows
            b = b.select(schema.names)
            keep, texts = [], []
            for row, text in enumerate(b.column("text").to_pylist()):
                low = (text or "").translate(TO_LOWER)
                words = _WORD.findall(low)
                hit = _marked(known, words, marks[row])[0]
                whole = min([min_span, *(n for n in (least, *(a.shortest for a in known)) if n)])
                if hit.any():
                    if hit.mean() > max_coverage:
                        continue
                    at = [m.span() for m in _WORD.finditer(low)]
                    for first, last in reversed(runs(hit)):
                        if last - first + 1 >= whole:
                            text = text[: at[first][0]] + text[at[last][1] :]
                keep.append(row)
                texts.append(text)
            kept = b.take(pa.array(keep, pa.int64()))
            columns = [pa.array(texts, b.schema.field(n).type) if n == "text" else c for n, c in zip(b.schema.names, kept.columns)]
            if has_size:
                k = b.schema.get_field_index("n_chars")
                # rows that were not cut keep the size that they came with
                sizes = [s if t == o else len(t) for t, o, s in zip(texts, kept.column("text").to_pylist(), kept.columns[k].to_pylist())]
                columns[k] = pa.array(sizes, b.schema.field(k).type)
            yield pa.RecordBatch.from_arrays(columns, names=b.schema.names)

    return docs.mapInArrow(work, schema)
