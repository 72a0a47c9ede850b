"""Periodic runs of words: stretches in which a passage repeats itself at least four times in a row, and texts without the
repeats.

A run is a stretch of consecutive words with smallest period q that no neighbouring word extends, of at least ``4 q`` words
and at least six. All texts of a batch lie behind one another in one array of word codes, with a code of its own between
them, and are searched at once:

* Periods below ``SCALE`` are too short for the scales below: each lag is compared over the whole array.
* For periods in [P, 2P), P = SCALE, 2 SCALE, 4 SCALE and so on, the P/4-word grams are hashed, and each window of P/4 + 1 of
  them marks its minima. Two windows at period distance inside a run hold the same words, so their minima lie at period
  distance, too. Pairs of equal minima at a distance in [P, 2P) are the seeds. Grams inside runs of a period up to P/16, found
  before, don't count: equal grams that are left over are more than P/16 words apart, so a minimum meets at most 16 partners,
  and of each period in a longer run at least one gram is left, for runs of different periods share fewer words than the sum
  of their periods. A run of four periods has a window with such a gram that lies far enough from its ends to be repeated.
* A seed's words must equal those one period on over a whole period (by prefix hashes); then it is extended by comparing
  words. Hashes only leave out: what is reported has been compared word by word.

Cases: null and empty texts have no words and no runs. Equal runs of several texts are each listed. Ties do not occur: no two
runs of a text agree in start and period. Repeated rows each give a row. An empty table gives an empty result; clashing extra
columns are ignored. A task holds a batch of texts, the longest of them whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame

from martkit.llm.common import chunks_of, id_text, mix64

#: The first period that is searched by minima.
SCALE = 32
#: A run has at least so many periods, and so many words.
PERIODS, LEAST = 4, 6
FOUND = "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"

_BASE = np.uint64(0x9E3779B97F4A7C15)


def _stretches(same: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begins and ends of the stretches of true values."""
    edge = np.flatnonzero(np.diff(np.concatenate(([0], same.view(np.int8), [0]))))
    return edge[::2], edge[1::2]


def _primes(n: int) -> list[int]:
    out, p = [], 2
    while p * p <= n:
        if n % p == 0:
            out.append(p)
            while n % p == 0:
                n //= p
        p += 1
    return out + [n] if n > 1 else out


def _is_smallest(x: np.ndarray, start: int, period: int) -> bool:
    """Whether no part of the period is a period of the stretch, too; only divisors can be in so long a stretch."""
    one = x[start : start + 2 * period]
    return not any((one[: -(period // p)] == one[period // p :]).all() for p in _primes(period))


def short_runs(x: np.ndarray, below: int) -> list[tuple[int, int, int]]:
    """(start, end, period) of runs of periods below the bound, lag by lag."""
    out = []
    for q in range(1, min(below, len(x))):
        begin, end = _stretches(x[q:] == x[:-q])
        long = np.flatnonzero(end - begin >= max(LEAST - q, (PERIODS - 1) * q))
        out += [(int(begin[k]), int(end[k]) + q, q) for k in long if q == 1 or _is_smallest(x, begin[k], q)]
    return out


def _slide(x: np.ndarray, width: int, best) -> np.ndarray:
    """``best`` (minimum or maximum) of each ``width`` neighbouring values, by windows that double."""
    have, out = 1, x
    while have < width:
        step = min(have, width - have)
        out = best(out[:-step], out[step:])
        have += step
    return out


class _Hashes:
    """Prefix hashes of a sequence: the hash of any stretch in constant time."""

    def __init__(self, x: np.ndarray):
        value = mix64(x.astype(np.uint64) + _BASE)
        self.power = np.cumprod(np.concatenate(([np.uint64(1)], np.full(len(x), _BASE))), dtype=np.uint64)
        # stretches are compared after they have been brought to the same power
        self.sums = np.concatenate(([np.uint64(0)], np.cumsum(value * self.power[:-1], dtype=np.uint64)))

    def equal(self, a: np.ndarray, b: np.ndarray, n: np.ndarray) -> np.ndarray:
        left, right = self.sums[a + n] - self.sums[a], self.sums[b + n] - self.sums[b]
        return left * self.power[b - a] == right

    def grams(self, k: int) -> np.ndarray:
        total = self.sums[k:] - self.sums[:-k]
        return total * self.power[::-1][: len(total)]


def _pairs(place: np.ndarray, value: np.ndarray, low: int) -> tuple[np.ndarray, np.ndarray]:
    """(place, distance) of equal values at distances in [low, 2 low)."""
    order = np.argsort(value, kind="stable")
    at, key = place[order], value[order]
    first, gap, k = [], [], 1
    here = np.arange(len(at))
    while True:
        here = here[here + k < len(at)]
        there = here + k
        near = (key[there] == key[here]) & (at[there] - at[here] < 2 * low)
        here = here[near]
        if not len(here):
            break
        d = at[here + k] - at[here]
        far = d >= low
        first.append(at[here[far]])
        gap.append(d[far])
        k += 1
    return (np.concatenate(first), np.concatenate(gap)) if first else (np.zeros(0, np.int64), np.zeros(0, np.int64))


def _extend(x: np.ndarray, at: int, q: int) -> tuple[int, int]:
    """The longest stretch around ``at`` in which words ``q`` apart are identical."""
    end, size = at, 64
    while end + q < len(x):
        same = x[end : min(end + size, len(x) - q)] == x[end + q : end + q + size]
        if not same.all():
            end += int(np.argmin(same))
            break
        end += len(same)
        size *= 2
    start, size = at, 64
    while start > 0:
        low = max(0, start - size)
        same = (x[low:start] == x[low + q : start + q])[::-1]
        if not same.all():
            start -= int(np.argmin(same))
            break
        start = low
        size *= 2
    return start, end + q


def scale_runs(x: np.ndarray, hashes: _Hashes, low: int, found: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Runs of periods in [low, 2 low) by minima; ``found`` holds the runs of all shorter periods."""
    gram = low // 4
    width = gram + 1
    if len(x) < PERIODS * low:
        return []
    grams = mix64(hashes.grams(gram))
    top = ~np.uint64(0)
    np.minimum(grams, top - np.uint64(1), out=grams)
    for start, end, q in found:
        if q <= gram // 4:
            grams[start : max(start, end - gram + 1)] = top
    minima = _slide(grams, width, np.minimum)
    # a gram is the least of some window if the largest minimum of its windows is the gram itself
    edge = np.zeros(width - 1, np.uint64)
    largest = _slide(np.concatenate((edge, minima, edge)), width, np.maximum)
    place = np.flatnonzero((largest == grams) & (grams != top))
    at, gap = _pairs(place, grams[place], low)
    fits = at + 2 * gap <= len(x)
    at, gap = at[fits], gap[fits]
    square = hashes.equal(at, at + gap, gap)
    at, gap = at[square], gap[square]
    order = np.lexsort((at, gap))
    out, last, done = [], 0, -1
    for k in order.tolist():
        q, place = int(gap[k]), int(at[k])
        if q == last and place < done:
            continue
        start, end = _extend(x, place, q)
        last, done = q, end - q
        if end - start >= PERIODS * q and _is_smallest(x, start, q):
            out.append((start, end, q))
    return out


def runs_of(codes: list[np.ndarray], scale: int = SCALE) -> list[list[tuple[int, int, int]]]:
    """For each sequence of word codes (none negative) its runs as (start, length, period), sorted."""
    out: list[list] = [[] for _ in codes]
    known: list[tuple[int, int, int]] = []  # of the texts in the array, in its places
    low, chosen = scale, list(range(len(codes)))
    chosen = [k for k in chosen if len(codes[k]) >= LEAST]
    first = True
    while chosen:
        lengths = np.array([len(codes[k]) + 1 for k in chosen])
        begin = np.cumsum(lengths) - lengths
        x = np.concatenate([part for j, k in enumerate(chosen) for part in (codes[k], [-1 - j])]).astype(np.int64)
        if first:
            new = short_runs(x, scale)
        else:
            place = dict(zip(chosen, begin.tolist()))
            known = [(s + place[k], s + n + place[k], q) for k in chosen for s, n, q in out[k]]
            new = scale_runs(x, _Hashes(x), low, known)
            low *= 2
        owner = np.searchsorted(begin, [s for s, _, _ in new], side="right") - 1
        for j, (s, e, q) in zip(owner.tolist(), new):
            out[chosen[j]].append((s - int(begin[j]), e - s, q))
        first = False
        chosen = [k for k in chosen if len(codes[k]) >= PERIODS * low]
    return [sorted(found) for found in out]


def dropped(n: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """Which of ``n`` words a run contains after its first period."""
    depth = np.zeros(n + 1, np.int64)
    for start, length, period in runs:
        depth[start + period] += 1
        depth[start + length] -= 1
    return np.cumsum(depth)[:n] > 0


def _work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
    for ids, texts in chunks_of(batches):
        # of bytes, this splits at the contract's white space alone
        words = [t.encode("utf-8", "surrogatepass").split() for t in texts]
        ends = np.cumsum([len(w) for w in words])
        codes = np.split(pd.factorize(np.array([w for some in words for w in some], object))[0].astype(np.int64), ends[:-1])
        found = runs_of(codes)
        kept = []
        for w, runs in zip(words, found):
            if runs:
                w = [w[k] for k in np.flatnonzero(~dropped(len(w), runs)).tolist()]
            kept.append(b" ".join(w).decode("utf-8", "surrogatepass"))
        listed = [[{"start": s, "length": n, "period": q} for s, n, q in runs] for runs in found]
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array([len(w) for w in words], pa.int64()), pa.array(listed, kind), pa.array(kept, pa.string())],
            names=["doc_id", "n_words", "runs", "collapsed"],
        )


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row ``doc_id, n_words``, its ``runs`` by start and period, and ``collapsed``: the words that no run contains after
    its first period, joined by one space."""
    return id_text(docs, id_col, text_col).mapInArrow(_work, FOUND)
