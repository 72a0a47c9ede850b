"""Language-model scores by a hashed maximum-entropy model.

A token's probability is that of its class, given the words before it, times its own within the class. The class softmax has
hashed features of the last word, the last two, and the words two and three back; within a class only the token itself is a
feature, for which relative frequency is the maximum-entropy solution. Frequent tokens are dealt to classes by frequency;
all others form the last class, where counts get one added and one further token stands for all unknown ones.

Counts are exact, over all training documents. Tokens of at least one in ``FREQUENT`` training tokens - of which there can be
no more than that - are sent to the tasks; the others' counts reach the documents by a join. The rows of the hashed features
grow with the vocabulary: a power of two of about a sixteenth of the distinct tokens, up to ``MOST_ROWS``, since each worker
holds the weights (32 MB then), and a copy while it trains; beyond that, from about four million distinct tokens on, only the
counts grow on. Training deals the documents into rounds; in each, every task takes gradient steps over its documents from the
shared weights, and the tasks' changes, summed up in two levels on the executors in a fixed order, are averaged by their
numbers of tokens. A task has as many documents as it takes for its change to be small beside them.

Cases: null texts count as empty: the end alone. A null id counts as empty text for the split. Repeated rows each count.
Without training documents every count is 0 and the class weights stay as they began. Clashing extra columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martkit.llm.common import mix64, need, remembered, stage

FREQUENT = 1 << 20
CLASSES, LEAST_ROWS, MOST_ROWS, TOKENS_A_ROW = 32, 1 << 12, 1 << 18, 16
ROUNDS, RATE, STEP_TOKENS = 2, 0.12, 8192
SCORE_TOKENS = 2048
PARTS = 16
#: Bytes of text whose words are hashed at once (each takes some 50 bytes then), of a slice of rows, and tokens counted at once.
HASHED_BYTES, SLICE_BYTES, COUNTED_TOKENS = 1 << 17, 2 << 20, 1 << 20
_END = 0x656E64


#: Of bytes, A-Z alone become small, and the contract's white space alone parts words.
_SMALL = np.arange(256, dtype=np.uint8)
_SMALL[65:91] += 32
_PARTS = np.zeros(256, bool)
_PARTS[[0x20, *range(0x09, 0x0E)]] = True


class _Powers:
    """A random value for each byte, and the powers of an odd base and of its inverse, for as many places as were hashed at once
    so far: ``HASHED_BYTES``, or the longest word."""

    def __init__(self):
        self.letter = np.random.default_rng(20261).integers(0, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
        self.letter = self.letter[_SMALL]
        self.base = np.uint64(0x9E3779B97F4A7C15)
        self.inverse = np.uint64(pow(int(self.base), -1, 1 << 64))
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            one = np.ones(1, np.uint64)
            self.up = np.cumprod(np.concatenate((one, np.full(n - 1, self.base))), dtype=np.uint64)
            self.down = np.cumprod(np.concatenate((one, np.full(n - 1, self.inverse))), dtype=np.uint64)
        return self.up[:n], self.down[:n]


def _worker_powers() -> _Powers:
    kept = remembered("maxent")
    return kept.get("powers") or kept.setdefault("powers", _Powers())


def tokens(texts: pa.Array, powers: _Powers) -> tuple[np.ndarray, np.ndarray]:
    """(64-bit hashes of the tokens of all texts, the end of each text); an end token follows each text's words.

    The texts' bytes, as they lie behind one another in the array, are hashed in place: a word's hash is a polynomial of its
    bytes' values, a difference of running sums brought to the power of its first place. The sums run over some words at a
    time, so that their memory follows neither the texts nor their number.
    """
    wide = np.int64 if pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type) else np.int32
    _, offsets, data = texts.buffers()
    edges = np.frombuffer(offsets, wide)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64) if len(texts) else np.zeros(1, np.int64)
    d = np.frombuffer(data, np.uint8)[edges[0] : edges[-1]] if data is not None else np.zeros(0, np.uint8)
    edges = edges - edges[0]
    n = len(d)
    inside = ~_PARTS[d]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    cut = edges[(edges > 0) & (edges < n)]  # texts may follow one another without white space
    first[cut] |= inside[cut]
    last[cut - 1] |= inside[cut - 1]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    ends = np.searchsorted(start, edges[1:])
    found = np.full(len(start) + len(ends), np.uint64(_END))
    ends += np.arange(len(ends))  # the places of the end tokens
    word = np.ones(len(found), bool)
    word[ends] = False
    found[word] = _hashes(d, start, end, powers)
    return found, ends + 1


def _hashes(d: np.ndarray, start: np.ndarray, end: np.ndarray, powers: _Powers) -> np.ndarray:
    """Of the words from ``start`` to ``end``, as many at a time as ``HASHED_BYTES`` hold, one at least."""
    out = np.empty(len(start), np.uint64)
    k = 0
    while k < len(start):
        at = start[k]
        stop = max(k + 1, int(np.searchsorted(end, at + HASHED_BYTES, side="right")))
        n = int(end[stop - 1] - at)
        first, last = start[k:stop] - at, end[k:stop] - at
        up, down = powers.upto(max(n, HASHED_BYTES) + 1)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(powers.letter[d[at : at + n]] * up[:n], out=sums[1:])
        out[k:stop] = mix64((sums[last] - sums[first]) * down[first] + (last - first).astype(np.uint64))
        k = stop
    return out


def _slices(batches):
    """Some rows at a time, about ``SLICE_BYTES`` of them."""
    for b in batches:
        step_rows = max(1, int(b.num_rows * SLICE_BYTES / max(1, b.nbytes)))
        for at in range(0, b.num_rows, step_rows):
            yield b.slice(at, step_rows)


def is_held_out(id_col: str = "doc_id", folds: int = 7, fold: int = 2) -> Column:
    return F.crc32(F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")).cast("binary")) % folds == fold


def counts(docs: DataFrame) -> DataFrame:
    """``token, c`` over all rows of ``docs`` (doc_id, text). A task sends a token once for some ``COUNTED_TOKENS``. Staged."""

    def counted(held):
        found, n = np.unique(np.concatenate(held).view(np.int64), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(found), pa.array(n.astype(np.int64))], names=["token", "c"])

    def work(batches):
        powers, held, n = _worker_powers(), [], 0
        for some in _slices(batches):
            held.append(tokens(some.column("text"), powers)[0])
            n += len(held[-1])
            if n >= COUNTED_TOKENS:
                yield counted(held)
                held, n = [], 0
        if held:
            yield counted(held)

    return stage(docs.mapInArrow(work, "token long, c long").groupBy("token").agg(F.sum("c").alias("c")), "lm-counts")


class Vocabulary:
    """The frequent tokens with their classes and their log10 shares of the class; all others are of the last class."""

    def __init__(self, token: np.ndarray, count: np.ndarray, total: int, distinct: int, classes: int):
        order = np.argsort(token.view(np.uint64))
        self.token, count = token.view(np.uint64)[order], count[order].astype(np.float64)
        self.total, self.distinct, self.classes = total, distinct, classes
        self.log_count = np.log10(count + 1)
        by_count = np.argsort(-count, kind="stable")
        weight = np.sqrt(count[by_count])
        self.of = np.empty(len(count), np.int64)
        self.of[by_count] = np.minimum((np.cumsum(weight) - weight / 2) / max(weight.sum(), 1e-9) * (classes - 1), classes - 2).astype(np.int64)
        mass = np.bincount(self.of, count, classes)
        self.inside = np.log10(count / mass[self.of]) if len(count) else np.zeros(0)
        #: the others' counts, one more for each of them and for the unknown
        self.rest = float(total - count.sum()) + (distinct - len(count)) + 1
        mass[-1] += self.rest
        self.bias = np.log(np.maximum(mass, 0.5) / max(mass.sum(), 1.0)).astype(np.float32)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Place of each token among the frequent ones, else -1."""
        if not len(self.token):
            return np.full(len(hashes), -1)
        distinct, back = np.unique(hashes, return_inverse=True)
        at = np.minimum(np.searchsorted(self.token, distinct), len(self.token) - 1)
        return np.where(self.token[at] == distinct, at, -1)[back]


def features(hashes: np.ndarray, ends: np.ndarray, rows: int) -> np.ndarray:
    """For each token the rows of its features beside the constant, row 0: last word, last two, second last, third last."""
    n = len(hashes)
    starts = np.concatenate(([0], ends[:-1]))
    place = np.arange(n) - np.repeat(starts, np.diff(np.concatenate(([0], ends))))
    before = []
    for k in (1, 2, 3):
        shifted = np.zeros(n, np.uint64)
        shifted[k:] = hashes[:-k] if n > k else hashes[:0]
        shifted[place < k] = k
        before.append(shifted)
    one, two, three = before
    out = np.empty((n, 4), np.int64)
    for j, mixed in enumerate((one + np.uint64(1), one * np.uint64(3) + mix64(two), two + np.uint64(2), three + np.uint64(4))):
        out[:, j] = 1 + (mix64(mixed) % np.uint64(rows - 1)).astype(np.int64)
    return out


class Softmax:
    """Class softmax over rows of weights, in buffers that are used again: a batch's memory is asked for once."""

    def __init__(self, weights: np.ndarray, most: int):
        self.weights = weights
        self.total = np.empty((most, weights.shape[1]), np.float32)
        self.part = np.empty_like(self.total)

    def exponentials(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(logits exponentiated, their sums) for rows ``at`` of each token beside the constant's. Logits are sums of a few
        weights that training keeps small, far from where single precision ends; they are cut there all the same."""
        z, part = self.total[: len(at)], self.part[: len(at)]
        np.take(self.weights, at[:, 0], axis=0, out=z, mode="clip")
        for j in range(1, at.shape[1]):
            np.take(self.weights, at[:, j], axis=0, out=part, mode="clip")
            z += part
        z += self.weights[0]
        np.minimum(z, 80, out=z)
        np.exp(z, out=z)
        return z, z.sum(axis=1)

    def log_chance(self, at: np.ndarray, cls: np.ndarray) -> np.ndarray:
        """Natural logarithm of the probability of each token's class."""
        e, total = self.exponentials(at)
        own = np.maximum(e[np.arange(len(cls)), cls], np.float32(1e-37))
        return np.log(own.astype(np.float64)) - np.log(total.astype(np.float64))


def step(softmax: Softmax, squares: np.ndarray, at: np.ndarray, cls: np.ndarray, rate: float) -> None:
    """One gradient step in place, each row of weights at its own pace (AdaGrad by rows)."""
    weights = softmax.weights
    grad, total = softmax.exponentials(at)
    grad *= (1 / total)[:, None]
    grad[np.arange(len(cls)), cls] -= 1
    every = grad.sum(axis=0)  # the constant's row
    flat = at.astype(np.uint16 if len(weights) <= 1 << 16 else np.uint32).ravel()
    order = np.argsort(flat, kind="stable")
    rows, source = flat[order], order // at.shape[1]
    first = np.flatnonzero(np.concatenate(([True], rows[1:] != rows[:-1])))
    size = np.diff(np.append(first, len(rows)))
    g = grad.take(source[first], axis=0)  # most rows have one token in a batch; only the others are summed up
    many = np.flatnonzero(size > 1)
    if len(many):
        n = size[many]
        start = np.cumsum(n) - n
        g[many] = np.add.reduceat(grad.take(source[np.repeat(first[many] - start, n) + np.arange(n.sum())], axis=0), start, axis=0)
    touched = rows[first]
    pace = np.einsum("ij,ij->i", g, g) / np.float32(g.shape[1]) + squares[touched]
    squares[touched] = pace
    g *= (np.float32(rate) / np.sqrt(pace))[:, None]
    weights[touched] -= g
    squares[0] += (every * every).mean()
    weights[0] -= rate * every / np.sqrt(squares[0])


def _train(model: Broadcast, rate: float):
    def work(batches):
        from pyspark import TaskContext

        words, weights = model.value
        powers, own, squares, n = _worker_powers(), weights.copy(), np.ones(len(weights), np.float32), 0
        softmax = Softmax(own, STEP_TOKENS)
        for some in _slices(batches):
            found, ends = tokens(some.column("text"), powers)
            place = words.find(found)
            cls = np.where(place >= 0, words.of[place] if len(words.of) else 0, words.classes - 1)
            at = features(found, ends, len(weights))
            for k in range(0, len(found), STEP_TOKENS):
                step(softmax, squares, at[k : k + STEP_TOKENS], cls[k : k + STEP_TOKENS], rate)
            n += len(found)
        if n:
            task = TaskContext.get().partitionId()
            for part, (now, was) in enumerate(zip(own.reshape(PARTS, -1), weights.reshape(PARTS, -1))):  # one part's bytes at a time
                columns = ([part], [task % SALTS], [task], [n], [(now - was).astype(np.float16).tobytes()])
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, _CHANGE)], names=_NAMES)

    return work


SALTS = 64
_CHANGE = (pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.binary())
_NAMES = ["part", "salt", "task", "n", "change"]
CHANGE = "part int, salt int, task int, n long, change binary"


def _mean_of(kind: str):
    """Weighted means of changes that come sorted by part, salt and task, so that sums are the same in every run: one vector in
    memory for each run of equal keys."""

    def work(batches):
        key, total, n = None, None, 0

        def close():
            columns = ([key[0]], [key[1]], [0], [n], [(total / n).astype(np.float16).tobytes()])
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, _CHANGE)], names=_NAMES)

        for b in batches:
            for r in range(b.num_rows):
                part, salt, many, change = (b.column(c)[r].as_py() for c in ("part", "salt", "n", "change"))
                now = (part, salt if kind == "salted" else 0)
                if now != key:
                    if key is not None:
                        yield close()
                    key, total, n = now, 0.0, 0
                total = total + np.frombuffer(change, np.float16).astype(np.float32) * many
                n += many
        if key is not None:
            yield close()

    return work


def rows_for(distinct: int) -> int:
    """Rows of the weights for a vocabulary: the next power of two, within the bounds."""
    return min(max(1 << max(distinct // TOKENS_A_ROW - 1, 0).bit_length(), LEAST_ROWS), MOST_ROWS)


def fit(docs: DataFrame, words: Vocabulary, rows: int, rounds: int = ROUNDS, rate: float = RATE) -> np.ndarray:
    """Class weights, trained on all rows of ``docs`` (doc_id, text); every document takes part in one round."""
    weights = np.zeros((rows, words.classes), np.float32)
    weights[0] = words.bias
    tasks = math.ceil(words.total / (2 * weights.size))  # a task's change takes two bytes a weight, its texts some six a token
    for r in range(rounds):
        own = docs.coalesce(max(tasks, 1)).where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(rounds)) == r)
        model = docs.sparkSession.sparkContext.broadcast((words, weights))  # a worker holds it once, whatever the number of its tasks
        changes = own.mapInArrow(_train(model, rate), CHANGE)
        salted = changes.repartition("part", "salt").sortWithinPartitions("part", "salt", "task").mapInArrow(_mean_of("salted"), CHANGE)
        means = salted.repartition("part").sortWithinPartitions("part", "salt").mapInArrow(_mean_of("all"), CHANGE)
        for row in means.collect():  # as many rows as there are parts of the weights
            weights.reshape(PARTS, -1)[row.part] += np.frombuffer(row.change, np.float16)
        model.destroy()
    return weights


RATED = (
    "row long, doc_id long, held_out boolean, n_tokens long, n_frequent long, n_rare long, frequent_sum double, model_sum double, "
    "rare array<long>, times array<int>"
)


def rate(docs: DataFrame, words: Vocabulary, weights: np.ndarray) -> DataFrame:
    """What a pass over the texts gives for each row of ``docs`` (row, doc_id, text, held_out), and the tokens whose counts are
    still to be looked up. Staged."""

    model = docs.sparkSession.sparkContext.broadcast((words, weights))

    def work(batches):
        words, weights = model.value
        powers, softmax = _worker_powers(), Softmax(weights, SCORE_TOKENS)
        for some in _slices(batches):
            found, ends = tokens(some.column("text"), powers)
            starts = np.concatenate(([0], ends[:-1]))
            place = words.find(found)
            known = place >= 0
            cls, inside, plain = np.full(len(found), words.classes - 1), np.zeros(len(found)), np.zeros(len(found))
            cls[known], inside[known], plain[known] = words.of[place[known]], words.inside[place[known]], words.log_count[place[known]]
            own = np.empty(len(found))
            features_at = features(found, ends, len(weights))
            for k in range(0, len(found), SCORE_TOKENS):
                own[k : k + SCORE_TOKENS] = softmax.log_chance(features_at[k : k + SCORE_TOKENS], cls[k : k + SCORE_TOKENS])
            sums = [np.add.reduceat(x, starts) for x in (known.astype(np.int64), plain, own / np.log(10) + inside)]
            at = np.flatnonzero(~known)
            own_text = np.searchsorted(ends, at, side="right")
            order = np.lexsort((found[at], own_text))
            rare, own_text = found[at][order].view(np.int64), own_text[order]
            begins = np.flatnonzero(np.concatenate((np.ones(min(len(rare), 1), bool), (rare[1:] != rare[:-1]) | (own_text[1:] != own_text[:-1]))))
            times = np.diff(np.append(begins, len(rare))).astype(np.int32)
            offset = pa.array(np.concatenate(([0], np.cumsum(np.bincount(own_text[begins], minlength=len(ends))))).astype(np.int32))
            size = ends - starts
            yield pa.RecordBatch.from_arrays(
                [
                    some.column("row"), some.column("doc_id"), some.column("held_out"), pa.array(size), pa.array(sums[0]), pa.array(size - sums[0]), pa.array(sums[1]), pa.array(sums[2]),
                    pa.ListArray.from_arrays(offset, pa.array(rare[begins])), pa.ListArray.from_arrays(offset, pa.array(times)),
                ],
                names=["row", "doc_id", "held_out", "n_tokens", "n_frequent", "n_rare", "frequent_sum", "model_sum", "rare", "times"],
            )

    rated = stage(docs.select("row", "doc_id", "text", "held_out").mapInArrow(work, RATED), "lm-rated")
    model.destroy()
    return rated


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", held_out: Column | None = None, classes: int = CLASSES, rows: int | None = None, rounds: int = ROUNDS) -> DataFrame:
    """Per row ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``; learns from rows not held out. ``rows``:
    of the weights, a power of two, if not to follow from the vocabulary."""
    need(docs, id_col, text_col)
    held_out = is_held_out(id_col) if held_out is None else held_out
    texts = docs.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"), held_out.alias("held_out")
    )
    train = texts.where(~F.col("held_out")).select("doc_id", "text")
    known = counts(train)
    total, distinct = known.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    # no more than FREQUENT tokens can each make up one in FREQUENT
    frequent = known.where(F.col("c") * FREQUENT >= total).toArrow()
    words = Vocabulary(frequent["token"].to_numpy(), frequent["c"].to_numpy(), total, distinct, classes)
    weights = fit(train, words, rows or rows_for(distinct), rounds)
    rated = rate(texts.withColumn("row", F.monotonically_increasing_id()), words, weights)
    left = rated.select("row", F.explode(F.arrays_zip("rare", "times")).alias("t")).select("row", F.col("t.rare").alias("token"), F.col("t.times").alias("times"))
    other = known.where(F.col("c") * FREQUENT < total)
    met = left.join(other, "token").groupBy("row").agg(F.sum("times").alias("n"), F.sum(F.col("times") * F.log10(F.col("c") + 1)).alias("s"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    each = F.log10(F.lit(float(total + distinct + 1)))
    return rated.join(met, "row", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("n_frequent") + zero("n")).cast("long").alias("n_known"), F.lit(total).cast("long").alias("train_tokens"),
        (F.col("frequent_sum") + zero("s") - F.col("n_tokens") * each).alias("base_score"),
        (F.col("model_sum") + zero("s") - F.col("n_rare") * F.log10(F.lit(words.rest))).alias("score"),
    )
