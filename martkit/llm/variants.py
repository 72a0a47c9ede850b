"""Spelling variants: words of a corpus that differ by one letter, and the most frequent spelling of each.

Two words are near if one inserted, deleted or replaced character turns one into the other. The pairs are those that the
composition of three machines accepts: an acceptor of the vocabulary, a transducer that copies with exactly one edit, and the
acceptor again. The composition is worked out by initial state: with an edit behind its first half, a pair has that half in
common and both words pass through the same state of the acceptor; with an edit in its first half it has the rest in common,
which both words go on with once the edit is done. Spark deals out the words by these states, and a task that gets the words
of a state builds the minimal acceptor of what differs and walks the composition: copy states (s, s), the edits from them,
and the joint paths of the two states behind an edit. An edit stands where the two words first differ, so each pair is found
once. Of a word's partners only their number and the best one leave the task.

States with more than ``most`` words are split: edits at the next ``STEP`` positions make states of their own, in which the
words agree but for one position, and the rest is dealt out by the longer common part; again until all are small enough.

A word's form is its near word of the largest count (ties: the first in code-point order) if that is at least ``ratio`` times
its own. Forms grow, so following them ends; roots are found by doubling the steps.

Cases: null texts have no words. Repeated rows count. Ties are settled as above. Rows of a vocabulary that repeat a word, or
lack one, are an error of the caller: ``count_words`` makes neither. An empty table gives an empty result; clashing extra
columns are ignored. Very long words are walked without recursion.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martkit.llm.common import id_text, lower_ascii, need, stage

#: Maximal runs of letters of the first Unicode block and the next, after A-Z have been lowered.
LETTERS = "[A-Za-zÀ-ÿ]+"
STEP = 4
#: Words of a state that one task takes in at once.
MOST = 20_000
PARTIAL = "word string, n_near long, form_n long, form string"


def count_words(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_length: int = 5, least_count: int = 3,
    rewrite: Callable[[Column, Column], Column] = lambda doc_id, run: run,
) -> DataFrame:
    """``word, n`` of all runs of letters in all texts, each passed through ``rewrite(doc_id, run)`` first."""
    runs = id_text(docs, id_col, text_col).select("doc_id", F.explode(F.regexp_extract_all(lower_ascii(F.col("text")), F.lit(LETTERS), F.lit(0))).alias("run"))
    words = runs.select(rewrite(F.col("doc_id"), F.col("run")).alias("word")).where(F.length("word") >= least_length)
    return words.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least_count)


class Acceptor:
    """Minimal acyclic acceptor of sorted distinct strings: ``edges[state]`` by letter, ``final[state]``; state 0 begins."""

    def __init__(self, words: Iterable[str]):
        self.edges: list[dict[str, int]] = [{}]
        self.final = [False]
        register: dict[tuple, int] = {}
        path, last = [0], ""  # states along the last word

        def settle(down_to: int) -> None:
            while len(path) > down_to:
                state = path.pop()
                own = (self.final[state], *self.edges[state].items())
                same = register.setdefault(own, state)
                if same != state:
                    self.edges[path[-1]][last[len(path) - 1]] = same

        for word in words:
            common = 0
            for a, b in zip(word, last):
                if a != b:
                    break
                common += 1
            settle(common + 1)
            for letter in word[common:]:
                self.edges.append({})
                self.final.append(False)
                self.edges[path[-1]][letter] = len(self.edges) - 1
                path.append(len(self.edges) - 1)
            self.final[path[-1]] = True
            last = word
        settle(1)


class Composition:
    """Acceptor, one edit, acceptor."""

    def __init__(self, words: Acceptor):
        self.edges, self.final = words.edges, words.final
        self.dead: dict[tuple[int, int], bool] = {}

    def common(self, a: int, b: int, not_first: str = "") -> Iterator[str]:
        """Strings that lead from both states to final ones, but for those that begin with ``not_first``."""
        if self.final[a] and self.final[b]:
            yield ""
        if self._is_dead(a, b):
            return
        letters: list[str] = []
        stack = [(a, b, iter(self.edges[a]))]
        while stack:
            x, y, rest = stack[-1]
            letter = next(rest, None)
            if letter is None:
                stack.pop()
                if letters:
                    letters.pop()
                continue
            if letter not in self.edges[y] or (len(stack) == 1 and letter == not_first):
                continue
            x, y = self.edges[x][letter], self.edges[y][letter]
            fine = self.final[x] and self.final[y]
            if fine:
                yield "".join(letters) + letter
            if not self._is_dead(x, y):
                letters.append(letter)
                stack.append((x, y, iter(self.edges[x])))

    def _is_dead(self, a: int, b: int) -> bool:
        """No common string but the empty one. Worked out for all pairs below, bottom up."""
        found = self.dead.get((a, b))
        if found is not None:
            return found
        stack = [(a, b, iter(self.edges[a].keys() & self.edges[b].keys()))]
        self.dead[a, b] = True
        while stack:
            x, y, rest = stack[-1]
            letter = next(rest, None)
            if letter is None:
                stack.pop()
                if stack and not self.dead[x, y]:
                    self.dead[stack[-1][0], stack[-1][1]] = False
                continue
            p, q = self.edges[x][letter], self.edges[y][letter]
            if self.final[p] and self.final[q]:
                self.dead[x, y] = False
            known = self.dead.get((p, q))
            if known is None:
                self.dead[p, q] = True
                stack.append((p, q, iter(self.edges[p].keys() & self.edges[q].keys())))
            elif not known:
                self.dead[x, y] = False
        return self.dead[a, b]

    def edits(self, state: int) -> list[tuple[str, str]]:
        """What the two words read from a copy state on if the edit comes next; the shorter one first."""
        out, edges = [], self.edges[state]
        letters = sorted(edges)
        for k, a in enumerate(letters):
            for b in letters[k + 1 :]:
                out += [(a + rest, b + rest) for rest in self.common(edges[a], edges[b])]
            # the letter is one more; without it the other word must go on differently, else the edit comes later
            if self.final[state] or len(letters) > 1:
                out += [(rest, a + rest) for rest in self.common(edges[a], state, not_first=a)]
        return out

    def pairs(self, before: int) -> Iterator[tuple[str, str, int]]:
        """(shorter or equal word, the other, place of the edit) of all accepted pairs with the edit before that place."""
        from_state: dict[int, list] = {}
        letters: list[str] = []
        stack = [(0, iter(self.edges[0]))]
        from_state[0] = self.edits(0)
        yield from ((x, y, 0) for x, y in from_state[0] if before > 0)
        while stack:
            state, rest = stack[-1]
            letter = next(rest, None)
            if letter is None:
                stack.pop()
                if letters:
                    letters.pop()
                continue
            if len(stack) >= before:
                continue
            letters.append(letter)
            state = self.edges[state][letter]
            if state not in from_state:
                from_state[state] = self.edits(state)
            if from_state[state]:
                copied = "".join(letters)
                yield from ((copied + x, copied + y, len(copied)) for x, y in from_state[state])
            stack.append((state, iter(self.edges[state])))


def near_in_state(short: int, limit: int, pre: str, post: str, middles: dict[str, int]) -> Iterator[tuple[str, int, int, str]]:
    """(word, number of near words, the best one's count and itself) for the words ``pre + middle + post`` of a state with
    counts; pairs whose shorter word has ``short`` characters and whose edit lies before ``limit``."""
    found: dict[str, list] = {}
    size = len(pre) + len(post)

    def meet(a: str, b: str) -> None:
        rank = (-middles[b], pre + b + post)
        own = found.get(a)
        if own is None:
            found[a] = [1, rank]
        else:
            own[0] += 1
            own[1] = min(own[1], rank)

    for a, b, at in Composition(Acceptor(sorted(middles))).pairs(limit - len(pre)):
        if min(len(a), len(b)) + size != short:
            continue
        if len(a) != len(b) and at == len(a) and post.startswith(b[-1]):
            continue  # the words first differ further on
        meet(a, b)
        meet(b, a)
    for a, (n, (best, form)) in found.items():
        yield pre + a + post, n, -best, form


def _states(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, dict[str, int]]]:
    """Rows that follow one another with one key, as (key, {middle: count})."""
    now, middles = None, {}
    for b in batches:
        columns = [b.column(c).to_pylist() for c in ("short", "limit", "pre", "post", "middle", "n")]
        for *key, middle, n in zip(*columns):
            if key != now:
                if len(middles) > 1:
                    yield tuple(now), middles
                now, middles = key, {}
            middles[middle] = n
    if len(middles) > 1:
        yield tuple(now), middles


def _work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    out: list[tuple] = []

    def batch():
        columns = [pa.array(c, k) for c, k in zip(zip(*out), (pa.string(), pa.int64(), pa.int64(), pa.string()))]
        return pa.RecordBatch.from_arrays(columns, names=["word", "n_near", "form_n", "form"])

    for key, middles in _states(batches):
        out += near_in_state(*key, middles)
        if len(out) > 20_000:
            yield batch()
            out = []
    if out:
        yield batch()


def _from(text: str | Column, start: Column) -> Column:
    """Characters from a position (from 0) to the end."""
    return F.substring(text, start + 1, F.length(text))


def initial_states(words: DataFrame) -> DataFrame:
    """Each word in the states that it shares with near words: as the shorter or equal one of a pair, and as the longer one.
    ``short``, the shorter length; ``limit``, edits lie before it; ``at``, from where on; ``pre`` and ``post``, the common part."""
    size = F.length("word")
    rows = words.select("word", "n", F.explode(F.array(size, size - 1)).alias("short"))
    half = F.floor(F.col("short") / 2).cast("int")
    end = F.length("word") - (F.col("short") - half)  # where the last characters in common begin
    word = F.col("word")
    first = F.struct((F.col("short") + 1).alias("limit"), F.substring(word, F.lit(1), half).alias("pre"), F.lit("").alias("post"), _from(word, half).alias("middle"))
    last = F.struct(half.alias("limit"), F.lit("").alias("pre"), _from(word, end).alias("post"), F.substring(word, F.lit(1), end).alias("middle"))
    return rows.select("short", "n", F.explode(F.array(first, last)).alias("s")).select("short", "s.limit", "s.pre", "s.post", "s.middle", "n")


def split_states(rows: DataFrame) -> DataFrame:
    """The rows of states that are too large, in states for edits at each of the next positions and in deeper ones."""
    word = F.concat("pre", "middle", "post")
    rows = rows.select("short", "limit", "pre", "post", "n", word.alias("word"))
    forward = F.col("post") == ""
    start = F.when(forward, F.length("pre")).otherwise(F.greatest(F.col("limit") - STEP, F.lit(0)))
    stop = F.when(forward, F.least(F.col("limit"), F.length("pre") + STEP)).otherwise(F.col("limit"))
    size = F.length("word")
    longer = size > F.col("short")
    single = rows.select("short", "n", "word", F.explode(F.sequence(start, stop - 1)).alias("p"))
    p = F.col("p")
    replaced = F.when(~longer & (p < size), F.struct(F.substring("word", F.lit(1), p).alias("pre"), _from("word", p + 1).alias("post"), F.substring("word", p + 1, F.lit(1)).alias("middle")))
    inserted = F.when(longer, F.struct(F.substring("word", F.lit(1), p).alias("pre"), _from("word", p + 1).alias("post"), F.substring("word", p + 1, F.lit(1)).alias("middle")))
    inserted = inserted.otherwise(F.struct(F.substring("word", F.lit(1), p).alias("pre"), _from("word", p).alias("post"), F.lit("").alias("middle")))
    single = single.select("short", "n", (p + 1).alias("limit"), F.explode(F.array_compact(F.array(replaced, inserted))).alias("s"))
    single = single.select("short", "limit", "s.pre", "s.post", "s.middle", "n")
    ahead = F.length("pre") + STEP
    deeper = rows.where(forward & (ahead < F.col("limit"))).select("short", "limit", F.substring("word", F.lit(1), ahead).alias("pre"), "post", _from("word", ahead).alias("middle"), "n")
    limit = F.col("limit") - STEP
    tail = F.length("word") - (F.col("short") - limit)
    back = rows.where(~forward & (limit > 0)).select("short", limit.alias("limit"), "pre", _from("word", tail).alias("post"), F.substring("word", F.lit(1), tail).alias("middle"), "n")
    return single.unionByName(deeper).unionByName(back)


_STATE = ("short", "limit", "pre", "post")


def near_words(words: DataFrame, most: int = MOST) -> DataFrame:
    """``word, n_near, form_n, form`` of the words that have near ones: their number, and the most frequent one."""
    need(words, "word", "n")
    rows, parts = initial_states(words), []
    while True:
        # words that differ in one character alone are no more than there are letters, and cannot be split
        sizes = rows.groupBy(*_STATE).agg(F.count("*").alias("words"), F.max(F.length("middle")).alias("longest"))
        large = stage(sizes.where((F.col("words") > most) & (F.col("longest") > 1)).select(*_STATE), "large-states")
        if large.isEmpty():
            parts.append(rows)
            break
        parts.append(rows.join(large, list(_STATE), "left_anti"))
        rows = stage(split_states(rows.join(large, list(_STATE), "left_semi")), "split-states")
    every = parts[0]
    for more in parts[1:]:
        every = every.unionByName(more)
    dealt = every.repartition(*_STATE).sortWithinPartitions(*_STATE, "middle")
    found = dealt.select(*_STATE, "middle", "n").mapInArrow(_work, PARTIAL)
    best = F.min(F.struct((-F.col("form_n")).alias("less"), "form")).alias("best")
    whole = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best)
    return whole.select("word", "n_near", (-F.col("best.less")).alias("form_n"), "best.form")


def roots(forms: DataFrame) -> DataFrame:
    """``word, root`` from ``word, form``, in which no word leads back to itself: each round doubles the steps taken."""
    now = stage(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        onward = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        if now.join(onward, "root", "left_semi").isEmpty():
            return now
        now = stage(now.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root")), "roots")


def group(words: DataFrame, ratio: int = 2, most: int = MOST) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of a vocabulary ``word, n``."""
    need(words, "word", "n")
    words = stage(words.select("word", F.col("n").cast("long").alias("n")), "words")
    met = words.join(near_words(words, most), "word", "left")
    is_form = F.col("form_n") >= ratio * F.col("n")
    met = stage(met.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(is_form, F.col("form")).alias("form"), F.when(is_form, F.col("form_n")).alias("form_n")), "near-words")
    found = met.join(roots(met.where("form IS NOT NULL")), "word", "left")
    return found.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
