"""N-gram Jaccard join with a MinHash LSH forest and exact verification.

A text's content is the set of its five-word shingles; texts with equal sets are copies and form one node. Each of the
forest's trees labels a node with eight minima of hashed shingles. The labels of all trees are sorted over the range of
partitions; in that order each prefix of a trie is a stretch, and two neighbours tell how far their labels agree. Nodes whose
longest common prefix with a neighbour is too short for the recall wanted have no partner in that tree and go.

Nodes that share a prefix are tied to the prefix's first node. Matching starts with whole labels. Estimates over all minima
say how similar the tied nodes are; from these follows how large a share of the pairs at or above the threshold a prefix of
this length finds. While that is below the target, prefixes are shortened by one value: nodes that are surely near the first
node of their longer prefix are represented by it in the shorter one, the others are tied anew. Without a pair to measure, the
recall of a pair at the threshold itself counts, so that no pair is left to worse odds than the target.

Ties between nodes far apart are cut and what they leave over is tied anew, so that the components of the ties, the families,
stay tight and keep every pair within reach. In families all pairs are compared on their whole shingle sets, through an
inverted index; large families are dealt out as pairs of blocks of near sizes. Links are counted where they are found and
never listed as pairs.

Cases: null texts count as empty. Texts of fewer than five words are one shingle of all their words; texts without words are
copies of one another only if equal byte for byte, and link to nothing else. Repeated rows are copies. Null ids are ids like
others, but a class is named by its smallest id that is not null. Extra columns, whatever their names, are ignored by
``classes`` and kept by ``one_of_each``.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martkit.llm.common import TO_LOWER, WORD, attach, free_names, id_text, mix64, need, remembered, sent_if_small, stage
from martkit.llm.components import components

_WORD = re.compile(WORD)
GRAM = 5
TREES, DEPTH = 32, 8
#: Ties below the first estimate are cut; nodes tied below the second are tied again with the others left over. Between them
#: lies more than the distance of two linked texts, so these part only by an error of the estimate.
CUT, SURE = 0.4, 0.75
#: Rounds of cutting; what is left over then is tied without.
ROUNDS = 3
BLOCK_NODES, BLOCK_BYTES = 1000, 32 << 20

SKETCH = "doc_id long, h long, node long, n_shingles int, sig binary"


def recall(depth: int, threshold: float, trees: int = TREES) -> float:
    """Probability that a pair at the threshold matches to the depth in some tree."""
    return 1 - (1 - threshold**depth) ** trees


def depth_for(target: float, threshold: float, trees: int = TREES, depth: int = DEPTH) -> int:
    """The longest prefixes that find a pair at the threshold with the wanted odds: none need be shorter."""
    while depth > 1 and recall(depth, threshold, trees) < target:
        depth -= 1
    return depth


class _Hashes(dict):
    """Words to 64-bit hashes that are the same in every process; forgets when it has grown large."""

    def __missing__(self, word):
        if len(self) > 300_000:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"))
        return value


def shingles(text: str, hashes: dict, gram: int = GRAM) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's shingles."""
    words = _WORD.findall(text.translate(TO_LOWER))
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    n = max(1, len(h) - gram + 1)
    total = np.full(n, min(len(h), gram), np.uint64)
    for k in range(min(gram, len(h))):
        total = mix64(total + h[k : k + n])
    return np.unique(total)


def signer(trees: int, depth: int):
    draw = np.random.default_rng(20260)
    factor = draw.integers(0, 1 << 63, trees * depth, np.uint64) * np.uint64(2) + np.uint64(1)
    shift = draw.integers(0, 1 << 63, trees * depth, np.uint64)[:, None]

    def sign(found: np.ndarray) -> bytes:
        low = np.full(trees * depth, ~np.uint64(0))
        for at in range(0, len(found), 2048):
            np.minimum(low, (np.multiply.outer(factor, found[at : at + 2048]) + shift).min(axis=1), out=low)
        return (mix64(low) & np.uint64(0xFFFF)).astype(">u2").tobytes()

    return sign


def _worker_hashes() -> dict:
    return remembered("near").setdefault("words", _Hashes())


def sketch(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", trees: int = TREES, depth: int = DEPTH) -> DataFrame:
    """A row for each row of ``docs``: its text's hash, its node and the node's labels. Staged."""

    def work(batches):
        hashes, sign = _worker_hashes(), signer(trees, depth)
        for b in batches:
            for at in range(0, b.num_rows, 256):
                some = b.slice(at, 256)
                nodes, sizes, labels = [], [], []
                for text in some.column("text").to_pylist():
                    found = shingles(text, hashes)
                    own = found.tobytes() if len(found) else b"\0" + text.encode("utf-8", "surrogatepass")
                    nodes.append(xxhash.xxh3_64_intdigest(own) - (1 << 63))
                    sizes.append(len(found))
                    labels.append(sign(found) if len(found) else None)
                yield pa.RecordBatch.from_arrays(
                    [some.column("doc_id"), some.column("h"), pa.array(nodes, pa.int64()), pa.array(sizes, pa.int32()), pa.array(labels, pa.binary())],
                    names=["doc_id", "h", "node", "n_shingles", "sig"],
                )

    texts = id_text(docs, id_col, text_col)
    return stage(texts.withColumn("h", F.xxhash64("text")).select("doc_id", "h", "text").mapInArrow(work, SKETCH), "sketch")


def _estimate(batches):
    for b in batches:
        n = b.num_rows
        width = len(b.column("s")[0].as_py()) if n else 0
        both = [np.frombuffer(b"".join(b.column(c).to_pylist()), ">u2").reshape(n, -1) if n and width else np.zeros((n, 1)) for c in ("s", "t")]
        yield pa.RecordBatch.from_arrays([b.column("node"), b.column("lead"), pa.array((both[0] == both[1]).mean(axis=1), pa.float64())], names=["node", "lead", "estimate"])


TRIE = "tree int, label binary, node long, depth int"


def _in_order(batches, columns: tuple[str, ...]):
    """(tree, labels as rows of values, the columns) of each batch of sorted rows, from the last row of the one before on."""
    kept = None
    for b in batches:
        if not b.num_rows:
            continue
        if kept is not None:
            b = pa.Table.from_batches([kept, b]).combine_chunks().to_batches()[0]
        labels = np.frombuffer(b"".join(b.column("label").to_pylist()), ">u2").reshape(b.num_rows, -1)
        yield kept is None, b, b.column("tree").to_numpy(), labels
        kept = b.slice(b.num_rows - 1)


def _common(tree: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """Length of the common prefix of each row with the one before it; the first row has none."""
    same = (labels[1:] == labels[:-1]) & (tree[1:] == tree[:-1])[:, None]
    return np.concatenate(([0], np.logical_and.accumulate(same, axis=1).sum(axis=1)))


def _matching(low: int, whole: int):
    def work(batches):
        held = None  # the last row and its common prefix with the row before: the next row's is still unknown
        for first, b, tree, labels in _in_order(batches, ("tree", "label", "node")):
            common = _common(tree, labels)
            common[0] = whole if first else held  # partitions begin and end anywhere in a prefix: their edges stay
            depth = np.maximum(common[:-1], common[1:])
            held = common[-1]
            stays = np.flatnonzero(depth >= low)
            yield _with(b, stays, depth[stays])
            last = b.slice(b.num_rows - 1)
        if held is not None:
            yield _with(last, np.array([0]), np.array([whole]))

    return work


def _with(b: pa.RecordBatch, rows: np.ndarray, values: np.ndarray) -> pa.RecordBatch:
    some = b.select(["tree", "label", "node"]).take(pa.array(rows, pa.int64()))
    return pa.RecordBatch.from_arrays([*some.columns, pa.array(values.astype(np.int32), pa.int32())], names=["tree", "label", "node", "depth"])


def sorted_labels(rows: DataFrame) -> DataFrame:
    return rows.repartitionByRange("tree", "label", "node").sortWithinPartitions("tree", "label", "node")


def trie(nodes: DataFrame, low: int, trees: int = TREES, depth: int = DEPTH) -> DataFrame:
    """``tree, label, node, depth`` of the nodes that share a prefix of at least ``low`` values with another one in the tree;
    ``depth`` is the longest. Staged. Rows at the edges of partitions stay, whatever they share."""
    label = F.substring("sig", F.col("tree") * depth * 2 + 1, F.lit(depth * 2)).alias("label")
    every = nodes.select("sig", "node", F.explode(F.sequence(F.lit(0), F.lit(trees - 1))).alias("tree")).select("tree", label, "node")
    return stage(sorted_labels(every).mapInArrow(_matching(low, depth), TRIE), "trie")


MET = "tree int, label binary, node long, lead long"


def _leading(depth: int):
    def work(batches):
        lead, started, left, last_edge = None, False, None, None

        def out(b, rows, leads):
            some = b.select(["tree", "label", "node"]).take(pa.array(rows, pa.int64()))
            return pa.RecordBatch.from_arrays([*some.columns, pa.array(leads, pa.int64())], names=["tree", "label", "node", "lead"])

        for first, b, tree, labels in _in_order(batches, ("tree", "label", "node")):
            common = _common(tree, labels)
            node = b.column("node").to_numpy()
            begins = common < depth
            if first:
                yield out(b, np.array([0]), node[:1])  # the first prefix may have begun in the partition before
                lead = node[0]
            begins[0] = False  # the first row is one that has been dealt with, or leads
            at = np.maximum.accumulate(np.where(begins, np.arange(len(node)), -1))
            leads = np.where(at >= 0, node[at], lead)
            mine = np.flatnonzero(~begins)[1:]  # all but the first row and the leads
            yield out(b, mine, leads[mine])
            if at[-1] >= 0:
                lead = node[at[-1]]
                last_edge = (b, at[-1])
        if last_edge is not None:
            yield out(last_edge[0], np.array([last_edge[1]]), np.array([lead]))  # the last one may go on in the next

    return work


def leads(members: DataFrame, depth: int) -> DataFrame:
    """``tree, label, node, lead``: the members (tree, label, node) but the first of each prefix of ``depth`` values, with that
    first one. Staged."""
    met = stage(sorted_labels(members).mapInArrow(_leading(depth), MET), "prefixes")
    # a lead listed as its own is one of a prefix that may lie across partitions: of such there are two a partition at most
    prefix = F.substring("label", 1, 2 * depth)
    edges = met.where("node = lead").distinct().withColumn("prefix", prefix)
    least = edges.groupBy("tree", "prefix").agg(F.min(F.struct("label", "node")).alias("first"))
    across = edges.join(least, ["tree", "prefix"]).select("tree", "label", "node", F.col("first.node").alias("lead")).where("node <> lead")
    return met.where("node <> lead").unionByName(across)


def measured_recall(links: int, expected: float | None, depth: int, threshold: float) -> float:
    """Share of the pairs at or above the threshold that prefixes of this length find: the pairs found, against the number that
    they stand for by their odds; without any, the odds of a pair at the threshold."""
    return links / expected if links else recall(depth, threshold)


def _tie(members: DataFrame, nodes: DataFrame, depth: int, threshold: float, trees: int):
    """(ties, measured recall, rows represented by a node surely near) at one length of prefixes."""
    found, sure, links, expected = None, None, 0, 0.0
    join = lambda a, b: b if a is None else a.unionByName(b)
    for turn in range(ROUNDS + 1):
        met = stage(leads(members, depth), "met")
        pairs = stage(met.select("node", "lead").distinct(), "pairs")
        if turn == ROUNDS:
            return join(found, pairs), measured_recall(links, expected, depth, threshold), sure
        # labels are long; only those of nodes in pairs are shuffled
        ids = stage(pairs.select("node").unionAll(pairs.select("lead")).distinct(), "pair-nodes")
        some = stage(nodes.select("node", "sig").join(sent_if_small(ids, 16), "node", "left_semi"), "pair-labels")
        left = some.select("node", F.col("sig").alias("s"))
        right = some.select(F.col("node").alias("lead"), F.col("sig").alias("t"))
        rated = stage(pairs.join(left, "node").join(right, "lead").select("node", "lead", "s", "t").mapInArrow(_estimate, "node long, lead long, estimate double"), "ties")
        odds = 1 - F.pow(1 - F.pow("estimate", F.lit(float(depth))), F.lit(float(trees)))
        more = rated.where(F.col("estimate") >= threshold).agg(F.count("*").alias("n"), F.sum(1 / odds).alias("e")).first()
        links, expected = links + more.n, expected + (more.e or 0.0)
        found = join(found, rated.where(F.col("estimate") >= CUT).select("node", "lead"))
        judged = stage(met.join(rated, ["node", "lead"]), "judged")
        sure = join(sure, judged.where(F.col("estimate") >= SURE).select("tree", "node"))
        members = judged.where(F.col("estimate") < SURE).select("tree", "label", "node")
        if members.isEmpty():
            break
    return found, measured_recall(links, expected, depth, threshold), sure


def ties(nodes: DataFrame, threshold: float, target: float, trees: int = TREES, depth: int = DEPTH) -> DataFrame:
    """``node, lead``: nodes (node, sig) tied to the first node of a prefix that they share, prefixes shortened until the recall
    measured reaches the target."""
    low = depth_for(target, threshold, trees, depth)
    rows, found, represented = trie(nodes, low, trees, depth), None, None
    for now in range(depth, low - 1, -1):
        members = rows.where(F.col("depth") >= now).select("tree", "label", "node")
        if represented is not None:
            members = members.join(represented.distinct(), ["tree", "node"], "left_anti")
        tied, reached, sure = _tie(members, nodes, now, threshold, trees)
        found = tied if found is None else found.unionByName(tied)
        represented = sure if represented is None else represented.unionByName(sure)
        if reached >= target:
            break
    return found


def compare(sets: list[np.ndarray], side: np.ndarray | None, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """(links of each set, first set of its component). ``side``: only pairs across the two sides count."""
    m = len(sets)
    sizes = np.array([len(s) for s in sets], np.int64)
    owner = np.repeat(np.arange(m), sizes)
    values = np.concatenate(sets)
    order = np.argsort(values, kind="stable")
    owners, ordered = owner[order], values[order]
    first = np.concatenate(([True], ordered[1:] != ordered[:-1]))
    run = np.cumsum(first) - 1
    begin = np.flatnonzero(first)
    length = np.diff(np.append(begin, len(ordered)))
    code = np.empty(len(values), np.int64)
    code[order] = run
    ends = np.cumsum(sizes)
    links, parent = np.zeros(m, np.int64), list(range(m))

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    # of any ``slack`` shingles a set of a near partner holds at least one
    slack = sizes - np.ceil(threshold * sizes - 1e-9).astype(np.int64) + 1
    for a in range(m):
        own = code[ends[a] - sizes[a] : ends[a]]
        own = own[length[own] > 1]
        if sizes[a] - len(own) >= slack[a]:
            continue
        n = length[own]
        at = np.repeat(begin[own] - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum())
        common = np.bincount(owners[at], minlength=m)
        near = common >= threshold * (sizes + sizes[a] - common) - 1e-9
        near[a] = False
        near &= common > 0
        if side is not None:
            near &= side != side[a]
        met = np.flatnonzero(near)
        links[a] = len(met)
        for b in met[met > a].tolist():
            x, y = root(a), root(b)
            if x != y:
                parent[max(x, y)] = min(x, y)
    return links, np.array([root(a) for a in range(m)])


def _groups(batches, key: tuple[str, ...]):
    """Rows of each key, which follow one another, as lists."""
    now, rows = None, []
    for b in batches:
        for row in b.to_pylist():
            k = tuple(row[c] for c in key)
            if k != now and rows:
                yield now, rows
                rows = []
            now = k
            rows.append(row)
    if rows:
        yield now, rows


def verify(members: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """``node, links, root`` of the nodes in families, all pairs of a family compared. ``members``: family, node, n_shingles,
    doc_id, h of one document; ``texts``: doc_id, h, text.

    Families too large for one block are cut by size: sets whose sizes differ by more than the threshold allows cannot link, so
    blocks of one range of sizes meet each other and those of the next range alone."""
    total = members.groupBy("family").agg(F.count("*").alias("n"), (8 * F.sum("n_shingles")).alias("bytes"))
    is_large = (F.col("n") > BLOCK_NODES) | (F.col("bytes") > BLOCK_BYTES)
    large = stage(total.where(is_large).select("family", F.lit(True).alias("large")), "large-families")
    # a little wider than the threshold asks, so that rounding puts no two sets more than one range apart
    ranges = F.floor(F.log("n_shingles") / (-math.log(threshold) * (1 + 1e-9))).cast("int")
    known = members.join(sent_if_small(large, 16), "family", "left").withColumn("range", F.when(F.col("large"), ranges).otherwise(0)).drop("large")
    known = stage(known.select("family", "range", "node", "n_shingles", "doc_id", "h"), "family-ranges")
    size = known.groupBy("family", "range").agg(F.count("*").alias("n"), (8 * F.sum("n_shingles")).alias("bytes"))
    blocks = F.greatest(F.ceil(F.col("n") / BLOCK_NODES), F.ceil(F.col("bytes") / BLOCK_BYTES)).cast("int")
    by = Window.partitionBy("family").orderBy("range")
    beside = lambda step: F.when(F.lead("range", step).over(by) == F.col("range") + step, F.lead(blocks, step).over(by)).otherwise(0)
    size = stage(size.select("family", "range", blocks.alias("blocks"), beside(1).alias("above"), beside(-1).alias("below")), "family-blocks")
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    known = known.join(sent_if_small(size, 40), ["family", "range"]).withColumn("own", own).drop("n_shingles")
    known = stage(known, "family-members")
    one = texts.withColumnsRenamed({"doc_id": "_i", "h": "_h"})
    same = F.col("_i").eqNullSafe(F.col("doc_id")) & (F.col("_h") == F.col("h"))
    with_text = one.join(sent_if_small(known, 64), same).dropDuplicates(["node"])
    block = lambda r, i: F.struct(r.alias("r"), i.cast("int").alias("i"))
    mine = block(F.col("range"), F.col("own"))
    to = lambda n: F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
    meets = F.concat(
        F.transform(to(F.col("blocks")), lambda k: block(F.col("range"), k)),
        F.transform(to(F.col("above")), lambda k: block(F.col("range") + 1, k)),
        F.transform(to(F.col("below")), lambda k: block(F.col("range") - 1, k)),
    )
    rows = with_text.select("family", "node", "text", mine.alias("mine"), F.explode(meets).alias("other"))
    rows = rows.select("family", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"), (F.col("mine") <= F.col("other")).alias("side"), "node", "text")

    def work(batches):
        hashes = _worker_hashes()
        for (_, i, j), group in _groups(batches, ("family", "i", "j")):
            sets = [shingles(r["text"], hashes) for r in group]
            side = np.array([r["side"] for r in group]) if i != j else None
            links, root = compare(sets, side, threshold)
            nodes = [r["node"] for r in group]
            yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(links, pa.int64()), pa.array([nodes[k] for k in root], pa.int64())], names=["node", "links", "root"])

    rows = rows.select("family", F.concat_ws(":", "i.r", "i.i").alias("i"), F.concat_ws(":", "j.r", "j.i").alias("j"), "side", "node", "text")
    dealt = rows.repartition("family", "i", "j").sortWithinPartitions("family", "i", "j", "node")
    return stage(dealt.mapInArrow(work, "node long, links long, root long"), "links")


def classes(docs: DataFrame, threshold: float = 0.8, target: float = 0.999, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row ``doc_id, h, node, class, class_id, n_links, first``: the class is a component of links, ``class_id`` its smallest
    id, ``n_links`` the number of other contents with at least the threshold's share of shingles in common, ``first`` the id
    and hash of the class's document with the smallest id."""
    rows = sketch(docs, id_col, text_col)
    place = F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "h")
    nodes = rows.groupBy("node").agg(
        F.first("sig").alias("sig"), F.max("n_shingles").alias("n_shingles"), F.min("doc_id").alias("id"), F.min(place).alias("first"), F.count("*").alias("copies")
    )
    nodes = stage(nodes, "nodes")
    shingled = nodes.where("n_shingles > 0").select("node", "sig")
    family = components(ties(shingled, threshold, target), "node", "lead")
    members = family.withColumnRenamed("root", "family").join(nodes, "node").select("family", "node", "n_shingles", "first.doc_id", "first.h")
    texts = id_text(docs, id_col, text_col).withColumn("h", F.xxhash64("text"))
    found = verify(stage(members, "families"), texts, threshold)
    root = components(found, "node", "root").withColumnRenamed("root", "class")
    links = found.groupBy("node").agg(F.sum("links").alias("n_links"))
    linked = stage(links.join(root, "node").join(nodes.select("node", "id", "first"), "node"), "linked")
    named = stage(linked.groupBy("class").agg(F.min("id").alias("class_id"), F.min("first").alias("first")), "named")
    linked = attach(linked.drop("id", "first"), named, "class", ("node",), 48)
    alone = nodes.where("copies > 1").join(linked.select("node"), "node", "left_anti")
    alone = alone.select("node", F.lit(0).cast("long").alias("n_links"), F.col("node").alias("class"), F.col("id").alias("class_id"), "first")
    known = stage(linked.select(*alone.columns).unionByName(alone), "known")
    placed = attach(rows.select("doc_id", "h", "node"), known, "node", ("doc_id", "h"), 64)
    is_known = F.col("class").isNotNull()
    return placed.select(
        "doc_id", "h", "node", F.coalesce("class", "node").alias("class"), F.when(is_known, F.col("class_id")).otherwise(F.col("doc_id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.when(is_known, F.col("first")).otherwise(place).alias("first"),
    )


def one_of_each(docs: DataFrame, threshold: float = 0.8, target: float = 0.999, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents with all their columns, one of each class: the one with the smallest id."""
    need(docs, id_col, text_col)
    found = stage(classes(docs, threshold, target, id_col, text_col), "classes")
    its_id, its_hash, own = free_names(docs, "its_id", "its_hash", "own_hash")
    # what goes is far less than what stays
    is_first = F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "h").eqNullSafe(F.col("first"))
    go = found.where(~is_first).select(F.col("doc_id").alias(its_id), F.col("h").alias(its_hash)).distinct()
    again = not found.groupBy("doc_id", "h").count().where("count > 1").isEmpty()
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    marked = docs.withColumn(own, F.xxhash64(text))
    same = F.col(f"`{id_col}`").cast("long").eqNullSafe(F.col(its_id)) & (F.col(own) == F.col(its_hash))
    kept = marked.join(sent_if_small(stage(go, "dropped"), 32), same, "left_anti")
    if again:  # rows that repeat an id with its text are one document
        kept = kept.dropDuplicates([id_col, own])
    return kept.select(*[f"`{c}`" for c in docs.columns])
