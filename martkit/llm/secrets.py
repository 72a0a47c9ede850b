"""Secret scans that link the parts of a credential, in DataFrame functions only.

Strong findings (assignments, access identifiers, long hex) stand alone. Weak parts - account names, short or unnamed
secrets, endpoints - mean little on their own; an interval join within a scope of some characters reports them only where
complementary parts occur together.

Cases: null texts count as empty: no spans, digest of an empty list. Repeated rows and ids are rows of their own. Equal
spans of two kinds are both listed, in the order of the kinds. Clashing extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martkit.llm.common import id_text, stage


@dataclass(frozen=True)
class Part:
    """A kind of span: its pattern, the group whose length counts, the least length, and what it is part of."""

    kind: str
    pattern: str
    group: int
    least: int
    role: str


_ASSIGNED = r"""["']?\x20*[:=]\x20*["']?"""
#: Fixed values of the contract, in its order.
BASE = (
    Part("assign", r"(?i)(password|passwd|secret|token|api_?key)" + _ASSIGNED + r"([A-Za-z0-9+/_.=-]+)", 2, 8, "secret"),
    Part("access", r"AKIA[A-Z0-9]+", 0, 16, "identifier"),
    # the runs of 32 and more are the same with or without the shorter ones, which are not worth listing
    Part("hex", r"[0-9a-f]{32,}", 0, 32, "secret"),
)
WEAK = (
    Part("weak_access", r"(?i)\b(user(?:name)?|login|account|client_?id|access_?key_?id)" + _ASSIGNED + r"([A-Za-z0-9@_.-]+)", 2, 3, "identifier"),
    Part("weak_secret", r"(?i)\b(pwd|pass|passphrase|private_?key|access_?key|auth|bearer)" + _ASSIGNED + r"([A-Za-z0-9+/_.=-]+)", 2, 4, "secret"),
    Part("weak_blob", r"(?<![A-Za-z0-9+/=_-])[A-Za-z0-9+/]{40}(?![A-Za-z0-9+/=_-])", 0, 40, "secret"),
    Part("endpoint", r"(?:https?|ftps?|sftp|jdbc:[a-z0-9]+|postgres(?:ql)?|mysql|mongodb|redis|amqps?|s3)://[^\x00-\x20\x22\x27<>]+", 0, 10, "endpoint"),
)
#: Parts link when at most this many code points lie between them.
SCOPE = 300


def _found(part: Part) -> Column:
    """Lengths (before, match, counted group) of all matches, leftmost first and not overlapping; null without any."""
    pattern = F.lit(part.pattern)
    matches = F.regexp_extract_all("text", pattern, F.lit(0))
    between = F.slice(F.split("text", part.pattern, -1), 1, F.size(matches))
    counted = F.regexp_extract_all("text", pattern, F.lit(part.group))
    zipped = F.arrays_zip(between.alias("b"), matches.alias("m"), counted.alias("c"))
    lengths = F.transform(zipped, lambda x: F.struct(F.length(x["b"]).alias("before"), F.length(x["m"]).alias("size"), F.length(x["c"]).alias("counted")))
    return F.when(F.col("text").rlike(part.pattern), lengths)


def parts(docs: DataFrame, kinds: tuple[Part, ...], id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(documents, spans): a row number with its id, and ``row, kind, start, end`` in code points, end exclusive."""
    texts = id_text(docs, id_col, text_col).withColumn("row", F.monotonically_increasing_id())
    found = stage(texts.select("row", "doc_id", *[_found(p).alias(p.kind) for p in kinds]), "secrets")
    listed = F.array(*[F.struct(F.lit(p.kind).alias("kind"), F.lit(k).alias("rank"), F.lit(p.least).alias("least"), F.lit(p.role).alias("role"), F.col(p.kind).alias("all")) for k, p in enumerate(kinds)])
    some = found.where(F.coalesce(*[F.col(p.kind) for p in kinds]).isNotNull()).select("row", F.explode(listed).alias("p"))
    one = some.select("row", "p.kind", "p.rank", "p.least", "p.role", F.posexplode("p.all").alias("place", "m"))
    upto = Window.partitionBy("row", "kind").orderBy("place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    spans = one.withColumn("end", F.sum(F.col("m.before") + F.col("m.size")).over(upto)).where(F.col("m.counted") >= F.col("least"))
    return found.select("row", "doc_id"), spans.select("row", "kind", "rank", "role", (F.col("end") - F.col("m.size")).alias("start"), "end")


def _near(left: DataFrame, right: DataFrame, scope: int) -> DataFrame:
    """Rows of ``left`` with a span of ``right`` within the scope: an equi-join on cells of the text as wide as the scope.

    Both sides are entered in each cell that they touch, the right one widened by the scope, so that neighbours meet in one.
    """
    cell = lambda c: F.floor(c / scope)
    spread = F.sequence(cell(F.col("start") - scope), cell(F.col("end") + scope))
    other = right.select(F.col("row").alias("_row"), F.col("start").alias("_start"), F.col("end").alias("_end"), F.explode(spread).alias("_cell"))
    own = left.withColumn("_own", F.explode(F.sequence(cell(F.col("start")), cell(F.col("end")))))
    meets = (F.col("row") == F.col("_row")) & (F.col("_own") == F.col("_cell"))
    close = (F.col("_start") - F.col("end") <= scope) & (F.col("start") - F.col("_end") <= scope)
    # spans of one kind do not overlap, so that these columns name a span that meets others in several cells
    return own.join(other, meets & close, "left_semi").drop("_own").dropDuplicates(["row", "kind", "start"])


def _clear(left: DataFrame, right: DataFrame, width: int = SCOPE) -> DataFrame:
    """Rows of ``left`` that overlap no span of ``right`` in the same text. Both sides are entered in the cells that they touch,
    so that a text of many spans compares neighbours alone."""
    touched = lambda: F.explode(F.sequence(F.floor(F.col("start") / width), F.floor((F.greatest("end", F.col("start") + 1) - 1) / width)))
    other = right.select(F.col("row").alias("_row"), F.col("start").alias("_start"), F.col("end").alias("_end"), touched().alias("_cell"))
    own = left.withColumn("_own", touched())
    same = (F.col("row") == F.col("_row")) & (F.col("_own") == F.col("_cell"))
    overlapping = own.join(other, same & (F.col("start") < F.col("_end")) & (F.col("_start") < F.col("end")), "left_semi")
    return left.join(overlapping.select("row", "kind", "start").distinct(), ["row", "kind", "start"], "left_anti")


def link(strong: DataFrame, weak: DataFrame, scope: int = SCOPE) -> DataFrame:
    """The weak parts that complementary ones confirm: identifiers and secrets each other, endpoints both together."""
    weak = _clear(weak, strong)
    everything = strong.unionByName(weak)
    role = lambda df, name: df.where(F.col("role") == name)
    secrets = _near(role(weak, "secret"), role(everything, "identifier"), scope)
    names = _near(role(weak, "identifier"), role(everything, "secret"), scope)
    ends = _near(_near(role(weak, "endpoint"), role(everything, "identifier"), scope), role(everything, "secret"), scope)
    return secrets.unionByName(names).unionByName(ends)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", scope: int = SCOPE) -> DataFrame:
    """Per document ``row, doc_id, spans`` (sorted by start, then kind) of strong parts and confirmed weak ones."""
    ids, spans = parts(docs, BASE + WEAK, id_col, text_col)
    spans = stage(spans, "secret-spans")
    strong, weak = spans.where(F.col("rank") < len(BASE)), spans.where(F.col("rank") >= len(BASE))
    all_spans = strong.unionByName(link(strong, weak, scope))
    each = all_spans.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("start", "rank", "end", "kind"))).alias("spans"))
    return ids.join(each, "row", "left").withColumn("spans", F.coalesce("spans", F.array().cast(each.schema["spans"].dataType)))


def as_text(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
