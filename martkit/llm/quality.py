"""Quality rules by distribution divergence, in DataFrame functions only.

A document's character classes and common words are histograms; the Jensen-Shannon distance to its language's reference,
summed over all documents of that language that pass the base rules, decides. Texts too short for a histogram to say
anything are judged by the base rules alone.

Cases: null texts count as empty: no words, so the base rules reject them. A null or unknown language is a language of its
own. Repeated rows are judged alike. A language without any document that passes the base rules has no reference, and
distances to it are null, which rejects nothing. Clashing extra columns never reach the computation (``keep`` hands them on).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martkit.llm.common import need, stage

#: White space and symbols of the contract, and common words of four languages.
SPACE = r"[\x20\x09-\x0D]"
SYMBOLS = "[#*$%&|<>]"
COMMON_WORDS = (
    "the of and to in is that for it as with on be by was "
    "der die und den von das ist mit des sich "
    "de la le les et en un une du que pour dans qui "
    "el los las del se por con para su"
).split()
MIN_CHARS, MIN_WORDS = 200, 50
MAX_CHAR_DISTANCE, MAX_WORD_DISTANCE = 0.165, 0.2

_BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _length(c: str) -> Column:
    return F.length(c).cast("long")


def _without(c: str, pattern: str) -> Column:
    return F.regexp_replace(F.col(c), pattern, "")


def _add(df: DataFrame, **columns: Column) -> DataFrame:
    return df.withColumns(columns)


def features(docs: DataFrame, text_col: str = "text", keep_rest: bool = False) -> DataFrame:
    """The contract's counts and both histograms, beside the columns of ``docs`` (without ``keep_rest``: without its text).

    Names of its own columns start with ``_q``; each step feeds the next, so no pattern runs twice over a text.
    """
    df = _add(docs, _qt=F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")))
    if not keep_rest:
        df = df.drop(text_col)
    df = _add(
        df, _qw=F.array_remove(F.split("_qt", SPACE + "+"), ""), _qa=_without("_qt", "[a-z]+"),
        _ql=F.filter(F.split("_qt", "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]")),
    )
    df = _add(df, _qn=F.size("_qw"), _qb=_without("_qa", SPACE + "+"))
    df = _add(
        df, _qc=_without("_qb", "[A-Z]+"),
        _qg=F.when(
            F.col("_qn") >= 3,
            F.transform(F.sequence(F.lit(0), F.col("_qn") - 3), lambda i: F.xxhash64(F.get("_qw", i), F.get("_qw", i + 1), F.get("_qw", i + 2))),
        ),
        _qh=F.filter("_qw", lambda x: x.isin(COMMON_WORDS)),
    )
    df = _add(df, _qd=_without("_qc", SYMBOLS + "+"), _qr=F.size(F.array_distinct("_qg")) < F.size("_qg"))
    df = _add(df, _qe=_without("_qd", "[0-9]+"), _qs=F.when(F.col("_qr"), F.sort_array(F.transform("_qg", lambda g, i: F.struct(g.alias("g"), i.alias("i"))))))
    df = _add(df, _qf=_without("_qe", r"[\x21-\x7E]+"), _qp=_repeated("_qs"))
    sizes = [_length(c) for c in ("_qt", "_qa", "_qb", "_qc", "_qd", "_qe", "_qf")]
    classes = [a - b for a, b in zip(sizes, sizes[1:])] + [sizes[-1]]
    words = [(F.size("_qh") - F.size(F.array_remove("_qh", w))).cast("long") for w in COMMON_WORDS]
    df = _add(
        df, _q_n_words=F.col("_qn").cast("long"), _q_word_chars=sizes[0] - (sizes[1] - sizes[2]), _q_n_symbols=sizes[3] - sizes[4],
        _q_n_dup_lines=(F.size("_ql") - F.size(F.array_distinct("_ql"))).cast("long"), _q_n_repeat_words=_covered("_qp"),
        _q_classes=F.array(*classes), _q_words=F.array(*words, (F.col("_qn") - F.size("_qh")).cast("long")),
    )
    df = df.drop("_qt", "_qw", "_qa", "_ql", "_qn", "_qb", "_qc", "_qg", "_qh", "_qd", "_qr", "_qe", "_qs", "_qf", "_qp")
    failed = (F.col("_q_n_words") < 50) | (100 * F.col("_q_n_repeat_words") > 50 * F.col("_q_n_words"))
    return df.withColumn("_q_base_failed", failed)


def _repeated(s: str) -> Column:
    """Ascending places of 3-word windows that occur twice or more, from windows sorted by hash."""

    def place(k: Column) -> Column:
        own = F.get(s, k)
        return F.when((F.get(s, k - 1)["g"] == own["g"]) | (F.get(s, k + 1)["g"] == own["g"]), own["i"])

    return F.when(F.col(s).isNotNull(), F.sort_array(F.filter(F.transform(F.sequence(F.lit(0), F.size(s) - 1), place), lambda x: x.isNotNull())))


def _covered(p: str) -> Column:
    """Words in the windows at these places, each once."""
    gaps = F.aggregate(
        F.when(F.size(p) > 1, F.sequence(F.lit(0), F.size(p) - 2)), F.lit(0), lambda total, k: total + F.least(F.lit(3), F.get(p, k + 1) - F.get(p, k))
    )
    return F.when(F.size(p) > 0, F.coalesce(gaps, F.lit(0)) + 3).otherwise(0).cast("long")


def references(found: DataFrame, lang_col: str = "lang", passing: str = "NOT _q_base_failed") -> DataFrame:
    """Per language the histograms of all its ``passing`` documents: one row for each language."""
    parts = {"_q_classes": 7, "_q_words": len(COMMON_WORDS) + 1}
    sums = [F.sum(F.when(F.expr(passing), F.get(c, F.lit(k)))).alias(f"{c}{k}") for c, n in parts.items() for k in range(n)]
    total = found.groupBy(F.col(f"`{lang_col}`").alias("_q_lang")).agg(*sums)
    return total.select("_q_lang", *[F.array(*[f"{c}{k}" for k in range(n)]).alias(f"{c}_ref") for c, n in parts.items()])


def js_distance(counts: str, reference: str) -> Column:
    """Square root of the Jensen-Shannon divergence, in bits, of two histograms given as counts; null if either is empty."""
    total = lambda c: F.aggregate(F.col(c), F.lit(0.0), lambda a, x: a + F.coalesce(x, F.lit(0)).cast("double"))
    n, m = total(counts), total(reference)
    shares = F.zip_with(counts, reference, lambda a, b: F.struct((a / F.nullif(F.col("_q_n"), F.lit(0.0))).alias("p"), (b / F.nullif(F.col("_q_m"), F.lit(0.0))).alias("q")))
    part = lambda x, y: F.when(x > 0, x * F.log2(2 * x / (x + y))).otherwise(0.0)
    sums = F.aggregate(shares, F.lit(0.0), lambda a, s: a + (part(s["p"], s["q"]) + part(s["q"], s["p"])) / 2)
    return n, m, F.when((F.col("_q_n") > 0) & (F.col("_q_m") > 0), F.sqrt(F.greatest(sums, F.lit(0.0))))


def judge(
    found: DataFrame, reference: DataFrame, lang_col: str = "lang", min_chars: int = MIN_CHARS, min_words: int = MIN_WORDS,
    max_char_distance: float = MAX_CHAR_DISTANCE, max_word_distance: float = MAX_WORD_DISTANCE,
) -> DataFrame:
    """``features`` with distances and the verdict ``_q_kept``: a text long enough goes if both distances exceed their limits."""
    df = found.join(reference, F.col(f"`{lang_col}`").eqNullSafe(F.col("_q_lang")), "left")
    for counts, name in (("_q_classes", "_q_char_distance"), ("_q_words", "_q_word_distance")):
        n, m, distance = js_distance(counts, f"{counts}_ref")
        df = df.withColumn("_q_n", n).withColumn("_q_m", m).withColumn(name, distance)
    enough_chars = F.aggregate("_q_classes", F.lit(0).cast("long"), lambda a, x: a + x) >= min_chars
    far = (F.col("_q_char_distance") > max_char_distance) & (F.col("_q_word_distance") > max_word_distance)
    far = F.coalesce(enough_chars & (F.col("_q_n_words") >= min_words) & far, F.lit(False))
    return df.withColumn("_q_kept", ~F.col("_q_base_failed") & ~far)


def settled(found: DataFrame, lang_col: str = "lang", **limits) -> DataFrame:
    """References without the documents that a first reference already rejects, so that junk does not shape them."""
    first = judge(found, references(found, lang_col), lang_col, **limits)
    return stage(references(first.withColumn("_q_own", F.col(f"`{lang_col}`")).drop("_q_lang"), "_q_own", "_q_kept"), "quality-ref")


def rate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", **limits) -> DataFrame:
    """Per document the counts, both distances and the verdict. Texts are read once: the features are staged."""
    need(docs, id_col, text_col, lang_col)
    plain = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{lang_col}`").alias("lang"), F.col(f"`{text_col}`").alias("text"))
    found = stage(features(plain), "quality")
    rated = judge(found, settled(found, **limits), **limits)
    return rated.select(
        "doc_id", *[F.col(f"_q_{c}").alias(c) for c in _BASE], F.col("_q_base_failed").alias("base_failed"), F.col("_q_kept").alias("kept"),
        F.col("_q_char_distance").alias("char_distance"), F.col("_q_word_distance").alias("word_distance"),
    )


def keep(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", **limits) -> DataFrame:
    """The documents that pass, with all their columns. The second pass works the features out again rather than
    shuffle all texts to join a verdict to them."""
    need(docs, text_col, lang_col)
    names = docs.columns
    # while the rules are applied the columns go by their places, so that no name of theirs meets one used here
    docs = docs.toDF(*[f"c{k}" for k in range(len(names))])
    text_col, lang_col = (f"c{names.index(c)}" for c in (text_col, lang_col))
    plain = docs.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
    reference = settled(stage(features(plain), "quality"), **limits)
    judged = judge(features(docs, text_col, keep_rest=True), reference, lang_col, **limits)
    # the planner would write the whole chain of steps out, many times over, to test the verdict at the scan; a column that
    # depends on the row's place keeps the test above the steps
    judged = judged.withColumn("_q_row", F.monotonically_increasing_id())
    return judged.where("_q_kept AND _q_row >= 0").select(*[F.col(f"c{k}").alias(n) for k, n in enumerate(names)])
