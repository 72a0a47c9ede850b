"""One query for each operator, with production parameters, over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martkit.llm import ans, bpe_tree, decontamination, extraction, licenses, maxent, mixing, near, quality, runs, secrets, tokens, variants
from martkit.llm.catalog import query, table
from martkit.llm.common import TOKEN
from martkit.session import scratch_path, shared_root

#: The word pattern of the contracts and A-Z lowered, in SQL.
WORDS_SQL = r"regexp_extract_all(translate(coalesce({0}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
TOKENS_SQL = r"regexp_extract_all(coalesce({0}, ''), '[^\x20\x09-\x0D]+')"

OP2_SQL = f"""
WITH item AS (SELECT item_id, {WORDS_SQL.format("text")} AS w FROM benchmark),
win AS (
  SELECT item_id, w[i:i + 9] AS g FROM (SELECT item_id, w, unnest(range(1, len(w) - 8)) AS i FROM item WHERE len(w) >= 10)
  UNION SELECT item_id, w FROM item WHERE len(w) BETWEEN 1 AND 9
),
size AS (SELECT DISTINCT len(g) AS n FROM win),
doc AS (SELECT doc_id, {WORDS_SQL.format("text")} AS w FROM documents),
gram AS (SELECT doc_id, i, n, w[i:i + n - 1] AS g FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM doc, size WHERE len(w) >= n)),
place AS (SELECT doc_id, i, n, item_id FROM gram JOIN win USING (g)),
word AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM place) GROUP BY doc_id),
found AS (SELECT doc_id, count(*) AS n_items, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids
  FROM (SELECT DISTINCT doc_id, item_id FROM place WHERE item_id IS NOT NULL) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN word USING (doc_id) LEFT JOIN found USING (doc_id)
"""


@query("op2_benchmark_decontamination", OP2_SQL)
def op2(spark: SparkSession, folder: str) -> DataFrame:
    found = decontamination.scan(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def _distance_sql(kind: str, reference: str) -> str:
    """Jensen-Shannon distance of each document's histogram to its language's, from long tables of counts."""
    part = "CASE WHEN {0} > 0 THEN {0} * log2(2 * {0} / ({0} + {1})) ELSE 0 END"
    return f"""SELECT doc_id, sqrt(greatest(sum({part.format("p", "q")} + {part.format("q", "p")}) / 2, 0)) AS d
      FROM (SELECT h.doc_id, h.c / sum(h.c) OVER (PARTITION BY h.doc_id) AS p, r.c / sum(r.c) OVER (PARTITION BY h.doc_id) AS q
        FROM hist h JOIN {reference} r ON h.lang IS NOT DISTINCT FROM r.lang AND h.kind = r.kind AND h.k = r.k
        WHERE h.kind = '{kind}' AND h.n > 0 AND r.c IS NOT NULL) WHERE q IS NOT NULL GROUP BY doc_id"""


def _reference_sql(passing: str) -> str:
    return f"SELECT lang, kind, k, sum(c)::DOUBLE AS c FROM hist WHERE doc_id IN ({passing}) GROUP BY ALL"


def _kept_sql(reference: str) -> str:
    return f"""SELECT f.doc_id FROM feature f LEFT JOIN ({_distance_sql("c", reference)}) x USING (doc_id) LEFT JOIN ({_distance_sql("w", reference)}) y USING (doc_id)
      WHERE NOT base_failed AND NOT coalesce(n_chars >= {quality.MIN_CHARS} AND n_words >= {quality.MIN_WORDS}
        AND x.d > {quality.MAX_CHAR_DISTANCE} AND y.d > {quality.MAX_WORD_DISTANCE}, false)"""


_GONE = "length(t) - length(regexp_replace(t, '{0}', '', 'g'))"
_OTHERS = ("[a-z]", r"[\x20\x09-\x0D]", "[A-Z]", "[#*$%&|<>]", "[0-9]")
_CLASSES = [_GONE.format(c) for c in _OTHERS] + [_GONE.format(r"[\x21-\x7E]") + "".join(" - (" + _GONE.format(c) + ")" for c in ("[a-z]", "[A-Z]", "[#*$%&|<>]", "[0-9]")), r"length(regexp_replace(t, '[\x09-\x0D\x20-\x7E]', '', 'g'))"]
_COMMON = ", ".join(f"'{w}'" for w in quality.COMMON_WORDS)
OP5_SQL = rf"""
WITH doc AS (SELECT doc_id, lang, coalesce(text, '') AS t, {TOKENS_SQL.format("text")} AS w FROM documents),
gram AS (SELECT doc_id, i, w[i:i + 2] AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM doc WHERE len(w) >= 3)),
rep AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + 3)) AS p FROM gram QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1) GROUP BY doc_id),
line AS (SELECT doc_id, count(*) - count(DISTINCT x) AS n FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS x FROM doc) WHERE regexp_matches(x, '[^\x20\x09-\x0D]') GROUP BY doc_id),
feature AS (SELECT doc_id, lang, t, w, length(t) AS n_chars, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(length(array_to_string(w, '')), 0) AS BIGINT) AS word_chars,
  CAST({_GONE.format("[#*$%&|<>]")} AS BIGINT) AS n_symbols, coalesce(line.n, 0) AS n_dup_lines, coalesce(rep.n, 0) AS n_repeat_words,
  len(w) < 50 OR 100 * coalesce(rep.n, 0) > 50 * len(w) AS base_failed
  FROM doc LEFT JOIN rep USING (doc_id) LEFT JOIN line USING (doc_id)),
shape AS (SELECT doc_id, lang, n_chars, n_words, [{", ".join(_CLASSES)}] AS c,
  list_append([len(list_filter(w, lambda x: x = y)) FOR y IN [{_COMMON}]], len(list_filter(w, lambda x: NOT list_contains([{_COMMON}], x)))) AS h FROM feature),
hist AS (SELECT doc_id, lang, 'c' AS kind, n_chars AS n, unnest(range(1, 8)) AS k, unnest(c)::DOUBLE AS c FROM shape
  UNION ALL SELECT doc_id, lang, 'w', n_words, unnest(range(1, {len(quality.COMMON_WORDS) + 2})), unnest(h)::DOUBLE FROM shape),
first AS ({_reference_sql("SELECT doc_id FROM feature WHERE NOT base_failed")}),
final AS ({_reference_sql(_kept_sql("first"))}),
kept AS ({_kept_sql("final")})
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, doc_id IN (SELECT doc_id FROM kept) AS kept FROM feature
"""


@query("op5_quality_divergence", OP5_SQL)
def op5(spark: SparkSession, folder: str) -> DataFrame:
    return quality.rate(table(spark, folder, "documents")).drop("char_distance", "word_distance")


_SHARE = "least((middle + ({0}) * source_size) / target, 1.0::DOUBLE)"
_POSITION = f"CASE WHEN slope = 0 THEN {_SHARE} ELSE 2 * {_SHARE} / (1 - slope + sqrt(greatest((1 - slope) * (1 - slope) + 4 * slope * {_SHARE}, 0))) END"
OP6_SQL = f"""
WITH doc AS (SELECT doc_id, source, CAST(len({TOKENS_SQL.format("text")}) AS BIGINT) AS size, md5(CAST(doc_id AS VARCHAR)) AS turn FROM documents),
src AS (SELECT source, sum(size) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place FROM doc GROUP BY source),
cap AS (SELECT *, place % 3 + 1 AS weight, 3.0::DOUBLE * source_size AS cap, 3.0::DOUBLE * source_size / (place % 3 + 1) AS ratio FROM src),
lev AS (SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY ratio, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
  / sum(weight) OVER (ORDER BY ratio, place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM cap),
aim AS (SELECT source, CAST(source_size AS BIGINT) AS source_size, ((place % 3) - 1) / 2.0::DOUBLE AS slope,
  least(cap, weight * (SELECT level FROM lev WHERE level <= ratio ORDER BY ratio, place LIMIT 1)) AS target FROM lev),
mid AS (SELECT doc_id, d.source, size, source_size, target, slope,
  sum(size) OVER (PARTITION BY d.source ORDER BY turn, doc_id, size ROWS UNBOUNDED PRECEDING) - size / 2.0::DOUBLE AS middle
  FROM doc d JOIN aim a ON d.source IS NOT DISTINCT FROM a.source),
use AS (SELECT *, CASE WHEN size > 0 THEN least(greatest(ceil((target - middle) / source_size), 0), 3) ELSE 0 END AS passes FROM mid)
SELECT doc_id, size, source_size, round(target, 3) AS target, CAST(size * passes AS BIGINT) AS taken,
  CASE WHEN passes > 0 THEN round({_POSITION.format(0)}, 9) END AS first_position, CASE WHEN passes > 0 THEN round({_POSITION.format("passes - 1")}, 9) END AS last_position FROM use
"""


@query("op6_curriculum_mix", OP6_SQL)
def op6(spark: SparkSession, folder: str) -> DataFrame:
    # in training order; the times of a document's first and last use, as the schedules give them
    mixed = mixing.curriculum(table(spark, folder, "documents"))
    first, last = F.get("positions", F.lit(0)), F.try_element_at("positions", F.lit(-1))
    return mixed.select(
        "doc_id", "size", "source_size", F.round("target", 3).alias("target"), "taken", F.round(first, 9).alias("first_position"), F.round(last, 9).alias("last_position")
    )


@query("op1_token_counts")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    # one cache for all runs on this cluster: a text that any of them has counted is not encoded again
    counted = tokens.count(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"), f"{shared_root(spark).rstrip('/')}/martkit/token-cache")
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 1024).alias("over_limit"))


_TEMPLATES = ", ".join(f"({k}, '{t.label}', {str(t.exact).lower()}, {t.words.split()})" for k, t in enumerate(licenses.TEMPLATES))
OP3_SQL = f"""
WITH doc AS (SELECT doc_id, {WORDS_SQL.format("text")} AS w FROM documents),
template AS (SELECT * FROM (VALUES {_TEMPLATES}) t(template, label, exact, p)),
known AS (SELECT template, place, p[place + 1:place + {licenses.K}] AS g FROM (SELECT *, unnest(range(len(p) - {licenses.K - 1})) AS place FROM template)),
gram AS (SELECT doc_id, i, w[i + 1:i + {licenses.K}] AS g FROM (SELECT doc_id, w, unnest(range(len(w) - {licenses.K - 1})) AS i FROM doc WHERE len(w) >= {licenses.K})),
vote AS (SELECT DISTINCT doc_id, template, i - place AS diagonal, place FROM gram JOIN known USING (g)),
line AS (SELECT doc_id, template, diagonal, list(place) AS places, min(place) AS low, max(place) AS high FROM vote GROUP BY ALL),
cut AS (SELECT line.*, label, exact, len(p) AS size, CASE WHEN coalesce(diagonal - lag(diagonal) OVER w <= CASE WHEN exact THEN 0 ELSE {licenses.SHIFT} END, false) THEN 0 ELSE 1 END AS far
  FROM line JOIN template USING (template) WINDOW w AS (PARTITION BY doc_id, template ORDER BY diagonal)),
passage AS (SELECT *, sum(far) OVER (PARTITION BY doc_id, template ORDER BY diagonal ROWS UNBOUNDED PRECEDING) AS passage FROM cut),
span AS (SELECT doc_id, template, label, exact, min(diagonal + low) AS first_word,
  len(list_distinct(flatten(list_transform(flatten(list(places)), lambda x: range(x, x + {licenses.K}))))) / any_value(size) AS score FROM passage GROUP BY doc_id, template, label, exact, passage),
held AS (SELECT * FROM span WHERE score >= CASE WHEN exact THEN 1 ELSE {licenses.COVERAGE} END),
found AS (SELECT doc_id, count(*) FILTER (template < {licenses.BASE_COUNT}) AS n_base, min(first_word) FILTER (template < {licenses.BASE_COUNT}) AS first_word,
  max(first_word) FILTER (template < {licenses.BASE_COUNT}) AS last_word, string_agg(DISTINCT label, ',' ORDER BY label) FILTER (template < {licenses.BASE_COUNT}) AS base_labels,
  string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(score) AS score FROM held GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word, coalesce(base_labels, '') AS base_labels,
  coalesce(labels, '') AS labels, coalesce(score, 0)::DOUBLE AS score FROM doc LEFT JOIN found USING (doc_id)
"""


@query("op3_license_diagonals", OP3_SQL)
def op3(spark: SparkSession, folder: str) -> DataFrame:
    found = licenses.scan(table(spark, folder, "documents"))
    whole = [F.col(c).cast("long").alias(c) for c in ("n_words", "n_base", "first_word", "last_word")]
    return found.select("doc_id", *whole, "base_labels", "labels", "score")


@query("op4_linked_secrets")
def op4(spark: SparkSession, folder: str) -> DataFrame:
    found = secrets.scan(table(spark, folder, "documents"))
    base = F.filter("spans", lambda s: s["rank"] < len(secrets.BASE))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    counts = [count(p.kind) for p in secrets.BASE]
    return found.select("doc_id", *counts, F.sha2(secrets.as_text(base), 256).alias("base_sha256"), secrets.as_text(F.col("spans")).alias("spans"))


#: The id that ends a document in the contract of the token files.
END_ID = 2


@query("op10_token_files")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "token-files")
    ans.write(table(spark, folder, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"), END_ID)
    return ans.decoded(ans.read(spark, path))


@query("op9_near_duplicate_forest")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    return near.classes(table(spark, folder, "documents")).select("doc_id", "class_id", "n_links")


@query("op8_main_text")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    return extraction.extract(table(spark, folder, "pages"))


@query("op7_maxent_scores")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    return maxent.score(table(spark, folder, "documents"))


#: CRC-32 of a text's UTF-8 bytes, whose table is worked out from its rule.
CRC_SQL = """crc_table AS (SELECT list(v ORDER BY k) AS t FROM (SELECT k, list_reduce(list_prepend(k, range(8)), lambda c, i: xor(c >> 1, (c & 1) * 3988292384)) AS v
  FROM (SELECT unnest(range(256)) AS k)))"""


def _crc_sql(text: str) -> str:
    """Needs ``crc_table`` in scope as column ``t``."""
    bytes_of = f"list_transform(range(octet_length(encode({text}))), lambda i: CAST('0x' || substr(hex(encode({text})), 2 * i + 1, 2) AS BIGINT))"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {bytes_of}), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295)"


OP11_SQL = f"""
WITH {CRC_SQL},
doc AS (SELECT doc_id, {TOKENS_SQL.format("text")} AS w, {_crc_sql("CAST(doc_id AS VARCHAR)")} AS h FROM documents, crc_table),
plan AS (SELECT doc_id, w, len(w) AS n, h % 10 = 0 AND len(w) > 0 AS planted, h // 10 AS g, (h // 10) % greatest(len(w), 1) AS a FROM doc),
word AS (SELECT doc_id, i, w[1 + CASE WHEN planted AND i >= a THEN a + (i - a) % (1 + (n - a) // (3 + g % 8)) ELSE i END] AS x
  FROM (SELECT *, unnest(range(n)) AS i FROM plan)),
pair AS (SELECT u.doc_id, u.i, v.i - u.i AS q FROM word u JOIN word v ON u.doc_id = v.doc_id AND u.x = v.x AND v.i > u.i JOIN plan p ON p.doc_id = u.doc_id AND 4 * (v.i - u.i) <= p.n),
island AS (SELECT doc_id, q, min(i) AS start, count(*) + q AS length FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS g FROM pair) GROUP BY doc_id, q, g),
long AS (SELECT * FROM island WHERE length >= greatest(6, 4 * q)),
run AS (SELECT * FROM long l WHERE NOT EXISTS (SELECT 1 FROM long s WHERE s.doc_id = l.doc_id AND s.q < l.q AND s.start <= l.start AND s.start + s.length >= l.start + l.length)),
best AS (SELECT doc_id, start, length, q AS period, length * 1000 // q AS exponent_milli FROM run
  QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY length / q DESC, start, q) = 1),
listed AS (SELECT doc_id, count(*) AS n_runs, string_agg(start || ',' || length || ',' || q || chr(10), '' ORDER BY start, q) AS s FROM run GROUP BY doc_id),
gone AS (SELECT DISTINCT doc_id, unnest(range(start + q, start + length)) AS i FROM run),
kept AS (SELECT doc_id, string_agg(x, ' ' ORDER BY i) AS s FROM word ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, start, length, period, CAST(exponent_milli AS BIGINT) AS exponent_milli,
  sha256(coalesce(listed.s, '')) AS runs_sha256, sha256(coalesce(kept.s, '')) AS collapsed_sha256
FROM doc LEFT JOIN listed USING (doc_id) LEFT JOIN best USING (doc_id) LEFT JOIN kept USING (doc_id)
"""


def planted_runs(docs: DataFrame) -> DataFrame:
    """``doc_id, text``: in the tenth of the documents that the contract picks, the words from a place on are its own first ones again and again."""
    rows = docs.select("doc_id", "text", F.crc32(F.col("doc_id").cast("string").cast("binary")).alias("h"))
    words = F.regexp_extract_all("text", F.lit(TOKEN), F.lit(0))
    g = F.floor(F.col("h") / 10)
    planted = rows.withColumn("w", F.when(F.col("h") % 10 == 0, words)).withColumn("n", F.size("w"))
    a = (g % F.greatest(F.col("n"), F.lit(1))).cast("int")
    planted = planted.withColumn("a", a).withColumn("p", (1 + F.floor((F.col("n") - a) / (3 + g % 8))).cast("int"))
    times = F.ceil((F.col("n") - F.col("a")) / F.col("p")).cast("int")
    tail = F.slice(F.flatten(F.array_repeat(F.slice("w", F.col("a") + 1, F.col("p")), times)), F.lit(1), F.col("n") - F.col("a"))
    whole = F.array_join(F.concat(F.slice("w", F.lit(1), F.col("a")), tail), " ")
    return planted.select("doc_id", F.when(F.col("w").isNotNull() & (F.col("n") > 0), whole).otherwise(F.col("text")).alias("text"))


@query("op11_periodic_runs", OP11_SQL)
def op11(spark: SparkSession, folder: str) -> DataFrame:
    found = runs.find(planted_runs(table(spark, folder, "documents")))
    # the greatest exact quotient; the runs come by start and period, so the first of equal ones stays
    larger = lambda best, r: F.when(best.isNull() | (r["length"] * best["period"] > best["length"] * r["period"]), r).otherwise(best)
    best = F.reduce("runs", F.get("runs", F.lit(0)), larger)
    line = lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))
    listed = F.array_join(F.transform("runs", line), "")
    rows = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("b"), F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
    return rows.select(
        "doc_id", "n_runs", "b.start", "b.length", "b.period", F.floor(1000 * F.col("b.length") / F.col("b.period")).alias("exponent_milli"),
        "runs_sha256", "collapsed_sha256",
    )


OP12_SQL = f"""
WITH RECURSIVE {CRC_SQL},
run AS (SELECT doc_id, r, count(*) AS c FROM (SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-zÀ-ÿ]+')) AS r FROM documents) GROUP BY doc_id, r),
made AS (SELECT c, CASE WHEN h % 97 = 0 THEN substr(r, 1, h % length(r)) || substr(r, h % length(r) + 2) ELSE r END AS word
  FROM (SELECT r, c, {_crc_sql("doc_id || ':' || r")} AS h FROM run, crc_table)),
word AS (SELECT word, CAST(sum(c) AS BIGINT) AS n FROM made WHERE length(word) >= 5 GROUP BY word HAVING sum(c) >= 3),
less AS (SELECT word, n, p, substr(word, 1, p) || substr(word, p + 2) AS rest FROM (SELECT *, unnest(range(length(word))) AS p FROM word)),
pair AS (SELECT a.word, b.word AS other, b.n FROM less a JOIN less b ON a.rest = b.rest AND a.p = b.p AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM word a JOIN less b ON a.word = b.rest UNION SELECT b.word, a.word, a.n FROM word a JOIN less b ON a.word = b.rest),
best AS (SELECT word, count(*) AS n_near, arg_min(other, (-n, other)) AS form, max(n) AS form_n FROM pair GROUP BY word),
named AS (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN form_n >= 2 * w.n THEN form END AS form, CASE WHEN form_n >= 2 * w.n THEN form_n END AS form_n FROM word w LEFT JOIN best USING (word)),
path AS (SELECT word, word AS at FROM named UNION ALL SELECT path.word, named.form FROM path JOIN named ON path.at = named.word WHERE named.form IS NOT NULL),
ends AS (SELECT path.word, path.at AS root FROM path JOIN named ON path.at = named.word WHERE named.form IS NULL)
SELECT word, form, root, n, n_near, form_n FROM named JOIN ends USING (word)
"""


def _typo(doc_id: Column, run: Column) -> Column:
    """The contract's misspellings: of one in 97 pairs of document and word, a character goes."""
    h = F.crc32(F.concat(doc_id.cast("string"), F.lit(":"), run).cast("binary"))
    at = (h % F.length(run)).cast("int")
    return F.when(h % 97 == 0, F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.length(run)))).otherwise(run)


@query("op12_spelling_variants", OP12_SQL)
def op12(spark: SparkSession, folder: str) -> DataFrame:
    return variants.group(variants.count_words(table(spark, folder, "documents"), rewrite=_typo))


@query("op13_bpe_tree")
def op13(spark: SparkSession, folder: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    both = bpe_tree.decode(bpe_tree.encode(table(spark, folder, "documents"), ranks), ranks)
    return both.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
