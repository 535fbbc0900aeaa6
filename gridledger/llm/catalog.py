"""The operators as queries over the given tables, with production parameters."""

from __future__ import annotations

from pathlib import Path

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridledger.llm import (
    backoff,
    bpe,
    cells,
    licenses,
    mining,
    mixing,
    passages,
    periods,
    personal,
    quality,
    simhash,
    topk,
    toxicity,
)
from gridledger.session import tune
from gridledger.sources import read_table

QUERIES = {}
ORACLES: dict[str, str] = {}


def prepare(spark: SparkSession) -> SparkSession:
    """Settings of the plans; Python workers of a local session find the package where the driver has it.

    On a cluster the package is installed or sent along with ``--py-files``.
    """
    spark.sparkContext.environment.setdefault("PYTHONPATH", str(Path(__file__).parents[2]))
    return tune(spark)


def _query(fn):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(prepare(spark), sf_dir)

    run.__doc__ = fn.__doc__
    QUERIES[fn.__name__] = run
    return fn


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, sf_dir, name, suffix=".parquet")


def remainder(doc_id):
    """crc32 of an id's text mod 5."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5


@_query
def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of documents whose fingerprints are linked by 2 or fewer differing bits."""
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"))


@_query
def op2_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 vectors of highest integer inner product for every 50th vector."""
    return topk.top_k(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, 5)


ORACLES["op2_topk"] = """
WITH v AS (
    SELECT vec_id, [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS w
    FROM embeddings
    WHERE embedding IS NOT NULL
      AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), s AS (
    SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
           CAST(list_sum([q.w[i] * c.w[i] FOR i IN range(1, len(q.w) + 1)]) AS BIGINT) AS score
    FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id AND len(q.w) = len(c.w)
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
WHERE rank <= 5
"""


def _equal(k: int):
    return lambda c: c == k


@_query
def op3_personal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every document: counts and digest of fixed shapes, and all spans."""
    found = personal.find_personal_data(_table(spark, sf_dir, "documents"))
    # A second parameter of a filter's function, even one with a default, would be the element's place.
    kinds = F.transform("base", lambda s: s["kind"])
    counts = [
        F.size(F.filter(kinds, _equal(k))).cast("long").alias(f"n_{kind}") for k, kind in enumerate(personal.KINDS)
    ]
    return found.select(
        "doc_id", *counts, F.sha2(personal.named(F.col("base")), 256).alias("base_sha256"),
        personal.named(F.col("spans")).alias("spans"))


@_query
def op4_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log probabilities of every document under a model of four fifths of them."""
    return backoff.score_texts(_table(spark, sf_dir, "documents"), remainder("doc_id") != 1)


def training_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity labels that may be learnt from."""
    labels = _table(spark, sf_dir, "labels").where(remainder("doc_id") != 0)
    return labels.select(F.col("doc_id").alias("id"), "toxic")


@_query
def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document; a fifth of the labels is held out."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, training_labels(spark, sf_dir))
    return toxicity.score_toxicity(docs, model).select(
        "doc_id", F.coalesce(remainder("doc_id") == 0, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))


@_query
def op6_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of vectors of one label at a cosine of 0.98 or more."""
    return cells.near_duplicate_vectors(_table(spark, sf_dir, "embeddings"))


ORACLES["op6_cells"] = """
WITH RECURSIVE v AS (
    SELECT vec_id, label, [CAST(x AS DOUBLE) FOR x IN embedding] AS e FROM embeddings
), u AS (
    SELECT vec_id, label, e, sqrt(list_dot_product(e, e)) AS length FROM v
    WHERE label IS NOT NULL AND len(e) > 0 AND len([x FOR x IN e IF x IS NULL OR NOT isfinite(x)]) = 0
), links AS (
    SELECT a.vec_id AS a, b.vec_id AS b
    FROM u a JOIN u b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
    WHERE a.length > 0 AND b.length > 0 AND list_dot_product(a.e, b.e) / (a.length * b.length) >= 0.98
), reach AS (
    SELECT vec_id AS node, vec_id AS root FROM v
    UNION
    SELECT links.b, reach.root FROM reach JOIN links ON links.a = reach.node WHERE reach.root < links.b
), least AS (
    SELECT node, min(root) AS root FROM reach GROUP BY node
), degree AS (
    SELECT a AS node, count(*) AS n FROM links GROUP BY a
)
SELECT vec_id, coalesce(n, 0) AS n_links, root AS component_id, vec_id = root AS kept
FROM v JOIN least ON least.node = vec_id LEFT JOIN degree ON degree.node = vec_id
"""


@_query
def op7_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and notices of every document."""
    found = licenses.scan_licenses(_table(spark, sf_dir, "documents"))
    base = F.filter("places", lambda p: p["exact"])
    joined = lambda places: F.array_join(
        F.array_sort(F.array_distinct(F.transform(places, lambda p: p["label"]))), ",")
    firsts = F.transform(base, lambda p: p["first"])
    return found.select(
        "doc_id", "n_words", F.size(base).cast("long").alias("n_base"), F.array_min(firsts).cast("long").alias("first_word"),
        F.array_max(firsts).cast("long").alias("last_word"), joined(base).alias("base_labels"),
        joined(F.col("places")).alias("labels"),
        F.coalesce(F.array_max(F.transform("places", lambda p: p["cover"])), F.lit(0.0)).alias("score"))


@_query
def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's block and slot when sources weigh the square root of their size."""
    return mixing.mix_sources(_table(spark, sf_dir, "documents")).select(
        "doc_id", "source", "mix_block", "mix_slot", "mix_place")


@_query
def op9_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines and sentences that an earlier document, or place, has already, in runs of 20 words or more."""
    return passages.repeated_passages(_table(spark, sf_dir, "documents"))


@_query
def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every document's token ids and of the bytes they decode to."""
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe.digests(_table(spark, sf_dir, "documents"), str(path), public_tokenizers.PATTERN)


@_query
def op11_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Length and repetition measures of every document, and the verdict of the rules."""
    return quality.judge(_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def _breaks(rules) -> str:
    """A row of measures breaks one of the rules, in SQL."""
    out = []
    for rule in rules:
        per = f"CAST({rule.per} AS DOUBLE)" if rule.per else "CAST(1 AS DOUBLE)"
        out += [f"CAST({rule.measure} AS DOUBLE) {sign} {per} * CAST({bound} AS DOUBLE)"
                for sign, bound in (("<", rule.low), (">", rule.high)) if bound is not None]
    return "(" + " OR ".join(out) + ")"


_STOPS = ", ".join(f"'{w}'" for w in quality.STOP_WORDS)
ORACLES["op11_quality"] = rf"""
WITH t AS (
    SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
           list_filter(string_split(coalesce(text, ''), chr(10)), lambda s: regexp_matches(s, '[^\x20\x09-\x0D]')) AS lines
    FROM documents
), windows AS (
    SELECT r, unnest([{{'at': i, 'words': w[i:i + 7]}} FOR i IN range(1, len(w) - 6)], recursive := true) FROM t
), places AS (
    SELECT r, "at", count(*) OVER (PARTITION BY r, words) AS times FROM windows
), steps AS (
    SELECT r, lead("at") OVER (PARTITION BY r ORDER BY "at") - "at" AS step FROM places WHERE times > 1
), repeats AS (
    SELECT r, CAST(sum(least(coalesce(step, 8), 8)) AS BIGINT) AS n_repeat_words FROM steps GROUP BY r
), m AS (
    SELECT doc_id, len(w) AS n_words, CAST(coalesce(list_sum([length(x) FOR x IN w]), 0) AS BIGINT) AS word_chars,
           len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols,
           len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
           length(text) - length(replace(text, '!', '')) AS n_marks,
           len([x FOR x IN w IF regexp_full_match(x, '[!-@\[-`{{-~]+')]) AS n_letterless_words,
           len(regexp_extract_all(text, '[A-ZÀ-ÖØ-Þ]')) AS n_capitals,
           len([x FOR x IN w IF lower(x[1]) || substr(regexp_replace(x, '[,.]$', ''), 2) IN ({_STOPS})]) AS n_stop_words,
           len(lines) AS n_lines, len(regexp_extract_all(text, '(?m)^[ \t]*[-*•|#]')) AS n_listed_lines,
           len(regexp_extract_all(text, '(?m)(\.\.\.|…)$')) AS n_open_lines
    FROM t LEFT JOIN repeats USING (r)
)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, word_chars, CAST(n_symbols AS BIGINT) AS n_symbols,
       CAST(n_dup_lines AS BIGINT) AS n_dup_lines, n_repeat_words, {_breaks(quality.BASE)} AS base_failed,
       NOT ({_breaks(quality.BASE)} OR {_breaks(quality.RULES)}) AS kept
FROM m
"""


@_query
def op12_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth vector; a seventh of the labels is moved on by one."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = _table(spark, sf_dir, "embeddings").select("vec_id", "embedding", moved.alias("label"))
    return mining.hard_negatives(vectors, F.col("vec_id") % 100 == 0)


ORACLES["op12_negatives"] = """
WITH v AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS w
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL
      AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), s AS (
    SELECT a.vec_id AS anchor_id, c.vec_id AS vec_id, a.label = c.label AS same,
           CAST(list_sum([a.w[i] * c.w[i] FOR i IN range(1, len(a.w) + 1)]) AS BIGINT) AS score
    FROM v a JOIN v c ON a.vec_id % 100 = 0 AND a.vec_id <> c.vec_id AND len(a.w) = len(c.w)
), p AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, positive_id,
       CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) <= 10
"""


@_query
def op13_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of every document's words; a tenth of the documents is made to repeat first."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10)
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", F.when(h % 10 == 0, words).alias("words"), g.alias("g"))
    n = F.size("words")
    docs = docs.withColumn("a", F.when(n > 0, F.col("g") % n).cast("int"))
    docs = docs.withColumn("p", (1 + F.floor((n - F.col("a")) / (3 + F.col("g") % 8))).cast("int"))
    moved = F.transform("words", lambda w, i: F.when(i >= F.col("a"), F.get("words", F.col("a") + (i - F.col("a")) % F.col("p"))).otherwise(w))
    text = F.when(F.col("a").isNotNull(), F.array_join(moved, " ")).otherwise(F.col("text"))
    found = periods.find_runs(docs.select("doc_id", text.alias("text")))
    longest = F.get(F.sort_array(F.transform("runs", lambda r: F.struct((-r["length"]).alias("l"), r["start"], r["period"], r["length"]))), F.lit(0))
    listed = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    lines = F.when(F.size("runs") > 0, F.concat(F.array_join(listed, "\n"), F.lit("\n"))).otherwise(F.lit(""))
    found = found.withColumn("longest", longest)
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"),
        *[F.col(f"longest.{c}").cast("long").alias(c) for c in ("start", "length", "period")],
        F.floor(1000 * F.col("longest.length") / F.col("longest.period")).cast("long").alias("exponent_milli"),
        F.sha2(lines.cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))


ORACLES["op13_runs"] = r"""
WITH d AS (
    SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
           xor(list_reduce(list_prepend(4294967295, flatten([[CAST(ascii(c) AS BIGINT), 0, 0, 0, 0, 0, 0, 0] FOR c IN string_split(CAST(doc_id AS VARCHAR), '')])),
               lambda c, e: xor(xor(c, e) >> 1, (xor(c, e) & 1) * 3988292384)), 4294967295) AS h
    FROM documents
), e AS (
    SELECT *, h // 10 AS g, len(w) AS n, CASE WHEN h % 10 = 0 AND len(w) > 0 THEN (h // 10) % len(w) END AS a FROM d
), t AS (
    SELECT r, doc_id, n, CASE WHEN a IS NULL THEN w
           ELSE [w[1 + CASE WHEN i >= a THEN a + (i - a) % (1 + (n - a) // (3 + g % 8)) ELSE i END] FOR i IN range(0, n)] END AS w
    FROM e
), m AS (
    SELECT r, p, i FROM (
        SELECT r, p, [i FOR i IN range(0, n - p) IF w[i + 1] = w[i + p + 1]] AS same
        FROM (SELECT r, n, w, unnest(range(1, n // 4 + 1)) AS p FROM t)
    ), unnest(same) AS u(i) WHERE len(same) >= greatest(3 * p, 6 - p)
), islands AS (
    SELECT r, p, min(i) AS start, count(*) + p AS length
    FROM (SELECT r, p, i, i - row_number() OVER (PARTITION BY r, p ORDER BY i) AS island FROM m) GROUP BY r, p, island
), runs AS (
    SELECT r, start, length, min(p) AS period FROM islands WHERE length >= greatest(6, 4 * p) GROUP BY r, start, length
), per AS (
    SELECT r, count(*) AS n_runs, arg_min({'start': start, 'length': length, 'period': period}, [-length, start, period]) AS longest,
           string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS lines,
           list_distinct(flatten(list(range(start + period, start + length)))) AS gone
    FROM runs GROUP BY r
)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, longest.start AS start, longest.length AS length, longest.period AS period,
       CAST(1000 * longest.length // longest.period AS BIGINT) AS exponent_milli, sha256(coalesce(lines, '')) AS runs_sha256,
       sha256(array_to_string(CASE WHEN gone IS NULL THEN w ELSE [w[i + 1] FOR i IN range(0, n) IF NOT list_contains(gone, i)] END, ' ')) AS collapsed_sha256
FROM t LEFT JOIN per USING (r)
"""
