"""The registered queries of the operators, each over its whole table, and the SQL of those that have one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockpond.llm import (
    decontaminate,
    hard_negatives,
    hidden_markov,
    lang_id,
    line_dedup,
    order_minhash,
    periodic_runs,
    piece_codec,
    piece_counts,
    pivot_search,
    quality_rules,
    secret_scan,
    token_shards,
)
from stockpond.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def _query(fn: Callable[[SparkSession, str], DataFrame]):
    QUERIES[fn.__name__] = fn
    return fn


@_query
def op1_training_order(spark: SparkSession, folder: str) -> DataFrame:
    """All documents as shards of shuffled sequences; one row per sequence."""
    return token_shards.write_shards(table(spark, folder, "documents"), token_shards.shard_folder(spark))


@_query
def op2_order_minhash(spark: SparkSession, folder: str) -> DataFrame:
    """The class of near duplicates of every document."""
    return order_minhash.classes(table(spark, folder, "documents"))


@_query
def op3_pivot_search(spark: SparkSession, folder: str) -> DataFrame:
    """The twenty highest inner products of every twentieth vector with all others."""
    found = pivot_search.top_k(table(spark, folder, "embeddings"), F.col("vec_id") % 20 == 0)
    return found.select("query_id", "rank", "vec_id", "score")


SQL["op3_pivot_search"] = """
WITH whole AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS DOUBLE)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, x.vec_id, CAST(list_dot_product(q.v, x.v) AS BIGINT) AS score
  FROM whole q JOIN whole x ON q.vec_id <> x.vec_id WHERE q.vec_id % 20 = 0
), ranked AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
         vec_id, score FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
"""


@_query
def op4_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Secrets of every document: base patterns and runs that pass the randomness battery."""
    return secret_scan.secrets(table(spark, folder, "documents"))


@_query
def op5_hidden_markov(spark: SparkSession, folder: str) -> DataFrame:
    """Log probabilities of every document under the unigram base and the hidden Markov model."""
    docs = table(spark, folder, "documents")
    held_out = lang_id.fold_of(F.col("doc_id"), 5) == 1
    scored = hidden_markov.score(docs, ~held_out)
    return scored.select("doc_id", (lang_id.fold_of(F.col("doc_id"), 5) == 1).alias("held_out"), "n_tokens", "n_known",
                         "train_tokens", "base_score", "score")


@_query
def op6_lang_id(spark: SparkSession, folder: str) -> DataFrame:
    """The language of every document, learned from two thirds of them."""
    docs = table(spark, folder, "documents")
    held_out = lang_id.fold_of(F.col("doc_id"), 3) == 1
    model = lang_id.fit(docs.where(~held_out))
    return lang_id.predict(docs.select("doc_id", held_out.alias("held_out"), "text"), model).drop("text")


@_query
def op7_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """The number of unigram pieces of every document."""
    counted = piece_counts.count_tokens(table(spark, folder, "documents").select("doc_id", "text"))
    return counted.select("doc_id", "n_tokens", "n_words", "path_score")


@_query
def op8_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    """Every document as piece ids, decoded again: number and digest of the ids, and whether the text came back."""
    coded = piece_codec.encode(table(spark, folder, "documents").select("doc_id", "text"), check=True)
    return coded.select("doc_id", F.size("piece_ids").cast("bigint").alias("n_pieces"),
                        F.xxhash64("piece_ids").alias("ids_hash"), "round_trip")


@_query
def op9_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Lines found in ten documents or more leave every document."""
    kept = line_dedup.dedup_lines(table(spark, folder, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


@_query
def op10_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """The benchmark items that each document contains."""
    return decontaminate.leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


SQL["op9_line_dedup"] = """
WITH cut AS (
  SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
), line AS (
  SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM cut
), keyed AS (
  SELECT doc_id, line, pos, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM line
), common AS (
  SELECT key FROM keyed WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10
), marked AS (
  SELECT k.doc_id, k.line, k.pos, c.key IS NOT NULL AS gone FROM keyed k LEFT JOIN common c ON k.key = c.key
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""


@_query
def op11_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    """The periodic runs of words of every document, some of which are made periodic first."""
    docs = table(spark, folder, "documents")
    found = periodic_runs.runs_of(docs.select("doc_id", "text"), alter=F.crc32(F.col("doc_id").cast("string").cast("binary")))
    lines = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    top = F.when(F.size("runs") > 0, periodic_runs.longest_run(F.col("runs")))
    listed = F.when(F.size("runs") > 0, F.concat(lines, F.lit("\n"))).otherwise(F.lit(""))
    return found.select("doc_id", F.size("runs").cast("bigint").alias("n_runs"), F.sha2(listed, 256).alias("runs_sha256"),
                        F.sha2("collapsed", 256).alias("collapsed_sha256"), top.alias("top")).select(
        "doc_id", "n_runs", "top.start", "top.length", "top.period",
        F.expr("top.length * 1000 div top.period").alias("exponent_milli"), "runs_sha256", "collapsed_sha256")


@_query
def op12_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    """Hard negatives for the positives of every fiftieth vector."""
    moved = F.expr("CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END")
    return hard_negatives.mine(table(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0, moved)


SQL["op12_hard_negatives"] = """
WITH whole AS (
  SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE)) AS v
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.r, a.vec_id AS anchor_id, x.vec_id, a.label = x.label AS same,
         CAST(list_dot_product(a.v, x.v) AS BIGINT) AS score
  FROM whole a JOIN whole x ON a.vec_id <> x.vec_id WHERE a.vec_id % 50 = 0
), positive AS (
  SELECT r, anchor_id, vec_id AS positive_id, score AS positive_score,
         row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS place
  FROM scored WHERE same QUALIFY place <= 5
), negative AS (
  SELECT p.anchor_id, p.positive_id, p.positive_score, s.vec_id AS negative_id, s.score AS negative_score,
         row_number() OVER (PARTITION BY p.r, p.place ORDER BY s.score DESC, s.vec_id) AS place
  FROM positive p JOIN scored s ON p.r = s.r
  WHERE NOT s.same AND 50 * positive_score <= 100 * s.score AND 100 * s.score <= 95 * positive_score
)
SELECT anchor_id, positive_id, CAST(place AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM negative WHERE place <= 3
"""


@_query
def op13_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    """The measures of every document, and whether it passes the base and all rules."""
    rated = quality_rules.rate(table(spark, folder, "documents"))
    return rated.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


_BLANK = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_STOP = ", ".join(f"'{w}'" for w in dict.fromkeys(quality_rules.STOP_WORDS))

SQL["op13_quality_rules"] = f"""
WITH given AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents
), cut AS (
  SELECT r, doc_id, text,
         list_filter(string_split(translate(text, {_BLANK}, repeat(' ', 6)), ' '), lambda w: w <> '') AS words,
         list_filter(string_split(text, chr(10)), lambda l: trim(l, {_BLANK}) <> '') AS lines
  FROM given
), gram AS (
  SELECT r, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS g
  FROM (SELECT r, words, unnest(range(1, len(words) - 1)) AS i FROM cut)
), twice AS (
  SELECT r, i, lead(i) OVER (PARTITION BY r ORDER BY i) AS following
  FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM gram) WHERE n > 1
), repeated AS (
  SELECT r, sum(least(3, coalesce(following - i, 3))) AS n FROM twice GROUP BY r
), measured AS (
  SELECT doc_id, len(words) AS n_words, length(translate(text, {_BLANK}, '')) AS word_chars,
         length(text) - length(translate(text, '#*$%&|<>', '')) AS n_symbols,
         len(lines) - len(list_distinct(lines)) AS n_dup_lines,
         CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words,
         len(list_filter(words, lambda w: regexp_matches(w, '\\p{{L}}'))) AS letter_words,
         len(list_filter(words, lambda w: translate(lower(w), '.,;:!?"''()', '') IN ({_STOP}))) AS stop_words,
         len(lines) AS n_lines,
         len(list_filter(lines, lambda l: left(trim(l, {_BLANK}), 1) IN ('-', '*', '•', '–'))) AS bullets,
         len(list_filter(lines, lambda l: suffix(trim(l, {_BLANK}), '...') OR suffix(trim(l, {_BLANK}), '…'))) AS open_lines
  FROM cut LEFT JOIN repeated USING (r)
), based AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM measured
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND 10 * word_chars BETWEEN 20 * n_words AND 150 * n_words AND 100 * n_symbols <= 10 * n_words
       AND 100 * letter_words >= 60 * n_words AND 1000 * stop_words >= 20 * n_words AND 100 * bullets <= 90 * n_lines
       AND 100 * open_lines <= 30 * n_lines AND 100 * n_dup_lines <= 50 * n_lines AS kept
FROM based
"""
