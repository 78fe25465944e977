"""A corpus from raw documents to piece ids, in five stages.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is
written and read again as the next stage's documents. All but the last return
the columns of ``documents``, so their decisions are the rows and texts that
are left. Rows without ``doc_id`` cannot be told apart and leave at the first
stage; of rows with one ``doc_id`` all stay until near-duplicate removal, which
treats them as one document.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockpond.llm import decontaminate, lang_id, line_dedup, order_minhash, piece_codec
from stockpond.llm.common import table
from stockpond.session import stage

#: Documents whose main language covers less than this share of their letters are rejected.
LEAST_SHARE = 0.5


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters, or of no main language, go; nothing is learned from empty labels."""
    known = docs.where(F.col("doc_id").isNotNull())
    found = lang_id.predict(known, lang_id.fit(known)).where(
        (F.col("lang_pred") != lang_id.UNKNOWN) & (F.col("score") >= LEAST_SHARE))
    return found.select(*docs.columns)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines found in ten different documents or more go; documents of which nothing is left go with them.

    Copies count once: which of them stays is for near-duplicate removal.
    """
    kept = line_dedup.dedup_lines(docs, once_per_text=True)
    empty = (F.col("n_dropped") > 0) & (F.trim("text") == "")
    changed = F.when(F.col("n_dropped") > 0, F.length("text").cast("bigint")).otherwise(F.col("n_chars"))
    return kept.where(~empty).withColumn("n_chars", changed).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates stays, the one with the smallest ``doc_id``."""
    return order_minhash.keep_one(docs)


def decontaminate_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold an item of the benchmark go."""
    return decontaminate.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_pieces, piece_ids, round_trip): every document as piece ids, decoded again as a check."""
    coded = piece_codec.encode(docs.select("doc_id", "text"), check=True)
    return coded.select("doc_id", F.size("piece_ids").cast("bigint").alias("n_pieces"), "piece_ids", "round_trip")


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", drop_repeated_lines),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", decontaminate_benchmark),
    ("piece_encoding", encode_pieces),
]

#: Near duplicates and pieces cannot be written as SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), name)
    return docs
