"""Reversible line deduplication: exact reference counts with sharded cuckoo filters in front.

A line counts once per document, by its key: blanks stripped at both ends and
A-Z lower-cased. Keys that occur in ``min_docs`` documents are *common* and
lose all their lines. The state of an index is two written tables:

* ``counts``: (shard, hi, lo, n), the exact number of documents of each key,
  a key being two 64-bit hashes of its text;
* ``filters``: one cuckoo filter per shard with the keys that are common now.

Adding documents raises counts, removing documents lowers them again; keys
that cross the limit are inserted into or deleted from the filter of their
shard. Lines are probed against the filters and only hits meet the exact
counts, so false positives of a filter never drop a line.

``once_per_text`` lets copies count once: a document is then counted under
the smallest hash of its keys, so documents of the same keys are one for the
count, however many they are, and all lose the same lines.

Null and empty texts are one empty line; an empty key is never common unless
``min_chars`` is 0. Rows with one ``doc_id`` are one document, rows without
``doc_id`` are together one more. Other columns are kept as they are, whatever
their names (but for dots); ``n_lines`` and ``n_dropped`` are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stockpond.llm.common import BLANKS, free_name, lower_ascii, map_rows, mix64, ranges
from stockpond.session import stage

_SEED = 42  # of xxhash64 in Spark
_UPPER = {c: c + 32 for c in range(65, 91)}
_COUNTS = "shard int, hi bigint, lo bigint, n bigint"
_FILTERS = "shard int, filter binary"


class CuckooFilter:
    """Buckets of four 16-bit fingerprints; insertion, deletion and lookup work on whole arrays of 64-bit hashes.

    Each hash must be inserted at most once and deleted only if it was inserted.
    """

    WIDTH = 4

    def __init__(self, slots: np.ndarray):
        self.slots = slots

    @classmethod
    def sized(cls, keys: int) -> CuckooFilter:
        buckets = 1 << max(4, int(np.ceil(np.log2(max(keys, 1) / (cls.WIDTH * 0.8)))))
        return cls(np.zeros((buckets, cls.WIDTH), np.uint16))

    @classmethod
    def load(cls, data: bytes) -> CuckooFilter:
        return cls(np.frombuffer(data, np.uint16).reshape(-1, cls.WIDTH).copy())

    def dump(self) -> bytes:
        return self.slots.tobytes()

    def _other(self, bucket: np.ndarray, mark: np.ndarray) -> np.ndarray:
        return bucket ^ (mix64(mark) & np.uint64(len(self.slots) - 1)).astype(np.int64)

    def _place(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        mixed = mix64(hashes.astype(np.int64).view(np.uint64))
        mark = (mixed >> np.uint64(48)).astype(np.uint16)
        mark[mark == 0] = 1  # 0 marks a free slot
        return (mixed & np.uint64(len(self.slots) - 1)).astype(np.int64), mark

    def contains(self, hashes: np.ndarray) -> np.ndarray:
        first, mark = self._place(hashes)
        second = self._other(first, mark)
        return ((self.slots[first] == mark[:, None]) | (self.slots[second] == mark[:, None])).any(axis=1)

    def insert(self, hashes: np.ndarray, rounds: int = 500) -> bool:
        """False if the filter is too full; its content is then undefined."""
        bucket, mark = self._place(hashes)
        for turn in range(rounds):
            if not len(bucket):
                return True
            order = np.argsort(bucket, kind="stable")
            bucket, mark = bucket[order], mark[order]
            starts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
            rank = ranges(np.diff(np.r_[starts, len(bucket)]))
            rows = self.slots[bucket]
            free_rank = np.cumsum(rows == 0, axis=1)
            fits = rank < free_rank[:, -1]
            column = (free_rank == (rank + 1)[:, None]).argmax(axis=1)
            self.slots[bucket[fits], column[fits]] = mark[fits]
            bucket, mark = bucket[~fits], mark[~fits]
            if turn == 0:  # try the other bucket before anything is displaced
                bucket = self._other(bucket, mark)
                continue
            lead = np.r_[True, bucket[1:] != bucket[:-1]] if len(bucket) else np.zeros(0, bool)
            column = (turn + bucket[lead]) % self.WIDTH
            out = self.slots[bucket[lead], column].copy()
            self.slots[bucket[lead], column] = mark[lead]
            mark[lead] = out
            bucket = self._other(bucket, mark)
        return not len(bucket)

    def delete(self, hashes: np.ndarray) -> None:
        for first, mark in zip(*self._place(hashes), strict=True):
            for bucket in (first, self._other(np.array([first]), np.array([mark]))[0]):
                hit = np.flatnonzero(self.slots[bucket] == mark)
                if len(hit):
                    self.slots[bucket, hit[0]] = 0
                    break


@dataclass(frozen=True)
class LineIndex:
    """The written state; every change makes a new one and leaves the old one readable."""

    counts: DataFrame
    filters: DataFrame
    shards: int
    min_docs: int
    min_chars: int
    once_per_text: bool = False


def line_key(line: Column) -> Column:
    return lower_ascii(F.btrim(line, F.lit(BLANKS)))


def _lines(docs: DataFrame, shards: int, min_chars: int, hashed: bool = False) -> DataFrame:
    """(doc_id, hi, lo, shard): each key of a document once per row; ``hashed`` adds a hash of all its keys as ``same``."""
    keys = F.array_distinct(F.transform(F.split(F.coalesce("text", F.lit("")), "\n"), line_key))
    same = ["same"] * hashed
    given = docs.select("doc_id", keys.alias("keys"))
    if hashed:
        given = given.withColumn("same", F.xxhash64("keys"))
    return (
        given.select("doc_id", *same, F.explode("keys").alias("key"))
        .where(F.length("key") >= min_chars)
        .select("doc_id", *same, F.xxhash64("key").alias("hi"), F.xxhash64("key", F.lit(1)).alias("lo"))
        .withColumn("shard", F.pmod("hi", F.lit(shards)).cast("int"))
    )


def empty_index(
    spark: SparkSession, shards: int = 64, min_docs: int = 10, min_chars: int = 1, once_per_text: bool = False
) -> LineIndex:
    """``shards``: so many that the common keys of one shard, two bytes each, and their changes fit in a task."""
    return LineIndex(
        spark.createDataFrame([], _COUNTS), spark.createDataFrame([], _FILTERS), shards, min_docs, min_chars,
        once_per_text,
    )


def add_documents(index: LineIndex, docs: DataFrame) -> LineIndex:
    """Count the lines of documents that the index does not hold yet, nor copies of them if it counts ``once_per_text``."""
    return _change(index, docs, 1)


def remove_documents(index: LineIndex, docs: DataFrame) -> LineIndex:
    """Undo ``add_documents`` for documents given with the text they were added with."""
    return _change(index, docs, -1)


def _change(index: LineIndex, docs: DataFrame, sign: int) -> LineIndex:
    limit = index.min_docs
    lines = _lines(docs, index.shards, index.min_chars, index.once_per_text)
    each = lines.groupBy("shard", "hi", "lo", "doc_id")
    if index.once_per_text:
        each = each.agg(F.min("same").alias("same")).groupBy("shard", "hi", "lo", "same")
    once = each.agg(F.lit(sign).alias("d"))
    deltas = once.groupBy("shard", "hi", "lo").agg(F.sum("d").alias("change"))
    after = stage(
        index.counts.withColumnRenamed("n", "before")
        .join(deltas, ["shard", "hi", "lo"], "full_outer")
        .select("shard", "hi", "lo", F.coalesce("before", F.lit(0)).alias("before"),
                (F.coalesce("before", F.lit(0)) + F.coalesce("change", F.lit(0))).alias("n")),
        "line-counts",
    )
    crossed = after.where((F.col("before") >= limit) != (F.col("n") >= limit)).select(
        "shard", "hi", (F.col("n") >= limit).alias("enters"))
    common = after.where(F.col("n") >= limit).select("shard", F.col("hi"))

    def update(key: tuple, old: pd.DataFrame, moved: pd.DataFrame) -> pd.DataFrame:
        enters = moved["enters"].to_numpy(bool)
        hashes = moved["hi"].to_numpy(np.int64)
        held = CuckooFilter.load(old["filter"].iloc[0]) if len(old) else CuckooFilter.sized(int(enters.sum()))
        held.delete(hashes[~enters])
        if not held.insert(hashes[enters]):
            return pd.DataFrame({"shard": [key[0]], "filter": [b""]})
        return pd.DataFrame({"shard": [key[0]], "filter": [held.dump()]})

    def rebuild(key: tuple, full: pd.DataFrame, all_common: pd.DataFrame) -> pd.DataFrame:
        """A filter that ran full is made anew from the exact counts, twice as large until it fits."""
        hashes = all_common["hi"].to_numpy(np.int64)
        size = len(hashes) if not len(full) or len(full["filter"].iloc[0]) == 0 else 0
        if not size:
            return full
        while not (made := CuckooFilter.sized(size)).insert(hashes):
            size *= 2
        return pd.DataFrame({"shard": [key[0]], "filter": [made.dump()]})

    changed = index.filters.groupBy("shard").cogroup(crossed.groupBy("shard")).applyInPandas(update, _FILTERS)
    if index.filters.isEmpty():  # nothing to keep: the filters come from the counts alone
        changed = index.filters
    filters = stage(changed.groupBy("shard").cogroup(common.groupBy("shard")).applyInPandas(rebuild, _FILTERS),
                    "line-filters")
    return LineIndex(after.where(F.col("n") > 0).select("shard", "hi", "lo", "n"), filters, index.shards, limit,
                     index.min_chars, index.once_per_text)


def _common_lines(index: LineIndex, docs: DataFrame, group_rows: int) -> DataFrame:
    """(doc_id, keys): the common keys of each document that has any."""
    lines = _lines(docs, index.shards, index.min_chars)
    total = index.counts.agg(F.sum("n")).first()[0] or 0
    # A hot key fills its shard with its own lines, so every shard is dealt to several tasks by the document.
    salts = int(max(4, -(-total // (index.shards * group_rows)) * 2))
    salted = lines.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(salts)).cast("int"))
    copies = index.filters.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))

    def probe(held: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        columns = ["doc_id", "hi", "lo"]
        if not len(held) or not len(asked):
            return asked[columns].iloc[:0]
        return asked.loc[CuckooFilter.load(held["filter"].iloc[0]).contains(asked["hi"].to_numpy(np.int64)), columns]

    kind = dict(docs.dtypes)["doc_id"]
    hits = copies.groupBy("shard", "salt").cogroup(salted.groupBy("shard", "salt")).applyInPandas(
        probe, f"doc_id {kind}, hi bigint, lo bigint")
    common = index.counts.where(F.col("n") >= index.min_docs).select("hi", "lo")
    return hits.join(common, ["hi", "lo"]).groupBy("doc_id").agg(F.collect_set("hi").alias("_keys"))


def drop_common_lines(index: LineIndex, docs: DataFrame, group_rows: int = 1 << 17) -> DataFrame:
    """``docs`` with the kept lines as ``text``, and ``n_lines`` (before) and ``n_dropped`` added.

    A text without dropped lines stays as it is, null included. ``group_rows``
    is the number of probed lines that one group of a task is made for.
    """
    columns = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    given = docs.select(*columns)
    ddl = given.schema.toDDL() + ", n_lines bigint, n_dropped bigint"
    held_keys, other = free_name(columns, "_keys"), free_name(columns, "_id")
    keys = _common_lines(index, docs, group_rows).select(F.col("doc_id").alias(other), F.col("_keys").alias(held_keys))
    joined = given.join(keys, F.col("doc_id").eqNullSafe(F.col(other)), "left").drop(other)

    def make():
        def step(rows: dict[str, list]) -> dict[str, list]:
            out = {c: rows[c] for c in columns} | {"n_lines": [], "n_dropped": []}
            texts = []
            for text, held in zip(rows["text"], rows[held_keys], strict=True):
                lines = (text or "").split("\n")
                kept = lines
                if held is not None:  # an array where each document of the slice has common keys, else a list
                    common = set(held)
                    kept = [x for x in lines if _signed(x.strip(BLANKS).translate(_UPPER)) not in common]
                texts.append(text if len(kept) == len(lines) else "\n".join(kept))
                out["n_lines"].append(len(lines))
                out["n_dropped"].append(len(lines) - len(kept))
            return out | {"text": texts}

        return step

    return map_rows(joined, make, ddl)


def _signed(key: str) -> int:
    value = xxhash.xxh64_intdigest(key.encode("utf-8", "surrogatepass"), _SEED)
    return value - (1 << 64) if value >> 63 else value


def dedup_lines(
    docs: DataFrame, min_docs: int = 10, min_chars: int = 1, shards: int = 64, once_per_text: bool = False
) -> DataFrame:
    """One batch: index the documents, then drop their common lines."""
    index = add_documents(empty_index(docs.sparkSession, shards, min_docs, min_chars, once_per_text), docs)
    return drop_common_lines(index, docs)
