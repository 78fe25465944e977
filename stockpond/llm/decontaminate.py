"""Benchmark decontamination: SimHash of item-sized windows, a multi-index over Hamming blocks, exact verification.

Only DataFrame functions are used. Texts are lower-cased and cut into words of
letters and digits; shingles are five words in a row (all words, where there
are fewer), weighted by their rarity in the benchmark.

1. A window of a document has as many shingles as some item. A window that
   shares no shingle with any item has similarity 0, so windows are laid only
   where a shingle of an item is found: aligned so that the shingle lies where
   it lies in the item. An edit moves later shingles by its own size; each
   shared shingle lays its window, so the unmoved part has one of its own.
2. Windows and items get a 64-bit SimHash of their shingles, each with the root
   of its weight: the angle of two then follows from the shared weight.
3. Fingerprints are cut into four blocks of 16 bits. Two fingerprints within
   ``radius`` = 4 * ``block_radius`` + 3 bits differ by at most ``block_radius``
   bits in one block at least, so looking up every block value of an item with
   up to so many bits flipped finds all windows within the radius.
4. Pairs found are verified by the exact weighted Jaccard similarity of their
   shingles, with multiplicity; ``similarity`` or more is a leak.

At a similarity of 0.8 the cosine of two such vectors is at least 0.88, however
uneven the weights; the expected distance is below 10 bits with a standard
deviation of 3, and the default radius of 19 is three deviations above it.

Null and empty texts and items have no words and never match; an item of
fewer than five words is only found as a whole document. Repeated items
and documents are each reported. Documents without ``doc_id`` cannot be
reported and are left out of the pairs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockpond.session import stage

SHINGLE = 5
BLOCKS = 4
BLOCK_BITS = 16


def words(text: Column) -> Column:
    """Lower-cased runs of letters and digits; none for null."""
    cut = F.split(F.lower(text), r"[^\p{L}\p{N}]+")
    return F.filter(F.coalesce(cut, F.array()), lambda w: w != "")


def shingles(text: Column) -> Column:
    """64-bit hashes of five words in a row, in order; of all words, if there are fewer."""

    def hashed(tokens: Column) -> Column:
        places = F.sequence(F.lit(1), F.greatest(F.size(tokens) - (SHINGLE - 1), F.lit(1)))
        each = F.transform(places, lambda i: F.xxhash64(F.slice(tokens, i, SHINGLE)))
        return F.when(F.size(tokens) > 0, each).otherwise(F.array().cast("array<bigint>"))

    # The words become a bound variable; written in place they would be cut anew for each shingle.
    numbers = F.transform(words(text), lambda w: F.xxhash64(w))
    return F.element_at(F.transform(F.array(numbers), hashed), 1)


def _fingerprint(hashes: str, weight: str) -> list[Column]:
    """SimHash of grouped rows in four blocks: bit b is set if the weights of shingles with that bit outweigh the others."""

    def bit(b: int) -> Column:
        has = F.shiftright(hashes, b).bitwiseAND(F.lit(1)) == 1
        return (F.sum(F.when(has, F.col(weight)).otherwise(-F.col(weight))) > 0).cast("int")

    return [
        sum((bit(k * BLOCK_BITS + b) * (1 << b) for b in range(BLOCK_BITS)), F.lit(0)).cast("int").alias(f"f{k}")
        for k in range(BLOCKS)
    ]


def _blocks() -> Column:
    """One row per block: its number and value."""
    return F.inline(F.array(*[F.struct(F.lit(k).alias("block"), F.col(f"f{k}").alias("value")) for k in range(BLOCKS)]))


def _within_radius(window_prints: DataFrame, item_prints: DataFrame, block_radius: int, broadcast_prints: int = 20_000) -> DataFrame:
    """Windows, a written table, with the items whose fingerprint is within the radius; a pair once for each block that finds it.

    The index of items holds every value within ``block_radius`` bits of a
    block: with 4 bits 10,068 rows an item, which the planner takes for one.
    So it is never broadcast. Up to ``broadcast_prints`` windows (four rows of
    72 bytes each) are sent to it, more of them meet it by sorted shuffles.
    """
    radius = BLOCKS * block_radius + BLOCKS - 1
    flips = [str(m) for m in range(1 << BLOCK_BITS) if m.bit_count() <= block_radius]
    masks = F.split(F.lit(",".join(flips)), ",").cast("array<int>")  # a constant of the plan
    prints = [F.col(f"f{k}").alias(f"i{k}") for k in range(BLOCKS)]
    index = item_prints.select("item", "length", *prints, _blocks()).withColumn("mask", F.explode(masks)).withColumn(
        "value", F.col("value").bitwiseXOR(F.col("mask"))).drop("mask")
    asked = window_prints.select("window", "length", *[f"f{k}" for k in range(BLOCKS)], _blocks())
    away = sum((F.bit_count(F.col(f"i{k}").bitwiseXOR(F.col(f"f{k}"))) for k in range(BLOCKS)), F.lit(0))
    side = F.broadcast(asked) if window_prints.count() <= broadcast_prints else asked.hint("merge")
    return side.join(index, ["length", "block", "value"]).where(away <= radius)


def leaks(
    docs: DataFrame, benchmark: DataFrame, similarity: float = 0.8, block_radius: int = 4,
    broadcast_shingles: int = 2_000_000, broadcast_windows: int = 1_000_000,
) -> DataFrame:
    """(doc_id, item_id, similarity): the best window of each document for each item it contains.

    ``broadcast_shingles``: up to so many different shingles (16 bytes each)
    the benchmark's index is sent to all executors; a larger one is joined by
    a shuffle of the documents' shingles. ``broadcast_windows``: up to so many
    windows (16 bytes each) and documents with windows the list of windows is
    sent to all executors; a longer one meets the texts by a shuffle. The texts
    themselves are never broadcast, however small their files are.
    """
    items = benchmark.select("item_id", shingles(F.col("text")).alias("s")).where(F.size("s") > 0).select(
        F.xxhash64("s").alias("item"), "item_id", F.size("s").alias("length"), "s")
    distinct = items.select("item", "length", "s").dropDuplicates(["item"])  # repeated items are matched once
    placed = distinct.select("item", "length", F.posexplode("s").alias("at", "h"))
    total = F.lit(float(max(1, distinct.count())))
    weights = placed.groupBy("h").agg(F.count_distinct("item").alias("df")).select(
        "h", (1 + F.log(total / F.col("df"))).alias("w"))
    item_rows = stage(placed.join(weights, "h").select("item", "length", "at", "h", "w"), "benchmark-shingles")
    rarest = 1 + F.log(total)  # the weight of a shingle that no item has

    # 1. Windows: where a shingle of an item stands in a document, the item could begin so many shingles before.
    offsets = item_rows.select("h", "length", "at").distinct()
    few = offsets.count() <= broadcast_shingles
    texts = docs.where(F.col("doc_id").isNotNull()).select("doc_id", "text")
    found = texts.select("doc_id", shingles(F.col("text")).alias("s")).select("doc_id", F.size("s").alias("n"), F.posexplode("s").alias("pos", "h")).join(
        F.broadcast(offsets) if few else offsets, "h")
    start = F.least(F.greatest(F.col("pos") - F.col("at"), F.lit(0)), F.greatest(F.col("n") - F.col("length"), F.lit(0)))
    windows = found.select("doc_id", "length", start.alias("start")).distinct()
    # Only documents with windows are cut again, and only the shingles inside windows are kept. Rows are dealt by
    # window, so one document full of windows does not stay in one task.
    per_doc = stage(windows.groupBy("doc_id").agg(F.collect_set(F.struct("length", "start")).alias("places")), "places")
    listed = per_doc.agg(F.coalesce(F.sum(F.size("places")), F.lit(0))).first()[0]
    side = F.broadcast(per_doc) if listed <= broadcast_windows else per_doc.hint("shuffle_hash")
    cut = texts.join(side, "doc_id").select("doc_id", "places", shingles(F.col("text")).alias("s"))
    held = cut.select("doc_id", F.explode("places").alias("p"), "s").select(
        "doc_id", F.col("p.length").alias("length"), F.col("p.start").alias("start"),
        F.slice("s", F.col("p.start") + 1, F.col("p.length")).alias("s"))
    # Copies of one passage in many documents are one window from here on.
    held = held.withColumn("window", F.xxhash64("s", "length"))
    members = stage(held.select("doc_id", "window", "length", "s"), "windows")
    unique = members.dropDuplicates(["window"]).select("window", "length", F.explode("s").alias("h"))
    known = item_rows.select("h", "w").distinct()
    weighted = unique.join(F.broadcast(known) if few else known, "h", "left").select(
        "window", "length", "h", F.coalesce("w", rarest).alias("w"))
    window_rows = stage(weighted.groupBy("window", "length", "h").agg(
        F.sum("w").alias("mass"), F.count(F.lit(1)).alias("n"), F.first("w").alias("w")), "window-shingles")
    item_counts = item_rows.groupBy("item", "length", "h").agg(
        F.sum("w").alias("mass"), F.count(F.lit(1)).alias("n"), F.first("w").alias("w"))

    # 2. Fingerprints.
    root = F.sqrt("mass").alias("root")
    window_prints = stage(
        window_rows.select("window", "length", "h", root).groupBy("window", "length").agg(*_fingerprint("h", "root")), "prints")
    item_prints = item_counts.select("item", "length", "h", root).groupBy("item", "length").agg(*_fingerprint("h", "root"))

    # 3. The index of items.
    near = _within_radius(window_prints, item_prints, block_radius).select("window", "item").distinct()

    # 4. Exact weighted Jaccard similarity: the shared mass over the mass of both without it.
    near = stage(near, "near-windows")
    shared = (
        near.join(window_rows.select("window", "h", F.col("n").alias("nw"), "w"), "window")
        .join(item_counts.select("item", "h", F.col("n").alias("ni")), ["item", "h"])
        .groupBy("window", "item").agg(F.sum(F.col("w") * F.least("nw", "ni")).alias("both"))
    )
    window_mass = window_rows.groupBy("window").agg(F.sum("mass").alias("mw"))
    item_mass = item_counts.groupBy("item").agg(F.sum("mass").alias("mi"))
    score = F.col("both") / (F.col("mw") + F.col("mi") - F.col("both"))
    alike = (
        shared.join(window_mass, "window").join(item_mass, "item").select("window", "item", score.alias("similarity"))
        .where(F.col("similarity") >= similarity - 1e-9)
    )
    names = items.select("item", "item_id")
    return (
        members.select("doc_id", "window").join(alike, "window").join(names, "item")
        .groupBy("doc_id", "item_id").agg(F.round(F.max("similarity"), 6).alias("similarity"))
    )


def clean_documents(docs: DataFrame, benchmark: DataFrame, similarity: float = 0.8) -> DataFrame:
    """The rows of ``docs`` without those whose document holds a benchmark item."""
    found = leaks(docs, benchmark, similarity).select("doc_id").distinct()
    return docs.join(found, "doc_id", "left_anti").select(*docs.columns)
