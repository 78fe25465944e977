"""Near-duplicate classes by Order MinHash, verified by banded alignment.

Texts are lower-cased and cut at blanks; k-mers are five words in a row (all
words, where there are fewer). Two texts are near duplicates if the edit
distance of their sequences of k-mers is at most ``1 - similarity`` of the
longer one; a changed word changes five k-mers, so 0.8 here is close to a
k-mer Jaccard similarity of 0.67.

1. Texts with equal words are one class from the start; only the smallest
   ``doc_id`` of each goes on.
2. A sketch takes the ``picks`` k-mers, labelled by their occurrence, with the
   smallest hashes, in the order of the text: equal sketches need equal k-mers
   in equal order. There are ``sketches`` of them. A pair with a Jaccard
   similarity of 0.8 has one sketch in common with a probability above 0.9999,
   if the texts have many more k-mers than ``picks``. Texts of few k-mers take
   their rarest ones as buckets as well (see 3), by which no link is lost.
3. The documents of one sketch are a bucket. Its leader is paired with all
   others, so a bucket of any size gives one pair per document. Leaders are
   taken in an order that is the same for all buckets: first the documents that
   share their sketches with most others, as the text that many others were
   made from does. Members that turn out different from their leader, mostly
   documents that only share a passage, are dealt anew by their rarest k-mers:
   of two near duplicates, both with their labelled k-mers ordered from rare to
   frequent, the first ``1 - similarity`` and one more have a k-mer in common.
   So no link is lost, and a passage, however frequent, makes no bucket.
   Leaders and rounds go on in the new buckets until none is left. Pairs whose
   sizes alone are too far apart for a link are refused without a look at them.
4. A pair is verified by an alignment in a band that doubles until it holds
   the distance or passes the limit. A member that the leader refused may still
   be near to one that it accepted: unless they are in one class already, the two
   meet by their rarest k-mers, of which they must share one.
5. Classes are the connected components of the verified pairs.

Null texts, and texts without words, are classes of their own. Repeated
``doc_id`` values count as one document with its smallest text; rows without
``doc_id`` take no part. Rounds are written tables in the shared folder.
"""

from __future__ import annotations

import functools

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stockpond.llm.common import map_rows, mix64
from stockpond.session import stage

K = 5
_BASE = 0x9E3779B97F4A7C15


def kmer_hashes(words: list[bytes] | list[str]) -> np.ndarray:
    """64-bit hashes of five words in a row, in order; of all words, if there are fewer."""
    import xxhash

    if not words:
        return np.zeros(0, np.uint64)
    each = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    size = max(1, len(each) - K + 1)
    out = np.zeros(size, np.uint64)
    for j in range(min(K, len(each))):
        out = out * np.uint64(_BASE) + each[j: j + size]
    return mix64(out)


def occurrence_labels(kmers: np.ndarray) -> np.ndarray:
    """How many equal k-mers stand before each."""
    ordered = np.sort(kmers)
    if not (ordered[1:] == ordered[:-1]).any():
        return np.zeros(len(kmers), np.int64)
    order = np.argsort(kmers, kind="stable")
    ordered = kmers[order]
    first = np.r_[True, ordered[1:] != ordered[:-1]]
    starts = np.maximum.accumulate(np.where(first, np.arange(len(kmers)), 0))
    out = np.empty(len(kmers), np.int64)
    out[order] = np.arange(len(kmers)) - starts
    return out


def labelled(kmers: np.ndarray) -> np.ndarray:
    """Numbers of the k-mers together with their occurrence: all different within a text."""
    return mix64(kmers + occurrence_labels(kmers).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def _smallest(ranks: np.ndarray, keep: int) -> np.ndarray:
    """The places of the ``keep`` smallest numbers of each row, in order."""
    rows, width = ranks.shape
    if width <= keep:
        return np.tile(np.arange(width), (rows, 1))
    last = np.partition(ranks, keep - 1, axis=1)[:, keep - 1:keep]
    found = np.flatnonzero(ranks <= last)
    if len(found) == rows * keep:
        return found.reshape(rows, keep) - (np.arange(rows) * width)[:, None]
    places = np.argpartition(ranks, keep - 1, axis=1)[:, :keep]  # numbers equal to the last one
    places.sort(axis=1)
    return places


@functools.cache
def _seeds(first: int, last: int) -> np.ndarray:
    return mix64(np.arange(first, last, dtype=np.uint64))


def sketch(kmers: np.ndarray, sketches: int, picks: int, cells: int = 1 << 16) -> np.ndarray:
    """One 64-bit number per sketch."""
    labels = labelled(kmers)
    keep = min(picks, len(labels))
    out = np.empty(sketches, np.uint64)
    step = max(1, cells // len(labels))
    for first in range(0, sketches, step):
        seeds = _seeds(first + 1, min(sketches, first + step) + 1)
        # An odd multiplier and a shift per sketch: a random order of the labelled k-mers.
        ranks = labels[None, :] * (seeds[:, None] | np.uint64(1))
        ranks += seeds[:, None] >> np.uint64(7)
        ranks >>= np.uint64(1)
        ranks ^= ranks >> np.uint64(29)
        value = seeds.copy()
        for column in kmers[_smallest(ranks, keep).T]:  # in the order of the text
            value *= np.uint64(_BASE)
            value += column
        out[first: first + len(seeds)] = mix64(value)
    return out


def banded_distance(a: np.ndarray, b: np.ndarray, limit: int) -> int:
    """The edit distance of two sequences, or ``limit`` + 1 if it is larger."""
    same = min(len(a), len(b))
    head = int((a[:same] != b[:same]).argmax()) if (a[:same] != b[:same]).any() else same
    a, b = a[head:], b[head:]
    same = min(len(a), len(b))
    if same:
        back = a[::-1][:same] != b[::-1][:same]
        tail = int(back.argmax()) if back.any() else same
        a, b = a[: len(a) - tail], b[: len(b) - tail]
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > limit:
        return limit + 1
    if not len(a):
        return len(b)
    band = max(16, len(b) - len(a))
    while True:
        band = min(band, limit)
        found = (_furthest if (2 * band + 1) * len(a) <= 1 << 22 else _in_band)(a, b, band)
        if found <= band or band >= limit:
            return min(found, limit + 1)
        band *= 4


def _furthest(a: np.ndarray, b: np.ndarray, band: int) -> int:
    """As ``_in_band``, by the furthest row that each diagonal of the band reaches with 0, 1, 2, ... edits."""
    n, m, width = len(a), len(b), 2 * band + 1
    padded = np.concatenate([np.full(band, -1, np.int64), b.view(np.int64), np.full(n + band, -1, np.int64)])
    differs = np.lib.stride_tricks.sliding_window_view(padded, n)[:width] != a.view(np.int64)
    stop = np.full((width, n + 1), n, np.int32)  # where a run of equal symbols ends, from each row of a diagonal
    stop[:, :n] = np.where(differs, np.arange(n, dtype=np.int32), n)
    stop = np.minimum.accumulate(stop[:, ::-1], axis=1)[:, ::-1]
    diagonal = np.arange(width)
    last = np.minimum(n, m - (diagonal - band))
    reach = np.full(width, -(1 << 29), np.int64)
    reach[band] = stop[band, 0]
    for edits in range(band + 1):
        if edits:
            step = reach + 1
            step[1:] = np.maximum(step[1:], reach[:-1])
            step[:-1] = np.maximum(step[:-1], reach[1:] + 1)
            step = np.minimum(step, last)
            reach = np.where(step >= 0, stop[diagonal, np.maximum(step, 0)], step)
        if reach[band + m - n] >= n:
            return edits
    return band + 1


def _in_band(a: np.ndarray, b: np.ndarray, band: int) -> int:
    """Edit distance over paths that stay within ``band`` of the diagonal; exact if the result is at most ``band``."""
    width = 2 * band + 1
    far = 1 << 30
    steps = np.arange(width)
    padded = np.full(len(b) + 2 * width, -1, np.int64)  # matches nothing
    padded[width: width + len(b)] = b.view(np.int64)
    row = np.where(steps >= band, steps - band, far)  # row 0: column = offset + step
    row[steps - band > len(b)] = far
    for i, symbol in enumerate(a.view(np.int64).tolist(), 1):
        # Cell s of row i is column i - band + s; its diagonal is cell s above, its upper cell is s + 1 above.
        window = padded[width + i - band - 1: width + i - band - 1 + width]
        diagonal = row + (window != symbol)
        upper = np.append(row[1:], far) + 1
        best = np.minimum(diagonal, upper)
        columns = i - band + steps
        best[(columns < 0) | (columns > len(b))] = far
        if 0 <= band - i < width:
            best[band - i] = min(best[band - i], i)  # column 0
        row = np.minimum.accumulate(best - steps) + steps  # cells to the left
        row[(columns < 0) | (columns > len(b))] = far
        if row.min() > band:
            return band + 1
    return int(row[len(b) - len(a) + band])


def _bag_bound(a: np.ndarray, b: np.ndarray) -> int:
    """A lower bound of the edit distance: the longer size less what the two have in common, order aside."""
    values, counts = np.unique(np.concatenate([a, b]), return_counts=True)
    left = np.bincount(np.searchsorted(values, a), minlength=len(values))
    return max(len(a), len(b)) - int(np.minimum(left, counts - left).sum())


def words_of(text: str) -> list[bytes]:
    """The lower-cased words between ASCII blanks, in UTF-8."""
    return text.lower().encode("utf-8", "surrogatepass").split()  # bytes are cut at ASCII blanks only


def _key(words: list[bytes]) -> np.ndarray:
    """128 bits of a text's words, as two numbers."""
    import xxhash

    return np.frombuffer(xxhash.xxh3_128_digest(b" ".join(words)), np.int64)


def _sketched(given: DataFrame, sketches: int, picks: int) -> DataFrame:
    """(doc_id, k1, k2, size, buckets) of each row with words: the key of its text and its sketches."""

    def make():
        def step(rows: dict[str, list]) -> dict[str, list]:
            out: dict[str, list] = {c: [] for c in ("doc_id", "k1", "k2", "size", "buckets")}
            seen: dict[tuple[int, int], tuple] = {}
            for number, text in zip(rows["doc_id"], rows["text"], strict=True):
                words = words_of(text)
                if not words:
                    continue
                key = tuple(_key(words).tolist())
                if key not in seen:
                    kmers = kmer_hashes(words)
                    seen[key] = len(kmers), sketch(kmers, sketches, picks).view(np.int64)
                for name, value in zip(out, (number, *key, *seen[key]), strict=True):
                    out[name].append(value)
            return out

        return step

    kind = dict(given.dtypes)["doc_id"]
    return map_rows(given, make, f"doc_id {kind}, k1 bigint, k2 bigint, size int, buckets array<bigint>", rows=256)


def _representatives(sketched: DataFrame) -> DataFrame:
    """(doc_id, rep, k1, k2): each document, the first document with its words, and their key."""
    once = sketched.groupBy("doc_id").agg(F.min(F.struct("k1", "k2")).alias("k")).select("doc_id", "k.k1", "k.k2")
    groups = once.groupBy("k1", "k2").agg(F.min("doc_id").alias("rep"))
    # Members meet their representative by a join, as a group of copies may be of any size.
    return once.join(groups, ["k1", "k2"]).select("doc_id", "rep", "k1", "k2")


def _kmers(texts: DataFrame) -> DataFrame:
    """(rep, size, kmers): the k-mer hashes of each text.

    Rows may carry the key ``k1``, ``k2`` of the text that is meant; others are left out then.
    """
    keyed = {"k1", "k2"} <= set(texts.columns)

    def make():
        def step(rows: dict[str, list]) -> dict[str, list]:
            out: dict[str, list] = {"rep": [], "size": [], "kmers": []}
            for place, (number, text) in enumerate(zip(rows["rep"], rows["text"], strict=True)):
                words = words_of(text)
                if keyed and tuple(_key(words).tolist()) != (rows["k1"][place], rows["k2"][place]):
                    continue
                kmers = kmer_hashes(words).view(np.int64)
                out["rep"].append(number)
                out["size"].append(len(kmers))
                out["kmers"].append(kmers)
            return out

        return step

    kind = dict(texts.dtypes)["rep"]
    return map_rows(texts, make, f"rep {kind}, size int, kmers array<bigint>", rows=256)


def _texts_of(given: DataFrame, wanted: DataFrame, broadcast_ids: int = 500_000) -> DataFrame:
    """(rep, text, k1, k2): the texts of ``given`` (doc_id, text) for ``wanted`` (rep, r1, r2), a written table.

    Up to ``broadcast_ids`` ids (32 bytes each) go to the texts, which are not shuffled then; more of them meet by a shuffle.
    """
    side = F.broadcast(wanted) if wanted.count() <= broadcast_ids else wanted
    return given.join(side, F.col("doc_id") == F.col("rep")).select(
        "rep", "text", F.col("r1").alias("k1"), F.col("r2").alias("k2")).distinct()


def _verified(pairs: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """(a, b, distance, linked) of pairs (a, b); without a link, ``distance`` is a lower bound."""
    one = texts.select(F.col("rep").alias("a"), F.col("kmers").alias("x"))
    two = texts.select(F.col("rep").alias("b"), F.col("kmers").alias("y"))

    def make():
        def step(rows: dict[str, list]) -> dict[str, list]:
            out: dict[str, list] = {"a": rows["a"], "b": rows["b"], "distance": [], "linked": []}
            for x, y in zip(rows["x"], rows["y"], strict=True):
                x, y = x.view(np.uint64), y.view(np.uint64)
                limit = int((1 - similarity) * max(len(x), len(y)) + 1e-9)
                distance = _bag_bound(x, y)
                if distance <= limit:
                    distance = max(distance, banded_distance(x, y, limit))
                out["distance"].append(distance)
                out["linked"].append(distance <= limit)
            return out

        return step

    kind = dict(pairs.dtypes)["a"]
    return map_rows(pairs.join(one, "a").join(two, "b").select("a", "b", "x", "y"), make,
                    f"a {kind}, b {kind}, distance int, linked boolean", rows=128)


def _ordered(buckets: DataFrame) -> DataFrame:
    """``buckets`` of two members and more, with ``weight``: all the places in the buckets that ``id`` is in."""
    sizes = buckets.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    held = stage(buckets.join(sizes, "bucket"), "shared-buckets")
    weights = held.groupBy("id").agg(F.sum("n").alias("weight"))
    return stage(held.drop("n").join(weights, "id"), "ordered-buckets")


def candidate_pairs(buckets: DataFrame, leaders: int, similarity: float) -> DataFrame:
    """(bucket, leader, id, size, leads, gap, far): the first members of each bucket with all that come after them.

    ``leads`` tells whether ``id`` is itself one of the leaders, ``gap`` is the
    difference of the sizes, and ``far`` tells that it rules out a link.
    """
    order = Window.partitionBy("bucket").orderBy(F.desc("weight"), "r", "id")
    ordered = buckets.withColumn("r", F.xxhash64("id"))
    first = ordered.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= leaders).select(
        "bucket", F.col("id").alias("leader"), F.struct(-F.col("weight"), "r", "id").alias("place"),
        F.col("size").alias("leader_size"))
    own = first.select("bucket", F.col("leader").alias("id"), F.lit(True).alias("leads"))
    gap = F.abs(F.col("size") - F.col("leader_size"))
    limit = F.floor((1 - similarity) * F.greatest("size", "leader_size") + 1e-9)
    return ordered.join(first, "bucket").where(F.struct(-F.col("weight"), "r", "id") > F.col("place")).join(
        own, ["bucket", "id"], "left").select(
        "bucket", "leader", "id", "size", "weight", F.coalesce("leads", F.lit(False)).alias("leads"),
        gap.alias("gap"), (gap > limit).alias("far"))


def rare_buckets(texts: DataFrame, similarity: float) -> DataFrame:
    """``_rare_buckets`` of texts (rep, text)."""
    return _rare_buckets(_kmers(texts), similarity)


def _rare_buckets(texts: DataFrame, similarity: float) -> DataFrame:
    """(bucket, id, size): each text (rep, size, kmers) in the bucket of each of its rarest labelled k-mers.

    A text of n k-mers has to take (1 - ``similarity``) * n + 1 of them: near
    duplicates differ in fewer, so they share one of these whatever the order,
    as long as it is the same for all texts. Rare ones first makes small buckets.
    """

    held = stage(_labels(texts), "labelled")
    counted = held.join(held.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")), "bucket")
    return _rarest(counted, similarity).where("n > 1").select("bucket", "id", "size")


def _labels(texts: DataFrame) -> DataFrame:
    """(id, size, bucket): each labelled k-mer of each text (rep, size, kmers)."""

    def make():
        def step(rows: dict[str, list]) -> dict[str, list]:
            made = [labelled(k.view(np.uint64)).view(np.int64) for k in rows["kmers"]]
            return {"id": rows["rep"], "size": rows["size"], "buckets": made}

        return step

    kind = dict(texts.dtypes)["rep"]
    made = map_rows(texts, make, f"id {kind}, size int, buckets array<bigint>", rows=256)
    return made.select("id", "size", F.explode("buckets").alias("bucket"))


def _rarest(counted: DataFrame, similarity: float) -> DataFrame:
    """Of labelled k-mers (id, size, bucket, n), those of each text with the smallest ``n`` that near duplicates must share."""
    rarest = Window.partitionBy("id").orderBy("n", "bucket")
    wanted = F.floor((1 - similarity) * F.col("size") + 1e-9) + 1
    return counted.withColumn("place", F.row_number().over(rarest)).where(F.col("place") <= wanted).drop("place")


def near_pairs(given: DataFrame, sketched: DataFrame, members: DataFrame, similarity: float, few: int) -> DataFrame:
    """Verified pairs (a, b) of different texts that connect all near duplicates that share a sketch or have under ``few`` k-mers.

    Texts of ``given`` are read again only for documents that share a sketch or are short:
    they become k-mers, a table that all rounds use. The first round takes one
    leader per bucket of equal sketches, as most are copies of one text. What
    differs from it and all that is short is dealt anew by ``rare_buckets``; from there on each round
    takes twice the leaders of the one before, as most members are no near
    duplicates of any, and rounds stay few.
    """
    chosen = members.where(F.col("doc_id") == F.col("rep")).select("rep", F.col("k1").alias("r1"), F.col("k2").alias("r2"))
    # Rows of one document differ in texts or are repeated; one with the key goes on.
    own = sketched.join(chosen, (F.col("doc_id") == F.col("rep")) & (F.col("k1") == F.col("r1")) & (F.col("k2") == F.col("r2"))).dropDuplicates(["rep"])
    members = _ordered(own.select(F.col("rep").alias("id"), "size", F.explode("buckets").alias("bucket")))
    # What is near to a text of under ``few`` k-mers has no more than this.
    short = stage(own.where(F.col("size") <= few / similarity).select("rep"), "short")
    wanted = stage(members.select(F.col("id").alias("rep")).unionByName(short).distinct().join(chosen, "rep"), "wanted")
    texts = stage(_kmers(_texts_of(given, wanted)), "kmers")
    rounds: list[DataFrame] = []
    tested = None
    dealt = False
    while True:
        star = stage(candidate_pairs(members, 1 << max(0, len(rounds) - 1), similarity), "stars")
        if star.isEmpty():
            if dealt or short.isEmpty():
                break
            members = _ordered(stage(_rare_buckets(texts, similarity), "rare"))  # no sketch is shared: all are short
            dealt = True
            continue
        pairs = star.where(~F.col("far")).select(F.col("leader").alias("a"), F.col("id").alias("b")).distinct()
        fresh = pairs if tested is None else pairs.join(tested, ["a", "b"], "left_anti")
        results = stage(_verified(fresh, texts, similarity), "verified")
        tested = results if tested is None else stage(tested.unionByName(results), "tested")
        rated = stage(star.withColumnsRenamed({"leader": "a", "id": "b"}).join(tested, ["a", "b"], "left").select(
            "bucket", "a", "b", "size", "weight", "leads", F.coalesce("distance", "gap").alias("distance"),
            F.coalesce("linked", F.lit(False)).alias("linked")), "rated")
        rounds.append(rated)
        members = rated.where(~F.col("leads")).groupBy("bucket", F.col("b").alias("id"), "size", "weight").agg(
            F.max("linked").alias("linked")).where(~F.col("linked")).select("bucket", "id", "size", "weight")
        if not dealt:
            left = stage(members.select(F.col("id").alias("rep")).unionByName(short).distinct(), "left")
            members = _ordered(stage(_rare_buckets(texts.join(left, "rep", "left_semi"), similarity), "rare"))
            dealt = True
    if tested is None:
        return star.select(F.col("leader").alias("a"), F.col("id").alias("b"))
    links = tested.where("linked").select("a", "b")
    return links.unionByName(_across(rounds, links, texts, similarity)).distinct()


def _across(rounds: list[DataFrame], links: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """Links between members that a leader accepted and members that it refused, where there may be some.

    By the triangle inequality a member far from its leader cannot be near to
    one close to it; and members of one class need no further link. What is
    left is first joined by bridges: of each class that a leader refused, the
    member whose size is outside those accepted, by the least, meets the largest
    or the smallest of them. Texts of one repeated word are such a chain of sizes.
    Then the members still refused meet the accepted members of their leaders by
    their rarest labelled k-mers, as in ``_rare_buckets``: near duplicates have
    one of these in common, whatever the order. Rare is what few refused members
    have. A text is cut into its k-mers once, however many leaders refused it.
    """
    every = rounds[0]
    for more in rounds[1:]:
        every = every.unionByName(more)
    # The same leader may head many buckets, so members meet once for it, not once for each bucket.
    met = stage(every.select("a", F.col("b").alias("m"), "size", "distance", "linked").distinct(), "met")
    accepted = met.where("linked")
    near = stage(accepted.groupBy("a").agg(
        F.max("distance").alias("reach"), F.min("size").alias("low"), F.max("size").alias("high"),
        F.min_by("m", F.struct("size", "m")).alias("smallest"), F.max_by("m", F.struct("size", "m")).alias("largest")), "near")
    limit = lambda size: F.floor((1 - similarity) * size + 1e-9)
    slack = F.floor((1 - similarity) / similarity * F.col("size") + 1e-9)  # the largest limit of a pair with this size
    above, below = F.col("size") - F.col("high"), F.col("low") - F.col("size")
    doubtful = stage(met.where(~F.col("linked")).join(near, "a").where(
        (F.col("distance") - F.col("reach") <= slack) & (F.greatest(above, below) <= limit(F.greatest("size", "low")))
    ).select("a", "m", "size", F.greatest(above, below).alias("outside"),
             F.when(above > 0, F.col("largest")).otherwise(F.col("smallest")).alias("end")), "doubtful")

    def apart(roots: DataFrame) -> DataFrame:
        left, right = (roots.select(F.col("id").alias(c), F.col("root").alias(f"root_{c}")) for c in ("a", "m"))
        return doubtful.join(left, "a", "left").join(right, "m", "left").withColumn(
            "root", F.coalesce("root_m", "m")).where(F.coalesce("root_a", "a") != F.col("root")).select(
            "a", "m", "size", "outside", "end", "root")

    first = stage(components(links), "first-classes")
    tried = apart(first).where("outside > 0").groupBy("a", "root", F.col("end").alias("y")).agg(
        F.min_by("m", F.struct("outside", "m")).alias("x"))
    pair = F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")
    bridges = stage(_verified(tried.select(*pair).distinct(), texts, similarity), "bridges").where("linked").select("a", "b")
    classes = stage(components(bridges, first), "bridged-classes")
    refused = stage(apart(classes).select("a", F.col("m").alias("rep")).distinct(), "refused")
    if refused.isEmpty():
        return bridges
    asking = refused.select("rep").distinct()
    offering = accepted.join(refused.select("a").distinct(), "a", "left_semi").select(F.col("m").alias("rep")).distinct()
    asked = stage(_labels(texts.join(asking, "rep", "left_semi")), "asked")
    held = asked.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
    asked = _rarest(asked.join(held, "bucket"), similarity)
    # K-mers that no refused member has come first, and lead to no pair.
    offered = _rarest(_labels(texts.join(offering, "rep", "left_semi")).join(held, "bucket", "left").withColumn(
        "n", F.coalesce("n", F.lit(0))), similarity).where("n > 0")

    def with_class(side: DataFrame, end: str) -> DataFrame:
        return side.join(classes, "id", "left").select(
            "bucket", F.col("id").alias(end), F.col("size").alias(f"size_{end}"), F.coalesce("root", "id").alias(f"root_{end}"))

    longer = F.greatest("size_x", "size_y")
    fits = (F.col("root_x") != F.col("root_y")) & (F.abs(F.col("size_x") - F.col("size_y")) <= limit(longer))
    found = stage(with_class(asked, "x").join(with_class(offered, "y"), "bucket").where(fits).select(*pair).distinct(),
                  "met-across")
    more = stage(_verified(found, texts, similarity), "across").where("linked").select("a", "b")
    return bridges.unionByName(more)


def components(pairs: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """(id, root): the smallest id that each id of the pairs is connected with.

    ``known`` are the components of pairs that count as well; of ``pairs``, only
    those between two of them are looked at again. Each round joins every id to
    its smallest neighbour, follows these to their ends, and goes on with the
    pairs that are left between different ends, so pairs are read few times.
    """
    ids = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    if known is None:
        roots, edges = ids.select("id", F.col("id").alias("root")), pairs.select("a", "b")
    else:
        roots = stage(ids.join(known, "id", "outer").select("id", F.coalesce("root", "id").alias("root")), "roots")
        edges = _between(pairs, roots)
    while True:
        edges = stage(edges.where(F.col("a") != F.col("b")).select(
            F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
        if edges.isEmpty():
            return roots
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        ends = stage(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("root")).withColumnRenamed("a", "id"), "ends")
        while True:
            moved = stage(ends.join(ends.select(F.col("id").alias("root"), F.col("root").alias("far")), "root").select(
                "id", F.col("far").alias("root"), F.col("root").alias("was")), "ends")
            ends = moved.select("id", "root")
            if moved.where(F.col("root") != F.col("was")).isEmpty():
                break
        roots = stage(roots.join(ends.select(F.col("id").alias("root"), F.col("root").alias("end")), "root", "left").select(
            "id", F.coalesce("end", "root").alias("root")), "roots")
        edges = _between(edges, ends)


def _between(edges: DataFrame, roots: DataFrame) -> DataFrame:
    """The pairs with the root of each id in its place."""
    left, right = (roots.select(F.col("id").alias(c), F.col("root").alias(f"root_{c}")) for c in ("a", "b"))
    return edges.join(left, "a").join(right, "b").select(F.col("root_a").alias("a"), F.col("root_b").alias("b"))


def classes(docs: DataFrame, similarity: float = 0.8, sketches: int = 40, picks: int = 6) -> DataFrame:
    """(doc_id, class_id, n_links): each document with the smallest ``doc_id`` of its class.

    ``n_links`` is the number of verified links of the document's text to
    different texts; copies of a text share it.
    """
    given = docs.where(F.col("doc_id").isNotNull() & F.col("text").isNotNull()).select("doc_id", "text")
    sketched = stage(_sketched(given, sketches, picks), "sketches")
    members = stage(_representatives(sketched), "copies")
    pairs = stage(near_pairs(given, sketched, members, similarity, 4 * picks).select("a", "b").distinct(), "near-pairs")
    linked = components(pairs)
    degree = pairs.select(F.explode(F.array("a", "b")).alias("id")).groupBy("id").agg(F.count(F.lit(1)).alias("n"))
    known = (
        members.join(linked.withColumnRenamed("id", "rep"), "rep", "left").join(
            degree.withColumnRenamed("id", "rep"), "rep", "left")
        .select(F.col("doc_id").alias("id"), F.coalesce("root", "rep").alias("class_id"),
                F.coalesce("n", F.lit(0)).alias("n_links"))
    )
    ids = docs.where(F.col("doc_id").isNotNull()).select("doc_id").distinct()
    return ids.join(known, ids.doc_id == known.id, "left").select(
        "doc_id", F.coalesce("class_id", "doc_id").alias("class_id"), F.coalesce("n_links", F.lit(0)).alias("n_links"))


def keep_one(docs: DataFrame, similarity: float = 0.8, sketches: int = 40, picks: int = 6) -> DataFrame:
    """The rows of ``docs`` whose document is the first of its class; rows without ``doc_id`` stay."""
    found = classes(docs, similarity, sketches, picks)
    gone = found.where(F.col("class_id") != F.col("doc_id")).select("doc_id")
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)

