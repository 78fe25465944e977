"""Hard negatives from an exact search in a GNAT-style tree of split points.

Scores are integer inner products. Since ``|a - x|^2 = |a|^2 + |x|^2 - 2 a.x``, a
window of scores around an anchor is an annulus of distances, whose radii
follow from the norms of the rows in question.

1. The tree has two levels of up to ``fanout`` split points, chosen
   farthest-first from a sample of ``sample`` rows (the smallest hashes of
   ``vec_id``), which affects speed only. Every row descends to the leaf of its
   nearest split points (the side of the hyperplanes it lies on) and keeps its
   distances to the split points that it met.
2. Each split point has the range of distances to every sibling subtree, taken
   over all rows. A subtree is left out for an anchor if, for some split point,
   the distances that the annulus allows do not meet that range. The tree with
   its ranges has a size fixed by ``fanout`` and is sent to all tasks.
3. Rows are ordered by leaf and distance and cut into bins, a large leaf into
   several of them, so a vector that a third of all rows share is spread.
   Anchors go to the bins of their leaves only; in a bin the rows come in pages,
   each with its own ranges, and what is left is evaluated exactly.
4. The leaf that an anchor lies in is visited first. Its k-th best score narrows
   the annulus before all other leaves are looked at.

An anchor's positives are the ``positives`` best rows of its label; for each of
them the ``negatives`` best rows of other labels whose score lies within
``low`` / 100 and ``high`` / 100 of the positive's. Ties go to the smaller
``vec_id``. Every row is a candidate and every row that is an anchor is one of
its own, repeated rows included; rows with the anchor's own ``vec_id`` are left
out. Rows without ``vec_id`` or label, and vectors that are null, or hold a
null, NaN or infinite component, take no part. Shorter vectors are filled with
zeros. Scores are computed in double precision where that is exact, else in
64-bit or unbounded integers; a returned score that does not fit a bigint is an
error, as is a component of which the integer does not.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stockpond.session import stage

_SLACK = 1e-6  # of the norms; covers the rounding of distances
_PAGE = 256
_LOWEST, _HIGHEST = -(1 << 63), (1 << 63) - 1  # bounds of open windows


def whole_vectors(df: DataFrame, label: Column, scale: int, vector: str = "embedding") -> DataFrame:
    """(row, vec_id, label, v): usable rows, numbered, with integer vectors."""
    def number(x: Column) -> Column:
        value = F.floor(x.cast("double") * scale)
        return F.when(F.abs(x.cast("double") * scale) < 2.0**63, value).otherwise(
            F.raise_error(F.lit("a component does not fit a bigint")).cast("bigint"))

    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (
        F.abs(x.cast("double")) != float("inf")))
    rows = df.select(F.col("vec_id").cast("bigint").alias("vec_id"), label.cast("bigint").alias("label"), vector).where(
        F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col(vector).isNotNull() & finite)
    numbered = rows.select(F.monotonically_increasing_id().alias("row"), "vec_id", "label",
                           F.transform(vector, number).alias("v"))
    return stage(numbered, "whole-vectors")  # numbers are drawn once


def _matrix(column: pa.Array, width: int, dtype=np.int64) -> np.ndarray:
    """Rows of a list column, filled with zeros."""
    out = np.zeros((len(column), width), dtype)
    if len(column):
        values, ends = column.flatten().to_numpy(), column.offsets.to_numpy()
        size = np.diff(ends)
        out[np.arange(width) < size[:, None]] = values
    return out


def _distances(rows: np.ndarray, points: np.ndarray) -> np.ndarray:
    rows, points = rows.astype(np.float64), points.astype(np.float64)
    squares = (rows * rows).sum(axis=1)[:, None] + (points * points).sum(axis=1) - 2 * rows @ points.T
    return np.sqrt(np.maximum(squares, 0))


def _farthest_first(pool: np.ndarray, count: int) -> np.ndarray:
    """Different rows of the pool, each farthest from those before."""
    picked, apart = [0], _distances(pool, pool[:1])[:, 0]
    while len(picked) < count and apart.max() > 0:
        picked.append(int(apart.argmax()))
        apart = np.minimum(apart, _distances(pool, pool[picked[-1:]])[:, 0])
    return pool[picked]


class Tree:
    """Two levels of split points, and the ranges of distances to the rows of each leaf."""

    def __init__(self, pool: np.ndarray, fanout: int):
        self.fanout = fanout
        self.root = _farthest_first(pool, fanout)
        side = _distances(pool, self.root).argmin(axis=1)
        self.inner = [_farthest_first(np.concatenate([point[None], pool[side == k]]), fanout)
                      for k, point in enumerate(self.root)]
        self.scale = float(np.sqrt((pool.astype(np.float64) ** 2).sum(axis=1)).max())
        leaves = len(self.root) * fanout
        #: Ranges of a leaf: distances to the root's split points, then to those of its own node; norms.
        self.low = np.full((leaves, 2 * fanout), np.inf)
        self.high = np.full((leaves, 2 * fanout), -np.inf)
        self.norm = np.tile([np.inf, -np.inf], (leaves, 1))

    def descend(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The leaf of each row, and its distances to the split points on its way (nan where there are none)."""
        far = np.full((len(rows), 2 * self.fanout), np.nan)
        far[:, : len(self.root)] = _distances(rows, self.root)
        side = far[:, : len(self.root)].argmin(axis=1) if len(rows) else np.zeros(0, np.int64)
        leaf = side * self.fanout
        for k in np.unique(side):
            inside = np.flatnonzero(side == k)
            near = _distances(rows[inside], self.inner[k])
            far[inside, self.fanout: self.fanout + near.shape[1]] = near
            leaf[inside] += near.argmin(axis=1)
        return leaf, far

    def learn(self, ranges: list) -> None:
        """Take over (leaf, low, high, norm_low, norm_high) of all leaves that hold rows."""
        for r in ranges:
            self.low[r["leaf"]], self.high[r["leaf"]] = r["low"], r["high"]
            self.norm[r["leaf"]] = r["norm_low"], r["norm_high"]

    def survivors(self, anchors: np.ndarray, least: np.ndarray, most: np.ndarray) -> np.ndarray:
        """(anchor, leaf): whether the leaf may hold rows with a score from ``least`` to ``most``."""
        out = np.zeros((len(anchors), len(self.low)), bool)
        to_root = _distances(anchors, self.root)
        for k in range(len(self.root)):
            leaves = np.arange(k * self.fanout, k * self.fanout + len(self.inner[k]))
            leaves = leaves[self.norm[leaves, 0] < np.inf]
            if not len(leaves):
                continue
            # The subtree first: one test of the root's ranges spares those of all its leaves.
            low, high = self.low[leaves, : len(self.root)].min(axis=0), self.high[leaves, : len(self.root)].max(axis=0)
            norms = self.norm[leaves, 0].min(), self.norm[leaves, 1].max()
            left = np.flatnonzero(may_hold(anchors, least, most, to_root, low, high, norms))
            if not len(left):
                continue
            inner = _distances(anchors[left], self.inner[k])
            far = np.concatenate([to_root[left], inner], axis=1)
            columns = np.r_[: len(self.root), self.fanout: self.fanout + inner.shape[1]]
            for leaf in leaves:
                out[left, leaf] = may_hold(anchors[left], least[left], most[left], far, self.low[leaf, columns],
                                           self.high[leaf, columns], self.norm[leaf])
        return out


def may_hold(anchors: np.ndarray, least: np.ndarray, most: np.ndarray, far: np.ndarray, low: np.ndarray,
             high: np.ndarray, norms: tuple) -> np.ndarray:
    """For each anchor, whether rows within the ranges may have a score from ``least`` to ``most``.

    ``far`` has the anchors' distances to the split points, ``low`` and ``high``
    the least and greatest distances of the rows to them, ``norms`` the least
    and greatest squared norm of the rows.
    """
    own = (anchors.astype(np.float64) ** 2).sum(axis=1)
    slack = _SLACK * (np.sqrt(own) + np.sqrt(norms[1])) + 1e-6
    widest = own + norms[1] - 2 * least
    inner = np.sqrt(np.maximum(own + norms[0] - 2 * most, 0))
    outer = np.sqrt(np.maximum(widest, 0))
    possible = widest >= -slack * slack
    # x is in the annulus: |d(a, p) - d(a, x)| <= d(p, x) <= d(a, p) + d(a, x).
    slack = slack[:, None] + _SLACK * far
    nearest = np.maximum(far - outer[:, None], inner[:, None] - far) - slack
    farthest = far + outer[:, None] + slack
    return possible & ~((nearest > high) | (farthest < low)).any(axis=1)


class _Scorer:
    """Exact inner products of integer rows."""

    def __init__(self, width: int, largest: int):
        bound = width * largest * largest
        self.dtype = np.float64 if bound < 1 << 53 else np.int64 if bound < 1 << 63 else object

    def of(self, anchors: np.ndarray, rows: np.ndarray) -> np.ndarray:
        return anchors.astype(self.dtype) @ rows.astype(self.dtype).T


class _Pool:
    """The k best (score, smallest vec_id) of each (anchor, window) of a group of anchors."""

    def __init__(self, least: np.ndarray, k: int):
        self.least, self.k = least.copy(), k  # (anchor, window): scores below take no part any more
        self.parts: list[tuple] = []
        self.size = 0

    def add(self, anchor: np.ndarray, window: int, score: np.ndarray, vec: np.ndarray) -> None:
        self.parts.append((anchor, np.full(len(anchor), window), score, vec))
        self.size += len(anchor)
        if self.size > 1 << 18:
            self.reduce()

    def reduce(self) -> tuple:
        if not self.parts:
            return tuple(np.zeros(0, np.int64) for _ in range(4))
        anchor, window, score, vec = (np.concatenate(c) for c in zip(*self.parts, strict=True))
        if score.dtype == object:
            order = np.array(sorted(range(len(score)), key=lambda i: (anchor[i], window[i], -score[i], vec[i])))
        else:
            order = np.lexsort((vec, -score, window, anchor))
        anchor, window, score, vec = anchor[order], window[order], score[order], vec[order]
        fresh = np.r_[True, (anchor[1:] != anchor[:-1]) | (window[1:] != window[:-1])]
        place = np.arange(len(anchor)) - np.maximum.accumulate(np.where(fresh, np.arange(len(anchor)), 0))
        kept = place < self.k
        last = place == self.k - 1
        self.least[anchor[last], window[last]] = np.maximum(self.least[anchor[last], window[last]], score[last])
        self.parts = [(anchor[kept], window[kept], score[kept], vec[kept])]
        self.size = int(kept.sum())
        return self.parts[0]


class Index:
    """The rows in bins by leaf, the tree, and the search."""

    def __init__(self, whole: DataFrame, fanout: int, sample: int, bin_rows: int, group: int):
        spark = whole.sparkSession
        self.spark, self.group = spark, group
        self.width, largest, self.rows = whole.agg(
            F.greatest(F.coalesce(F.max(F.size("v")), F.lit(1)), F.lit(1)),
            F.coalesce(F.max(F.greatest(F.array_max("v"), -F.array_min("v"))), F.lit(0)), F.count(F.lit(1))).first()
        self.scorer = _Scorer(self.width, int(largest))
        if not self.rows:
            return
        chosen = whole.orderBy(F.xxhash64("vec_id"), "vec_id", "row").limit(sample).select("v").toArrow().combine_chunks()
        tree = Tree(_matrix(chosen.column("v").combine_chunks(), self.width), fanout)
        width, sent = self.width, spark.sparkContext.broadcast(tree)

        def descend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                rows = _matrix(batch.column("v"), width)
                leaf, far = sent.value.descend(rows)
                near = far[np.arange(len(leaf)), fanout + leaf % fanout]
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c) for c in ("row", "vec_id", "label", "v")), pa.array(leaf, pa.int32()), pa.array(near),
                     pa.array((rows.astype(np.float64) ** 2).sum(axis=1)), pa.array(list(far), pa.list_(pa.float64()))],
                    names=["row", "vec_id", "label", "v", "leaf", "near", "norm", "far"])

        placed = stage(whole.mapInArrow(descend, "row bigint, vec_id bigint, label bigint, v array<bigint>, leaf int, "
                                        "near double, norm double, far array<double>"), "leaves")
        # Range bounds are sampled, so the bins are written once and named there.
        bins = max(1, -(-self.rows // bin_rows))
        self.index = stage(placed.repartitionByRange(bins, "leaf", "near", "row").withColumn("bin", F.spark_partition_id()),
                           "bins")
        ranges = [F.array(*[agg(F.get("far", F.lit(k))) for k in range(2 * fanout)]).alias(name)
                  for name, agg in (("low", F.min), ("high", F.max))]
        tree.learn(placed.groupBy("leaf").agg(*ranges, F.min("norm").alias("norm_low"), F.max("norm").alias("norm_high")).select(
            "leaf", *[F.transform(c, lambda x: F.coalesce(x, F.lit(float("nan")))).alias(c) for c in ("low", "high")],
            "norm_low", "norm_high").collect())  # at most fanout * fanout rows
        self.homes = stage(self.index.groupBy("leaf", "bin").agg(F.count(F.lit(1)).alias("n")), "leaf-bins")
        self.tree = spark.sparkContext.broadcast(tree)

    def _visits(self, asked: DataFrame, home_only: bool) -> DataFrame:
        """(row, bin): the bins that each anchor has to visit."""
        tree, width = self.tree, self.width

        def traverse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for start in range(0, batch.num_rows, 256):
                    part = batch.slice(start, 256)
                    anchors = _matrix(part.column("v"), width)
                    if home_only:
                        leaf, _ = tree.value.descend(anchors)
                        who = np.arange(len(leaf))
                    else:
                        least = np.array([min(x) for x in part.column("least").to_pylist()], np.float64)
                        most = np.array([max(x) for x in part.column("most").to_pylist()], np.float64)
                        who, leaf = np.nonzero(tree.value.survivors(anchors, least, most))
                    rows = part.column("row").to_numpy()[who]
                    yield pa.RecordBatch.from_pydict({"row": pa.array(rows, pa.int64()), "leaf": pa.array(leaf, pa.int32())})

        found = asked.select("row", "v", "least", "most").mapInArrow(traverse, "row bigint, leaf int")
        return found.join(self.homes.select("leaf", "bin"), "leaf").select("row", "bin").distinct()

    def best(self, asked: DataFrame, k: int, same: bool, home_only: bool = False) -> DataFrame:
        """(row, window, vec_id, score): the ``k`` best rows of each anchor and window, as found in each bin.

        ``asked`` has (row, vec_id, label, v, least, most), the latter two arrays
        with the bounds of the anchor's windows. ``same`` looks for the anchor's
        label, otherwise for all others. With ``home_only`` a part of the rows is
        searched, and the result is a lower bound. Groups of at most about
        ``group`` anchors meet a bin together.
        """
        spark, tree, width, scorer = self.spark, self.tree, self.width, self.scorer
        groups = max(1, -(-asked.count() // self.group))
        schema = ("bin int, grp int, kind int, leaf int, near double, row bigint, vec_id bigint, label bigint, "
                  "v array<bigint>, norm double, far array<double>, least array<bigint>, most array<bigint>")
        nothing = {"leaf": F.lit(-1), "near": F.lit(0.0), "norm": F.lit(0.0), "far": F.lit(None).cast("array<double>")}
        own = F.pmod(F.xxhash64("row"), F.lit(groups)).cast("int")
        anchors = self._visits(asked, home_only).join(asked, "row").withColumns({"grp": own, "kind": F.lit(0), **nothing})
        bounds = {c: F.lit(None).cast("array<bigint>") for c in ("least", "most")}
        wanted = anchors.select("bin", "grp").distinct()
        rows = self.index.join(wanted, "bin").withColumns({"kind": F.lit(1), **bounds})
        order = [f.split()[0] for f in schema.split(", ")]
        both = anchors.select(order).unionByName(rows.select(order)).repartition("bin", "grp").sortWithinPartitions(
            "bin", "grp", "kind", "leaf", "near", "row")

        def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            key, held = None, None
            waiting: list[pa.RecordBatch] = []
            for batch in batches:
                keys = np.stack([batch.column(c).to_numpy() for c in ("bin", "grp", "kind", "leaf")], axis=1)
                cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
                for a, b in zip(np.r_[0, cuts], np.r_[cuts, len(keys)], strict=True):
                    now = tuple(keys[a, :2].tolist())
                    if now != key:
                        if held is not None:
                            yield held.found()
                        key, held, waiting = now, None, []
                    part = batch.slice(a, b - a)
                    if keys[a, 2] == 0:
                        waiting.append(part)
                        continue
                    if held is None:
                        held = _Visit(pa.Table.from_batches(waiting).combine_chunks().to_batches(), width, k, same, scorer,
                                      tree.value)
                    for first in range(0, part.num_rows, _PAGE):
                        held.page(part.slice(first, _PAGE))
            if held is not None:
                yield held.found()

        return both.mapInArrow(search, "row bigint, window int, vec_id bigint, score bigint")


class _Visit:
    """Anchors that visit a bin together."""

    def __init__(self, batches: list[pa.RecordBatch], width: int, k: int, same: bool, scorer: _Scorer, tree: Tree):
        batch = batches[0]
        self.tree, self.scorer, self.width, self.same = tree, scorer, width, same
        self.row, self.vec, self.label = (batch.column(c).to_numpy() for c in ("row", "vec_id", "label"))
        self.v = _matrix(batch.column("v"), width)
        least, most = batch.column("least").to_pylist(), batch.column("most").to_pylist()
        size = max(map(len, least))
        kind = object if scorer.dtype is object else np.int64
        # A window that is not there is empty.
        self.most = np.array([x + [_LOWEST] * (size - len(x)) for x in most], kind)
        least = np.array([x + [_HIGHEST] * (size - len(x)) for x in least], kind)
        if kind is object:  # open windows hold scores that no bigint holds, so that these become errors
            self.most[self.most == _HIGHEST] = 1 << 200
            least[least == _LOWEST] = -(1 << 200)
        self.pool = _Pool(least, k)
        self.to_root = _distances(self.v, tree.root)
        self.to_inner: tuple[int, np.ndarray] = (-1, np.zeros(0))

    def page(self, rows: pa.RecordBatch) -> None:
        """Rows of one leaf: ranges first, then exact scores of the anchors that are left."""
        tree, node = self.tree, int(rows.column("leaf")[0].as_py()) // self.tree.fanout
        if self.to_inner[0] != node:
            self.to_inner = node, np.concatenate([self.to_root, _distances(self.v, tree.inner[node])], axis=1)
        columns = np.r_[: len(tree.root), tree.fanout: tree.fanout + len(tree.inner[node])]
        far = rows.column("far").flatten().to_numpy().reshape(rows.num_rows, -1)[:, columns]
        norm = rows.column("norm").to_numpy()
        least = self.pool.least
        open_ = least <= self.most
        lowest = np.where(open_, least, _HIGHEST).min(axis=1).astype(np.float64)
        highest = np.where(open_, self.most, _LOWEST).max(axis=1).astype(np.float64)
        left = np.flatnonzero(open_.any(axis=1) & may_hold(
            self.v, lowest, highest, self.to_inner[1], far.min(axis=0), far.max(axis=0), (norm.min(), norm.max())))
        if not len(left):
            return
        vec, label = rows.column("vec_id").to_numpy(), rows.column("label").to_numpy()
        score = self.scorer.of(self.v[left], _matrix(rows.column("v"), self.width))
        fits = (self.label[left, None] == label) == self.same
        fits &= self.vec[left, None] != vec
        for window in range(least.shape[1]):
            good = fits & (score >= self.pool.least[left, window, None]) & (score <= self.most[left, window, None])
            who, which = np.nonzero(good)
            if len(who):
                found = score[who, which]
                self.pool.add(left[who], window, found if found.dtype == object else found.astype(np.int64), vec[which])

    def found(self) -> pa.RecordBatch:
        anchor, window, score, vec = self.pool.reduce()
        return pa.RecordBatch.from_pydict({
            "row": pa.array(self.row[anchor], pa.int64()), "window": pa.array(window.astype(np.int32), pa.int32()),
            "vec_id": pa.array(vec, pa.int64()), "score": pa.array(score.tolist(), pa.int64())})


def _first(found: DataFrame, by: list[str], k: int) -> DataFrame:
    """``found`` with ``rank`` from 1 to ``k`` by score and ``vec_id``."""
    order = Window.partitionBy(*by).orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def mine(
    vectors: DataFrame, is_anchor: Column, label: Column | None = None, positives: int = 5, negatives: int = 3,
    low: int = 50, high: int = 95, scale: int = 256, vector: str = "embedding", fanout: int = 16, sample: int = 4096,
    bin_rows: int = 8192, group: int = 16384,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of all anchors.

    ``is_anchor`` is a condition on ``vec_id``, ``label`` a column that replaces
    the label. ``low`` and ``high`` are hundredths of the positive's score.
    """
    spark = vectors.sparkSession
    whole = whole_vectors(vectors, F.col("label") if label is None else label, scale, vector)
    index = Index(whole, fanout, sample, bin_rows, group)
    if not index.rows:
        return spark.createDataFrame([], "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, "
                                         "positive_score bigint, negative_score bigint")
    anchors = stage(whole.where(is_anchor), "anchors")

    # Positives: the home leaf gives a bound, the tree the rest.
    one = anchors.withColumns({"least": F.array(F.lit(_LOWEST)), "most": F.array(F.lit(_HIGHEST))})
    bound = _first(index.best(one, positives, True, home_only=True), ["row"], positives).groupBy("row").agg(
        F.max(F.when(F.col("rank") == positives, F.col("score"))).alias("bound"))
    asked = one.join(bound, "row", "left").withColumn("least", F.array(F.coalesce("bound", F.lit(_LOWEST)))).drop("bound")
    found = _first(index.best(stage(asked, "asked-positives"), positives, True), ["row"], positives)
    best = stage(found.select("row", (F.col("rank") - 1).alias("window"), F.col("vec_id").alias("positive_id"),
                              F.col("score").alias("positive_score")), "positives")

    # Negatives: one window for each positive, narrowed by what the home leaf holds.
    score = F.col("positive_score").cast("decimal(20,0)")
    bounded = best.withColumns({
        "least": F.ceil(score * low / 100).cast("bigint"), "most": F.floor(score * high / 100).cast("bigint")})
    windows = stage(bounded.select("row", "window", "least", "most"), "windows")

    def requests(given: DataFrame) -> DataFrame:
        per_anchor = given.groupBy("row").agg(
            F.array_sort(F.collect_list(F.struct("window", "least", "most"))).alias("w")).where(
            F.exists("w", lambda x: x["least"] <= x["most"]))  # at most ``positives`` windows
        return anchors.join(per_anchor.select("row", F.col("w.least").alias("least"), F.col("w.most").alias("most")), "row")

    first = _first(index.best(stage(requests(windows), "asked-home"), negatives, False, home_only=True),
                   ["row", "window"], negatives)
    third = first.where(F.col("rank") == negatives).select("row", "window", F.col("score").alias("bound"))
    narrowed = windows.join(third, ["row", "window"], "left").withColumn(
        "least", F.greatest("least", F.coalesce("bound", "least"))).drop("bound")
    hard = _first(index.best(stage(requests(narrowed), "asked-negatives"), negatives, False), ["row", "window"], negatives)
    ids = anchors.select("row", F.col("vec_id").alias("anchor_id"))
    return hard.join(best, ["row", "window"]).join(ids, "row").select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"))
