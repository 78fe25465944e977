"""Exact top-k by inner product with a pivot table.

Vectors become integers, ``floor(64 * x)``. The distances of every vector to
``pivots`` pivots are computed once and written beside it. For a query q and a
vector x, each pivot p bounds their distance from below by
``|d(q, p) - d(x, p)|``; the largest of these bounds, L, gives
``q.x <= (|q|^2 + |x|^2 - L^2) / 2``. Candidates are evaluated in the order of
this bound until it is below the k-th best score known, so nothing that could
belong to the result is left out. Where the bounds leave much of a block, its
scores come from one matrix product instead of vectors picked out one by one. A slack covers rounding of the distances;
scores themselves are exact integers.

Pivots are chosen farthest-first among ``sample`` vectors (the smallest hashes
of ``vec_id``), which only affects speed. Queries are sent out in blocks of
``block`` rows, whose size is fixed by that number; every block meets all
vectors in one pass over the table, and each task keeps ``k`` rows per query.

Vectors that are null, or hold a null, NaN or infinite component, take no part,
neither do rows without ``vec_id``. Of rows with one ``vec_id`` the smallest
vector counts. Shorter vectors are filled with zeros; vectors whose products
pass 2**53 raise an error instead of a wrong score.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stockpond.session import stage

_SLACK = 1e-6  # relative, on squared distances


def whole_vectors(df: DataFrame, vector: str = "embedding") -> DataFrame:
    """(vec_id, v): usable vectors as integers."""
    whole = F.transform(vector, lambda x: F.floor(x.cast("double") * 64))
    good = F.col(vector).isNotNull() & F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < 1e12))
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (
        F.abs(x.cast("double")) != float("inf")))
    checked = F.when(good, whole).when(finite, F.raise_error(F.lit("vector too large for exact scores")))
    rows = df.where(F.col("vec_id").isNotNull()).select(F.col("vec_id").cast("bigint").alias("vec_id"), checked.alias("v"))
    return rows.where(F.col("v").isNotNull()).groupBy("vec_id").agg(F.min("v").alias("v"))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of a list column, filled with zeros."""
    if not len(column):
        return np.zeros((0, width))
    values, ends = column.flatten().to_numpy(), column.offsets.to_numpy()
    ends = ends - ends[0]
    size = np.diff(ends)
    out = np.zeros((len(column), width))
    out[np.arange(width) < size[:, None]] = values
    return out


def _distances(rows: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    squares = (rows * rows).sum(axis=1)[:, None] + (pivots * pivots).sum(axis=1) - 2 * rows @ pivots.T
    return np.sqrt(np.maximum(squares, 0))


def choose_pivots(vectors: DataFrame, count: int, sample: int, width: int) -> np.ndarray:
    """Farthest-first among the rows with the smallest hashes; ``sample`` rows reach the driver."""
    rows = vectors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample).select("v").collect()
    pool = np.zeros((len(rows), width))
    for k, r in enumerate(rows):
        pool[k, : len(r["v"])] = r["v"]
    picked = [0]
    apart = _distances(pool, pool[:1])[:, 0]
    while len(picked) < min(count, len(pool)):
        picked.append(int(apart.argmax()))
        apart = np.minimum(apart, _distances(pool, pool[picked[-1:]])[:, 0])
    return pool[picked]


class _Best:
    """The k best (score, smallest id) of each query so far."""

    def __init__(self, ids: np.ndarray, k: int):
        self.ids, self.k = ids, k
        self.score = np.full((len(ids), k), -np.inf)
        self.vec = np.full((len(ids), k), np.iinfo(np.int64).max)

    def limit(self) -> np.ndarray:
        return self.score[:, -1]

    def add(self, rows: np.ndarray, score: np.ndarray, vec: np.ndarray) -> None:
        """Candidates (a row of scores and ids for each of the query ``rows``); -inf where there is none."""
        score = np.concatenate([self.score[rows], score], axis=1)
        vec = np.concatenate([self.vec[rows], vec], axis=1)
        order = np.lexsort((vec, -score), axis=1)[:, : self.k]
        self.score[rows] = np.take_along_axis(score, order, axis=1)
        self.vec[rows] = np.take_along_axis(vec, order, axis=1)


def _bounds(q: np.ndarray, q_pivots: np.ndarray, x: np.ndarray, x_pivots: np.ndarray) -> np.ndarray:
    """What the pivots leave as the highest possible score of each query with each vector, rounded up."""
    lower, gap = np.zeros((2, len(q), len(x)), np.float32)
    q_far, x_far = q_pivots.astype(np.float32), x_pivots.astype(np.float32)
    for p in range(q_far.shape[1]):
        np.subtract(q_far[:, p, None], x_far[None, :, p], out=gap)
        np.abs(gap, out=gap)
        np.maximum(lower, gap, out=lower)
    bound = (q * q).sum(axis=1)[:, None] + (x * x).sum(axis=1)[None, :]
    bound *= 0.5 + _SLACK
    bound += 1
    np.multiply(lower, lower, out=gap)
    bound -= 0.5 * gap.astype(np.float64)
    bound = bound.astype(np.float32)
    return np.nextafter(bound, np.float32(np.inf), out=bound)


def _score_all(best: _Best, rows: np.ndarray, q: np.ndarray, ids: np.ndarray, x: np.ndarray, bound: np.ndarray) -> int:
    """Bring the query ``rows`` up to date by one product with the whole block, less what the bound rules out."""
    score = q[rows] @ x.T
    limit = best.limit()[rows]
    score[(bound[rows] < limit[:, None]) | (bound[rows] == -np.inf)] = -np.inf
    if score.shape[1] > 4 * best.k:
        # Below the k-th of the block nothing counts; what equals it stays, as ties go by the ids.
        many = np.flatnonzero((score >= limit[:, None]).sum(axis=1) > 4 * best.k)
        limit[many] = np.maximum(limit[many], np.partition(score[many], -best.k, axis=1)[:, -best.k])
    hits = (score >= limit[:, None]) & (score > -np.inf)
    count = hits.sum(axis=1)
    some = np.flatnonzero(count)
    if len(some):
        row, column = np.nonzero(hits[some])
        count = count[some]
        place = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
        value = np.full((len(some), count.max()), -np.inf)
        vec = np.full(value.shape, np.iinfo(np.int64).max)
        value[row, place], vec[row, place] = score[some][row, column], ids[column]
        best.add(rows[some], value, vec)
    return score.size


def search_block(best: _Best, q: np.ndarray, q_pivots: np.ndarray, ids: np.ndarray, x: np.ndarray,
                 x_pivots: np.ndarray, step: int = 64, dense: float = 0.0625) -> int:
    """Bring the queries up to date with a block of vectors; returns how many scores were computed.

    A query whose bounds leave more than the share ``dense`` of the block gets
    its scores by one product, which costs less than to pick the vectors out.
    The others meet vectors in the order of their bound until the exact stop.
    """
    bound = _bounds(q, q_pivots, x, x_pivots)
    bound[best.ids[:, None] == ids[None, :]] = -np.inf  # a query is not its own candidate
    left = ((bound >= best.limit()[:, None]) & (bound > -np.inf)).sum(axis=1)
    full, live = np.flatnonzero(left > dense * len(x)), np.flatnonzero((left > 0) & (left <= dense * len(x)))
    computed, at = _score_all(best, full, q, ids, x, bound) if len(full) else 0, 0
    order = np.argsort(-bound[live], axis=1)
    place = np.arange(len(live))
    while at < len(x) and len(live):
        cut = order[place, at: at + step]
        # The bounds fall along a row: if the first of this step is below the k-th score, so are all that follow.
        first = bound[live, cut[:, 0]]
        going = (first >= best.limit()[live]) & (first > -np.inf)
        live, place, cut = live[going], place[going], cut[going]
        if not len(live):
            break
        score = np.einsum("rd,rcd->rc", q[live], x[cut])
        own = ids[cut] == best.ids[live, None]
        computed += int((~own).sum())
        best.add(live, np.where(own, -np.inf, score), np.where(own, np.iinfo(np.int64).max, ids[cut]))
        at, step = at + cut.shape[1], step * 2
    return computed


def top_k(
    vectors: DataFrame, is_query: Column, k: int = 20, vector: str = "embedding", pivots: int = 24, sample: int = 2048,
    block: int = 4096, rows: int = 1024,
) -> DataFrame:
    """(query_id, rank, vec_id, score) of the ``k`` highest inner products of each query with all rows but its own.

    ``is_query`` is a condition on ``vec_id``. Ties go to the smaller ``vec_id``.
    """
    spark = vectors.sparkSession
    whole = stage(whole_vectors(vectors, vector), "whole-vectors")
    width, largest, count = whole.agg(
        F.max(F.size("v")), F.max(F.aggregate("v", F.lit(0).cast("bigint"), lambda a, x: F.greatest(a, F.abs(x)))),
        F.count(F.lit(1))).first()
    schema = "query_id bigint, vec_id bigint, score bigint"
    final = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = F.row_number().over(final)
    if not count or not width:
        pairs = spark.createDataFrame([], schema)
        return pairs.select("query_id", ranked.alias("rank"), "vec_id", "score")
    if width * largest * largest >= 1 << 53:
        raise ValueError("inner products of these vectors may not fit 53 bits")
    chosen = choose_pivots(whole, pivots, sample, width)
    sent = spark.sparkContext.broadcast(chosen)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            far = _distances(_matrix(batch.column("v"), width), sent.value)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("v"), pa.array(list(far), pa.list_(pa.float64()))],
                names=["vec_id", "v", "far"])

    index = stage(whole.mapInArrow(measure, "vec_id bigint, v array<bigint>, far array<double>"), "pivot-table")
    asked = stage(index.where(is_query), "queries")
    found = None
    for part in _query_blocks(asked, block):
        table = part.select("vec_id", "v", "far").toArrow().combine_chunks()  # at most ``block`` rows
        batch = table.to_batches()[0] if table.num_rows else None
        if batch is None:
            continue
        shared = spark.sparkContext.broadcast((
            batch.column("vec_id").to_numpy(), _matrix(batch.column("v"), width),
            _matrix(batch.column("far"), len(chosen))))

        def search(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            own, q, q_far = shared.value
            best = _Best(own, k)
            for batch in batches:
                ids = batch.column("vec_id").to_numpy()
                x, far = _matrix(batch.column("v"), width), _matrix(batch.column("far"), len(chosen))
                for a in range(0, len(ids), rows):
                    for b in range(0, len(own), 512):
                        part = _Best(own[b: b + 512], k)
                        part.score, part.vec = best.score[b: b + 512], best.vec[b: b + 512]
                        search_block(part, q[b: b + 512], q_far[b: b + 512], ids[a: a + rows], x[a: a + rows],
                                     far[a: a + rows])
            good = best.score > -np.inf
            yield pa.RecordBatch.from_pydict({
                "query_id": np.repeat(own, k).reshape(best.vec.shape)[good], "vec_id": best.vec[good],
                "score": best.score[good].astype(np.int64)})

        one = stage(index.mapInArrow(search, schema), "nearest")
        found = one if found is None else found.unionByName(one)
    pairs = found if found is not None else spark.createDataFrame([], schema)
    return pairs.select("query_id", ranked.alias("rank"), "vec_id", "score").where(F.col("rank") <= k)


def _query_blocks(asked: DataFrame, block: int) -> Iterator[DataFrame]:
    """Disjoint parts of the queries with about ``block`` / 2 and at most ``block`` rows each, cut at values of ``vec_id``."""
    total = asked.count()
    if total <= block:
        yield asked
        return
    parts = -(-2 * total // block)
    steps = [i / parts for i in range(1, parts)]
    cuts = asked.select(F.percentile_approx("vec_id", steps, 100 * parts).alias("c")).first()["c"]
    edges = [None, *sorted(set(cuts)), None]
    for low, high in zip(edges[:-1], edges[1:], strict=True):
        part = asked
        if low is not None:
            part = part.where(F.col("vec_id") > low)
        if high is not None:
            part = part.where(F.col("vec_id") <= high)
        yield part
