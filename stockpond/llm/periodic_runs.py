"""Periodic runs of words: suffix classes united by falling LCP, with ordered position sets.

A run is a stretch of consecutive words whose smallest period q repeats at
least twice (and fills ``least`` words), as long as neighbouring words allow.

1. Words of a text become numbers. A run of ``least`` words or more has two
   suffixes q apart with a common prefix of at least ``least // 2`` words, so a
   text in which no window of that many words repeats has none; that is told by
   rolling hashes (equal windows have equal hashes, so nothing is missed).
2. The other texts get a suffix array by prefix doubling, whose ranks also give
   the longest common prefixes (LCP) of neighbours in it.
3. As in Kruskal's algorithm, neighbours are united in the order of falling
   LCP. A class is a stretch of the suffix array; union-find keeps its ordered
   set of text positions. The smaller set goes into the larger one, and each
   pair of positions i < j that become neighbours in the text order has exactly
   the LCP of the union as common prefix. If j - i is at most that LCP, both
   are the start of a square: words from i to j + LCP have the period j - i. It
   is the smallest one, as a smaller period would have put a position between
   them at a higher LCP. The pair is the start of a run if the words before i
   and j differ; the run ends where the common prefix ends. So every run is
   found once, with its exact ends, and no extension is needed.

A text is the unit of work: nothing is shuffled, and the work for a text of n
words is n log n for the sorting and n log n set insertions at most. Texts of
a batch are handled one by one, so memory is bounded by the longest text. Null
and empty texts have no words and no runs. Rows with repeated or null
``doc_id`` are handled on their own.
"""

from __future__ import annotations

from bisect import bisect_left

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockpond.llm.common import map_rows

LEAST = 12
_BASE = np.uint64(0x9E3779B97F4A7C15)


def word_numbers(words: list[bytes]) -> np.ndarray:
    """Equal numbers for equal words."""
    known: dict[bytes, int] = {}
    return np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, len(words))


def has_repeat(symbols: np.ndarray, width: int) -> bool:
    """False only if no window of ``width`` symbols occurs twice."""
    size = len(symbols) - width + 1
    if size < 2:
        return False
    value = np.zeros(size, np.uint64)
    scattered = (symbols.astype(np.uint64) + np.uint64(1)) * _BASE
    scattered ^= scattered >> np.uint64(31)
    for k in range(width):
        value = value * _BASE + scattered[k: k + size]
    value.sort()
    return bool((value[1:] == value[:-1]).any())


def suffix_array(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the suffixes in their order, and the LCP of each with the one before it (0 for the first)."""
    n = len(symbols)
    rank = np.unique(symbols, return_inverse=True)[1].astype(np.int64) + 1
    levels, width = [rank], 1
    while True:
        key = rank * (n + 1)  # 0 stands for the end of the text
        key[: n - width] += rank[width:] if width < n else 0
        order = np.argsort(key, kind="stable")
        ordered = key[order]
        if n > 1:
            rank = np.empty(n, np.int64)
            rank[order] = np.cumsum(np.r_[True, ordered[1:] != ordered[:-1]])
        width *= 2
        if n < 2 or rank[order[-1]] == n:
            break
        levels.append(rank)
    # Two suffixes share 2**k symbols where their ranks at level k are equal (and both are that long).
    lcp = np.zeros(n, np.int64)
    left, right = order[:-1], order[1:]
    shared = np.zeros(max(0, n - 1), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        padded = np.r_[levels[k], -1]
        a, b = np.minimum(left + shared, n), np.minimum(right + shared, n)
        whole = np.maximum(a, b) + (1 << k) <= n
        shared += np.where(whole & (padded[a] == padded[b]), 1 << k, 0)
    lcp[1:] = shared
    return order, lcp


def _meet(large: list[int], small: list[int]) -> tuple[list[int], list[tuple[int, int]]]:
    """The union of two ordered sets, and the pairs of neighbours with one member of each."""
    if len(small) * 8 > len(large):
        inside = set(small)
        merged = sorted(large + small)  # two ordered stretches: one merge
        return merged, [(a, b) for a, b in zip(merged, merged[1:]) if (a in inside) != (b in inside)]
    met, inside = [], set(small)
    for position in small:  # in rising order, so what stands before it is final
        at = bisect_left(large, position)
        if at and large[at - 1] not in inside:
            met.append((large[at - 1], position))
        large.insert(at, position)
    for position in small:
        at = bisect_left(large, position) + 1
        if at < len(large) and large[at] not in inside:
            met.append((position, large[at]))
    return large, met


def find_runs(symbols: np.ndarray, least: int = LEAST) -> list[tuple[int, int, int]]:
    """(start, length, period) of each run, by start and period."""
    level = max(1, least // 2)
    if not has_repeat(symbols, level):
        return []
    order, lcp = suffix_array(symbols)
    where = np.flatnonzero(lcp >= level)
    where = where[np.argsort(-lcp[where], kind="stable")]
    text, places = symbols.tolist(), order.tolist()
    owner = list(range(len(places)))  # union-find over places of the suffix array
    members: dict[int, list[int]] = {}
    runs = []

    def root(k: int) -> int:
        while owner[k] != k:
            owner[k] = owner[owner[k]]
            k = owner[k]
        return k

    for k, shared in zip(where.tolist(), lcp[where].tolist(), strict=True):
        a, b = root(k - 1), root(k)
        one, two = members.pop(a, None) or [places[a]], members.pop(b, None) or [places[b]]
        if len(one) < len(two):
            a, b, one, two = b, a, two, one
        owner[b] = a
        members[a], met = _meet(one, two)
        for i, j in met:
            period = j - i
            if period <= shared and period + shared >= least and (i == 0 or text[i - 1] != text[j - 1]):
                runs.append((i, period + shared, period))
    runs.sort(key=lambda r: (r[0], r[2]))
    return runs


def kept_words(n: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """Which of n words stay if each run keeps its first period only."""
    cover = np.zeros(n + 1, np.int64)
    for start, length, period in runs:
        cover[start + period] += 1
        cover[start + length] -= 1
    return np.cumsum(cover[:n]) == 0


def made_periodic(words: list[bytes], number: int) -> list[bytes]:
    """The words from one place on replaced by a few of them over and over, as ``number`` tells."""
    n, g = len(words), number // 10
    if number % 10 or not n:
        return words
    a = g % n
    period = 1 + (n - a) // (3 + g % 8)
    cycle = words[a: a + period]
    return words[:a] + (cycle * (-(-(n - a) // period)))[: n - a]


def runs_of(docs: DataFrame, text: str = "text", alter: Column | None = None, least: int = LEAST) -> DataFrame:
    """(doc_id, n_words, runs, collapsed) of every row.

    ``runs`` is an array of (start, length, period), ``collapsed`` the text with
    each run cut to its first period and the words joined by one space.
    ``alter`` is a number for each row by which ``made_periodic`` first changes
    the words; none changes nothing.
    """
    number = F.lit(1) if alter is None else F.coalesce(alter, F.lit(1))
    given = docs.select("doc_id", number.cast("bigint").alias("alter"),
                        F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text"))

    def make():
        def step(rows: dict[str, list]) -> dict[str, list]:
            out: dict[str, list] = {"doc_id": rows["doc_id"], "n_words": [], "runs": [], "collapsed": []}
            for data, change in zip(rows["text"], rows["alter"], strict=True):
                words = made_periodic(data.split(), change)  # bytes are cut at ASCII blanks only
                runs = find_runs(word_numbers(words), least) if len(words) >= least else []
                if runs:
                    kept = np.flatnonzero(kept_words(len(words), runs)).tolist()
                    left = b" ".join([words[k] for k in kept])
                else:
                    left = b" ".join(words)
                out["n_words"].append(len(words))
                out["runs"].append([{"start": s, "length": n, "period": q} for s, n, q in runs])
                out["collapsed"].append(left.decode("utf-8", "replace"))
            return out

        return step

    kind = dict(given.dtypes)["doc_id"]
    return map_rows(given, make, f"doc_id {kind}, n_words bigint, "
                    "runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string", rows=256)


def longest_run(runs: Column) -> Column:
    """The run with the greatest length; of equal ones that with the smallest start, then period."""
    return F.element_at(F.sort_array(F.transform(runs, lambda r: F.struct(
        (-r["length"]).alias("l"), r["start"].alias("start"), r["period"].alias("period"), r["length"].alias("length")))), 1)
