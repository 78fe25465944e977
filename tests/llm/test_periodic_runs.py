"""Periodic runs against a search of every period, and the query against its definition."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from stockpond.llm import periodic_runs as P
from stockpond.llm import queries


def every_run(words: list, least: int = 12) -> list[tuple[int, int, int]]:
    """All runs by trying all periods at all places."""
    n, found = len(words), []
    for q in range(1, n // 2 + 1):
        k = 0
        while k < n - q:
            end = k
            while end < n - q and words[end] == words[end + q]:
                end += 1
            stretch = words[k: end + q]
            size = len(stretch)
            if end > k and size >= max(least, 2 * q) and not any(
                    stretch[p:] == stretch[: size - p] for p in range(1, q)):
                found.append((k, size, q))
            k = max(end, k + 1)
    return sorted(found, key=lambda r: (r[0], r[2]))


def expected(number: int | None, text: str | None) -> tuple:
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    h = 1 if number is None else zlib.crc32(str(number).encode())
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    runs = every_run(words)
    gone = {i for s, size, q in runs for i in range(s + q, s + size)}
    top = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None, None, None)
    digest = [hashlib.sha256(t.encode()).hexdigest() for t in (
        "".join(f"{s},{size},{q}\n" for s, size, q in runs), " ".join(w for i, w in enumerate(words) if i not in gone))]
    return len(runs), *top, 1000 * top[1] // top[2] if runs else None, *digest


@pytest.mark.parametrize("seed", range(6))
def test_runs_against_all_periods(seed):
    rng = random.Random(seed)
    for _ in range(250):
        n, letters, least = rng.randrange(80), rng.choice([1, 2, 2, 3, 5]), rng.choice([2, 4, 7, 12])
        word = [rng.randrange(letters) for _ in range(n)]
        if n and rng.random() < 0.5:
            cut = rng.randrange(n)
            period = 1 + (n - cut) // rng.randrange(2, 8)
            word = word[:cut] + [word[cut + (i - cut) % period] for i in range(cut, n)]
            if rng.random() < 0.5:
                word[rng.randrange(n)] = 9
        assert P.find_runs(np.array(word, np.int64), least) == every_run(word, least), (word, least)


def test_suffix_array_and_prefixes():
    rng = random.Random(3)
    for _ in range(200):
        word = [rng.randrange(3) for _ in range(rng.randrange(1, 40))]
        order, lcp = P.suffix_array(np.array(word, np.int64))
        assert order.tolist() == sorted(range(len(word)), key=lambda k: word[k:])
        for k in range(1, len(word)):
            one, two = word[order[k - 1]:], word[order[k]:]
            shared = next((i for i, (x, y) in enumerate(zip(one, two)) if x != y), min(len(one), len(two)))
            assert lcp[k] == shared


@pytest.mark.parametrize("sizes", [(50, 3), (5, 4), (40, 40)])
def test_meeting_sets(sizes):
    rng = random.Random(7)
    drawn = rng.sample(range(500), sum(sizes))
    large, small = sorted(drawn[: sizes[0]]), sorted(drawn[sizes[0]:])
    every = sorted(drawn)
    pairs = [(a, b) for a, b in zip(every, every[1:]) if (a in small) != (b in small)]
    merged, met = P._meet(list(large), list(small))
    assert merged == every and sorted(met) == pairs


def test_query_against_definition(spark, documents, tmp_path):
    rng = random.Random(11)

    def text() -> str:
        pool = [f"w{k}" for k in range(rng.choice([1, 2, 4, 30]))] + ["Été", "\x85x"]
        return "".join(rng.choice(pool) + rng.choice([" ", "\n", "  ", "\t", "\r\n", "\x0b"]) for _ in range(rng.randrange(120)))

    made = [k for k in range(10_000) if zlib.crc32(str(k).encode()) % 10 == 0][:60]
    rows = [(k, text()) for k in [*range(120), *made]] + [(-5, "a b " * 40), (777, None), (778, ""), (779, " \n"), (780, "x"),
                                                        (781, "a " * 11), (782, "a " * 12), (None, "b c d " * 9)]
    documents(*rows, rows[0]).withColumn("runs", F.lit("mine")).write.parquet(str(tmp_path / "documents.parquet"))
    got = queries.QUERIES["op11_periodic_runs"](spark, str(tmp_path))
    assert dict(got.dtypes) == {
        "doc_id": "bigint", "n_runs": "bigint", "start": "bigint", "length": "bigint", "period": "bigint",
        "exponent_milli": "bigint", "runs_sha256": "string", "collapsed_sha256": "string"}
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(
        repr((k, *expected(k, t))) for k, t in [*rows, rows[0]])


def test_operator_texts_and_spans(documents):
    row = P.runs_of(documents((1, "x y " + "a b c " * 5 + "z"))).first()
    assert [tuple(r) for r in row["runs"]] == [(2, 15, 3)] and row["collapsed"] == "x y a b c z" and row["n_words"] == 18
    assert P.runs_of(documents((1, "a")).where("doc_id > 1")).count() == 0


def test_long_text(documents):
    text = " ".join(f"w{k % 700}" for k in range(60_000))
    row = P.runs_of(documents((1, text))).first()
    assert [tuple(r) for r in row["runs"]] == [(0, 60_000, 700)]
