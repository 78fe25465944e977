"""Secrets by patterns and by a battery of randomness tests with length-aware false-discovery control.

Base kinds are patterns: ``assign`` (a secret-like name, a separator, a value
of 8 characters or more), ``access`` (AKIA keys of 16 or more) and ``hex``
(runs of 32 or more).

The battery looks at every run of 16 or more characters of the encodings
hexadecimal, base32 and base64 (the smallest alphabet that holds the run) and
asks whether it could be uniform noise: a chi-squared test of the symbol
counts, a runs test about the middle of the alphabet, and a serial-correlation
test at lag one. Fisher's method joins the three p-values. For noise the
joined value is uniform, for words and identifiers it piles up near 0. So per
encoding and length class the corpus-wide histogram of the joined values of
different runs tells how many are noise (from the upper half) and which limit keeps the share of
false discoveries at or below ``rate``; short runs, on which the tests have
little power, get a strict limit this way. A class with too little noise for
that takes how high words reach from the classes around it, so that every
class has a limit, of 0.5 at most, and a lone secret can be found. Runs at or
above the limit of their class are spans of kind ``noise``, unless a base span
touches them.

Runs of fewer than 20 digits are numbers, not hexadecimal; a key of 16
hexadecimal characters has no letter in 1 of 1,800 cases.

Positions are code points, ends are exclusive. A null text is an empty text.
"""

from __future__ import annotations

import hashlib
import math
import re

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockpond.llm.common import map_rows
from stockpond.session import stage

#: The base patterns.
ASSIGN = re.compile(
    r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
_LONG_HEX = re.compile(r"[0-9a-f]{32,}")  # the runs of HEX that are long enough
KINDS = ("assign", "access", "hex", "noise")

#: Alphabets in the order of their encodings, smallest first.
ALPHABETS = {
    "hex": "0123456789abcdef",
    "base32": "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
    "base64": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/",
}
SHORTEST = 16
_NUMBER = re.compile(r"[0-9]{1,19}")
#: So many runs of noise in the upper half tell a limit by themselves; so many words tell how high words reach.
NOISE, WORDS = 5, 100
_RUN = re.compile(rf"[A-Za-z0-9+/_-]{{{SHORTEST},}}")
_BINS = 50


def _symbols() -> dict[str, np.ndarray]:
    found = {}
    for name, letters in ALPHABETS.items():
        codes = np.full(128, -1, np.int16)
        for number, letter in enumerate(letters):
            codes[ord(letter)] = number
        if name == "hex":
            codes[[ord(c) for c in "ABCDEF"]] = range(10, 16)
        if name == "base64":
            codes[[ord("-"), ord("_")]] = 62, 63  # the alphabet for URLs
        found[name] = codes
    return found


_CODES = _symbols()
_PURE = {"hex": (re.compile(r"[0-9a-f]+|[0-9A-F]+"), 16), "base32": (re.compile(r"[A-Z2-7]+"), 32)}


def encoding_of(run: str) -> str:
    """The smallest alphabet that holds the run."""
    return next((name for name, (pattern, _) in _PURE.items() if pattern.fullmatch(run)), "base64")


def _two_sided(z: float) -> float:
    return math.erfc(abs(z) / math.sqrt(2))


def randomness(run: str) -> tuple[str, float]:
    """(encoding, joined p-value) of a run; 1 is as good as noise gets, 0 is surely none."""
    name = encoding_of(run)
    symbols = _CODES[name][np.frombuffer(run.encode("ascii"), np.uint8)]
    size, n = len(ALPHABETS[name]), len(symbols)
    expected = n / size
    counts = np.bincount(symbols, minlength=size)
    chi = float(((counts - expected) ** 2).sum() / expected)
    free = size - 1
    # Wilson and Hilferty: the cube root of chi-squared over its freedom is close to normal.
    uniform = 0.5 * math.erfc(((chi / free) ** (1 / 3) - (1 - 2 / (9 * free))) / math.sqrt(2 / (9 * free)) / math.sqrt(2))
    high = symbols >= size // 2
    above = int(high.sum())
    below = n - above
    if above and below:
        mean = 2 * above * below / n + 1
        spread = math.sqrt(max((mean - 1) * (mean - 2) / (n - 1), 1e-9))
        runs = _two_sided((1 + int((high[1:] != high[:-1]).sum()) - mean) / spread)
    else:
        runs = 2.0 ** (1 - n)
    centred = symbols - symbols.mean()
    power = float((centred * centred).sum())
    serial = _two_sided((float((centred[1:] * centred[:-1]).sum()) / power + 1 / n) * math.sqrt(n)) if power else 0.0
    half = -sum(math.log(max(p, 1e-300)) for p in (uniform, runs, serial))  # Fisher's sum is twice this
    return name, math.exp(-half) * (1 + half + half * half / 2)


def length_class(n: int) -> int:
    """Classes grow by a quarter: tests on longer runs tell more."""
    return math.floor(math.log(n / 20) / math.log(1.25) + 1e-9)


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the base matches, each kind left to right without overlaps."""
    found = [(*m.span(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    found += [(*m.span(), "access") for m in ACCESS.finditer(text) if len(m[0]) >= 16]
    found += [(*m.span(), "hex") for m in _LONG_HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def _written(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


def scan(docs: DataFrame) -> DataFrame:
    """(doc_id, base, runs): base spans, and all runs with a hash, encoding, length class, joined p-value and whether no base span touches them."""
    kind = dict(docs.dtypes)["doc_id"]

    def make():
        def step(rows: dict[str, list]) -> dict[str, list]:
            out: dict[str, list] = {"doc_id": rows["doc_id"], "base": [], "runs": []}
            for text in rows["text"]:
                text = text or ""
                base = base_spans(text)
                runs = []
                for m in _RUN.finditer(text):
                    start, end = m.span()
                    if _NUMBER.fullmatch(m[0]):
                        continue
                    name, p = randomness(m[0])
                    key = xxhash.xxh64_intdigest(m[0]) - (1 << 63)
                    runs.append({"start": start, "end": end, "key": key, "enc": name, "len_class": length_class(end - start), "p": p,
                                 "free": not any(a < end and start < b for a, b, _ in base)})
                out["base"].append([{"start": a, "end": b, "kind": k} for a, b, k in base])
                out["runs"].append(runs)
            return out

        return step

    return map_rows(
        docs.select("doc_id", "text"), make,
        f"doc_id {kind}, base array<struct<start: bigint, end: bigint, kind: string>>, "
        "runs array<struct<start: bigint, end: bigint, key: bigint, enc: string, len_class: int, p: double, free: boolean>>",
    )


def _upper(bins: np.ndarray) -> float:
    return float(bins[_BINS // 2:].sum())


def _words(bins: np.ndarray) -> float:
    """How many runs are not noise, which has as many below one half as above."""
    return max(0.0, float(bins.sum()) - 2 * _upper(bins))


def _kept_and_true(bins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs at or above the lower edge of each bin, and how many of them are noise."""
    return np.cumsum(bins[::-1])[::-1], _upper(bins) / (_BINS - _BINS // 2) * np.arange(_BINS, 0, -1)


def _pooled(histograms: dict[tuple[str, int], np.ndarray], enc: str, len_class: int) -> np.ndarray:
    """The histogram of a class with its neighbours in length, then of all encodings, until it holds enough words."""
    widest = max(abs(c - len_class) for _, c in histograms)
    pool = histograms[enc, len_class]
    for alike in (True, False):
        for reach in range(widest + 1):
            pool = sum(bins for (e, c), bins in histograms.items() if abs(c - len_class) <= reach and (e == enc or not alike))
            if _words(pool) >= WORDS:
                return pool
    return pool


def cuts(histograms: dict[tuple[str, int], np.ndarray], rate: float) -> dict[tuple[str, int], float]:
    """The limit of each class, from the histograms of all."""
    found = {}
    for (enc, len_class), bins in histograms.items():
        kept, true = _kept_and_true(bins)
        if _upper(bins) >= NOISE:
            # What exceeds noise by more than two standard deviations of its count is taken for false discoveries.
            share = np.maximum(0, kept - true - 2 * np.sqrt(true)) / np.maximum(kept, 1)
        else:
            # Too few to count noise: all runs of the class may be words, and words reach as high as they do in the pool.
            pool = _pooled(histograms, enc, len_class)
            pool_kept, pool_true = _kept_and_true(pool)
            tail = np.minimum(1, np.maximum(0, pool_kept - pool_true) / max(1.0, _words(pool)))
            share = bins.sum() * tail / np.maximum(kept, 1)
        good = share <= rate
        good[0] = False  # words pile up there
        good[_BINS // 2:] = True  # the upper half is noise
        found[enc, len_class] = int(good.argmax()) / _BINS  # the lowest limit that keeps the rate
    return found


def limits(scanned: DataFrame, rate: float = 0.05) -> dict[tuple[str, int], float]:
    """The joined p-value from which on a run counts as noise, by encoding and length class.

    The histogram has at most ``_BINS`` bins for each of three encodings and
    each length class (log in the length), so it is small for any corpus.
    """
    place = F.least(F.floor(F.col("r.p") * _BINS), F.lit(_BINS - 1)).alias("bin")
    runs = scanned.select(F.explode("runs").alias("r")).select("r.enc", "r.len_class", "r.key", place).distinct()
    counted = runs.groupBy("enc", "len_class", "bin").count()  # copies of a run tell nothing new
    histograms: dict[tuple[str, int], np.ndarray] = {}
    for row in counted.collect():
        histograms.setdefault((row["enc"], row["len_class"]), np.zeros(_BINS))[row["bin"]] = row["count"]
    return cuts(histograms, rate)


def secrets(docs: DataFrame, rate: float = 0.05) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, n_noise, base_sha256, spans) of every row of ``docs``."""
    scanned = stage(scan(docs), "secret-scan")  # spans and runs only, not the texts
    cut = limits(scanned, rate)
    kind = dict(docs.dtypes)["doc_id"]

    def make():
        def step(rows: dict[str, list]) -> dict[str, list]:
            out: dict[str, list] = {"doc_id": rows["doc_id"]}
            out |= {c: [] for c in ("n_assign", "n_access", "n_hex", "n_noise", "base_sha256", "spans")}
            for base, runs in zip(rows["base"], rows["runs"], strict=True):
                spans = [(b["start"], b["end"], b["kind"]) for b in base]
                noise = [(r["start"], r["end"], "noise") for r in runs
                         if r["free"] and r["p"] >= cut.get((r["enc"], r["len_class"]), 2)]
                for name in ("assign", "access", "hex"):
                    out[f"n_{name}"].append(sum(k == name for _, _, k in spans))
                out["n_noise"].append(len(noise))
                out["base_sha256"].append(hashlib.sha256(_written(spans).encode()).hexdigest())
                out["spans"].append(_written(sorted(spans + noise, key=lambda s: (s[0], KINDS.index(s[2])))))
            return out

        return step

    return map_rows(scanned, make, f"doc_id {kind}, n_assign bigint, n_access bigint, n_hex bigint, n_noise bigint, "
                                   "base_sha256 string, spans string")
