"""A hidden Markov language model: Baum-Welch over all training texts, scaled forward recursion over whole texts.

Texts are lower-cased (A-Z) and cut at blanks; each ends with one ``end``
token. The unigram base gives a token the probability
``(c + 0.5) / (N + 0.5 * (V + 1))`` from its count in the training texts.

The hidden Markov model emits *symbols*: the ``head`` most frequent training
tokens are symbols of their own, all others share ``tails`` symbols by a hash
of their last three letters. A token of a shared symbol is then drawn with its
unigram probability within the symbol. So the probability of a text is that of
its symbols under the model times, for each token, the base probability of the
token over that of its symbol, and rare tokens keep their own counts.

Baum-Welch runs over pieces of ``chunk`` tokens of the training texts; each
task sums the expected counts of its pieces and the sums are added by Spark.
Scoring runs the forward recursion over whole texts of any length, rescaled at
each step; texts of a slice advance together.

The ``hot`` most frequent tokens are looked up in a table of that size,
which all executors get. The other words of a text are joined to their counts
through a shuffle; none of them has more than ``1 / hot`` of the training
tokens, so no token gathers many rows in a task.

Null and empty texts are just the end token. Without training texts all counts
are 0, N and V too.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockpond.llm.common import BLANKS, map_rows
from stockpond.session import stage

END = " "  # no word holds a blank
_COUNTED_AT_ONCE = 500_000
_PLAIN = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ" + BLANKS.encode(), b"abcdefghijklmnopqrstuvwxyz" + b" " * len(BLANKS))


def tokens(text: str | None) -> list[str]:
    """Words between ASCII blanks, A-Z lower-cased, and the end."""
    # In UTF-8 these bytes stand for nothing else.
    plain = (text or "").encode("utf-8", "surrogatepass").translate(_PLAIN).decode("utf-8", "surrogatepass")
    return [w for w in plain.split(" ") if w] + [END]


def _vocabulary(texts: DataFrame) -> DataFrame:
    """(word, c): how often each token occurs; each task adds up its own texts before anything is shuffled."""

    def count(batches):
        counts: Counter = Counter()

        def rows():
            out = pa.RecordBatch.from_pydict({"word": pa.array(list(counts), pa.string()),
                                              "n": pa.array(list(counts.values()), pa.int64())})
            counts.clear()
            return out

        for batch in batches:
            for text in batch.column(0):
                counts.update(tokens(text.as_py()))
                if len(counts) > _COUNTED_AT_ONCE:
                    yield rows()
        if counts:
            yield rows()

    return texts.select("text").mapInArrow(count, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("c"))


def _tail(word: str, tails: int) -> int:
    return zlib.crc32(word[-3:].encode("utf-8", "surrogatepass")) % tails


class _Symbols(dict):
    """The symbol of each token asked for so far."""

    def __init__(self, own: dict[str, int], tails: int):
        super().__init__()
        self.own, self.tails = own, tails

    def __reduce__(self):  # sent without its entries
        return _Symbols, (self.own, self.tails)

    def __missing__(self, word: str) -> int:
        symbol = self.own.get(word)
        if symbol is None:
            symbol = len(self.own) + _tail(word, self.tails)
        self[word] = symbol
        return symbol


class _Coder:
    """Symbols of tokens, and base sums of the tokens in a table of frequent ones; other words are handed back."""

    def __init__(self, frequent: list[tuple[str, int]], head: int, tails: int, norm: float):
        self.own = {word: number for number, (word, _) in enumerate(frequent[:head])}
        self.logs = {word: (math.log10((c + 0.5) / norm), c > 0) for word, c in frequent}
        self.tails = tails
        self.size = len(self.own) + tails
        self.seen = _Symbols(self.own, tails)

    def symbols(self, words: list[str]) -> list[int]:
        if len(self.seen) > 300_000:
            self.seen.clear()
        return list(map(self.seen.__getitem__, words))

    def base(self, words: list[str]) -> tuple[int, float, list[str], list[int]]:
        """(known tokens, their log10 probability, rare words, how often each)"""
        known, total, rare, often = 0, 0.0, [], []
        for word, n in Counter(words).items():
            if (log := self.logs.get(word)) is None:
                rare.append(word)
                often.append(n)
            else:
                known += n
                total += n * log[0]
        return known, total, rare, often


def expected_counts(chunks: np.ndarray, start: np.ndarray, move: np.ndarray, emit: np.ndarray) -> tuple:
    """Expected starts, moves and emissions of symbol sequences of one length (a row each)."""
    rows, size = chunks.shape
    seen = emit.T[chunks.T]  # (time, row, state)
    forward = np.empty_like(seen)
    scale = np.empty((size, rows, 1), seen.dtype)
    now = start * seen[0]
    for t in range(size):
        if t:
            now = (forward[t - 1] @ move) * seen[t]
        scale[t] = now.sum(axis=1, keepdims=True)
        forward[t] = now / scale[t]
    moves = np.zeros_like(move)
    back = np.ones((rows, len(start)), seen.dtype)
    held = np.empty_like(seen)
    held[-1] = forward[-1]
    for t in range(size - 2, -1, -1):
        weight = seen[t + 1] * back / scale[t + 1]
        moves += move * (forward[t].T @ weight)
        back = weight @ move.T
        held[t] = forward[t] * back
    flat = chunks.T.ravel()
    states = held.reshape(-1, len(start))
    emissions = np.stack([np.bincount(flat, weights=states[:, k], minlength=emit.shape[1]) for k in range(len(start))])
    return held[0].sum(axis=0), moves, emissions


def forward_logs(texts: list[list[int]], start: np.ndarray, move: np.ndarray, emit: np.ndarray) -> np.ndarray:
    """log10 probability of each symbol sequence: the scaled forward recursion, longest texts first in a batch."""
    lengths = np.array([len(t) for t in texts], np.int64)
    order = np.argsort(-lengths, kind="stable")
    size = lengths[order]
    flat = np.fromiter((s for k in order for s in texts[k]), np.int64, int(lengths.sum()))
    begins = np.cumsum(size) - size
    live = np.searchsorted(-size, -np.arange(size[0]), side="left")
    by_symbol = np.ascontiguousarray(emit.T)
    total = np.zeros(len(texts))
    now = np.repeat(start[None, :], len(texts), axis=0)
    for t in range(size[0]):
        n = live[t]
        step = (now[:n] @ move if t else now[:n]) * by_symbol[flat[begins[:n] + t]]
        scale = step.sum(axis=1)
        now[:n] = step / scale[:, None]
        total[:n] += np.log10(scale)
    out = np.empty(len(texts))
    out[order] = total
    return out


def _normal(counts: np.ndarray, prior: float) -> np.ndarray:
    counts = counts + prior
    return counts / counts.sum(axis=-1, keepdims=True)


def train(symbols: DataFrame, size: int, states: int, iterations: int, chunk: int, unigram: np.ndarray) -> tuple:
    """Baum-Welch over ``symbols`` (array<int> ``s``); returns start, move and emission probabilities."""
    noise = np.random.default_rng(7)
    start = np.full(states, 1 / states)
    move = np.full((states, states), 0.04 / max(1, states - 1))
    np.fill_diagonal(move, 0.96)
    move = _normal(move, 0)
    emit = _normal(unigram[None, :] * noise.uniform(0.5, 1.5, (states, size)), 1e-12)
    context = symbols.sparkSession.sparkContext
    for _ in range(iterations):
        shared = context.broadcast((start, move, emit))

        def sums(batches, shared=shared):
            start, move, emit = (x.astype(np.float32) for x in shared.value)
            total = [np.zeros(states), np.zeros((states, states)), np.zeros((states, size))]
            waiting: dict[int, list[np.ndarray]] = {}

            def use(length: int) -> None:
                for kept, new in zip(total, expected_counts(np.stack(waiting.pop(length)), start, move, emit), strict=True):
                    kept += new

            for batch in batches:
                column = batch.column(0)
                values, ends = column.flatten().to_numpy(), column.offsets.to_numpy()
                ends = ends - ends[0]
                for a, b in zip(ends[:-1], ends[1:], strict=True):
                    for first in range(a, b, chunk):
                        piece = values[first: min(first + chunk, b)]
                        waiting.setdefault(len(piece), []).append(piece)
                        if len(waiting[len(piece)]) * len(piece) >= 1 << 16:
                            use(len(piece))
            for length in list(waiting):
                use(length)
            flat = np.concatenate([total[0], total[1].ravel(), total[2].ravel()])
            yield pa.RecordBatch.from_pydict({"at": np.arange(len(flat), dtype=np.int32), "v": flat})

        # One row per parameter from each task, added up by Spark; the driver gets one row per parameter.
        added = symbols.mapInArrow(sums, "at int, v double").groupBy("at").agg(F.sum("v").alias("v")).toPandas()
        flat = np.zeros(states + states * states + states * size)
        flat[added["at"]] = added["v"]
        start = _normal(flat[:states], 0.1)
        move = _normal(flat[states: states + states * states].reshape(states, states), 0.1)
        emit = _normal(flat[states + states * states:].reshape(states, size), 0.01)
        shared.unpersist()
    return start, move, emit


def score(
    docs: DataFrame, training, states: int = 6, head: int = 2000, tails: int = 64, iterations: int = 4,
    chunk: int = 64, hot: int = 65536,
) -> DataFrame:
    """(doc_id, n_tokens, n_known, train_tokens, base_score, score) of every row; ``training`` is a condition on ``docs``."""
    spark, kind = docs.sparkSession, dict(docs.dtypes)["doc_id"]
    given = docs.select("doc_id", F.coalesce(training, F.lit(False)).alias("train"), "text")
    counts = stage(_vocabulary(given.where("train")), "vocabulary")
    n, v = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    norm = n + 0.5 * (v + 1)

    # 1. Symbols and their unigram probabilities; what is left over belongs to unseen tokens.
    first = [(r["word"], r["c"]) for r in counts.orderBy(F.desc("c"), "word").limit(max(head, hot)).collect()]
    coder = _Coder(first, head, tails, norm)
    own = np.array([c for _, c in first[:head]], float)
    tail_of = F.pmod(F.crc32(F.expr("right(word, 3)").cast("binary")), F.lit(tails)).cast("int")
    top = spark.createDataFrame([(word,) for word, _ in first[:head]], "word string")
    shared = counts.join(F.broadcast(top), "word", "left_anti").groupBy(tail_of.alias("tail")).agg(
        F.sum("c").alias("c"), F.count(F.lit(1)).alias("types")).collect()
    tail = np.full(tails, 0.5 / tails)
    for r in shared:
        tail[r["tail"]] += r["c"] + 0.5 * r["types"]
    unigram = np.concatenate([own + 0.5, tail]) / norm
    logs = np.log10(unigram)

    # 2. Each text once more: its symbols, the base sums of its frequent words, and its other words.
    box = spark.sparkContext.broadcast(coder)

    def code():
        made = box.value

        def step(rows: dict[str, list]) -> dict[str, list]:
            out: dict[str, list] = {"doc_id": rows["doc_id"], "train": rows["train"]}
            cut = [tokens(text) for text in rows["text"]]
            out["s"] = [made.symbols(words) for words in cut]
            out["n"] = list(map(len, cut))
            sums = [made.base(words) for words in cut]
            for name, values in zip(("known", "base", "rare", "often"), zip(*sums, strict=True), strict=True):
                out[name] = list(values)
            return out

        return step

    rows = map_rows(given, code, f"doc_id {kind}, train boolean, s array<int>, n int, known int, base double, "
                    "rare array<string>, often array<int>", rows=128)
    # The number that keeps rows of one doc_id apart is drawn once, and written with its text's symbols.
    coded = stage(rows.withColumn("row", F.monotonically_increasing_id()), "symbols")

    # 3. Counts of the other words come by a join; none of them has a large share of the training tokens.
    rest = coded.select("row", F.inline(F.arrays_zip("rare", "often")))
    log = F.log10((F.coalesce("c", F.lit(0)) + 0.5) / F.lit(norm))
    added = rest.join(counts.withColumnRenamed("word", "rare"), "rare", "left").groupBy("row").agg(
        F.sum(F.when(F.col("c") > 0, F.col("often")).otherwise(0)).alias("rare_known"),
        F.sum(F.col("often") * log).alias("rare_base"))

    # 4. The model, and its score of whole texts.
    model = train(coded.where("train").select("s"), coder.size, states, iterations, chunk, unigram)
    sent = spark.sparkContext.broadcast((*model, logs))

    def lifted(batches):
        start, move, emit, logs = sent.value
        for pdf in batches:
            for first in range(0, len(pdf), 1024):
                part = pdf.iloc[first: first + 1024]
                texts = [np.asarray(s) for s in part["s"]]
                gain = forward_logs(texts, start, move, emit) - np.array([logs[s].sum() for s in texts])
                yield part.drop(columns="s").assign(gain=gain)

    gains = coded.select("row", "doc_id", "n", "known", "base", "s").mapInPandas(
        lifted, f"row bigint, doc_id {kind}, n int, known int, base double, gain double")
    base = F.col("base") + F.coalesce("rare_base", F.lit(0.0))
    return gains.join(added, "row", "left").select(
        "doc_id", F.col("n").cast("bigint").alias("n_tokens"),
        (F.col("known") + F.coalesce("rare_known", F.lit(0))).cast("bigint").alias("n_known"),
        F.lit(int(n)).cast("bigint").alias("train_tokens"), base.alias("base_score"), (base + F.col("gain")).alias("score"))
