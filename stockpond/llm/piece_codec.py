"""Sentencepiece encoding and decoding with a Viterbi pass over many words at once.

The distinct words of a slice of rows are grouped by length; words of one
length advance together. For each end position and piece length, rolling
hashes of all substrings are looked up in the sorted hashes of the pieces by
one binary search, the candidates are compared by vectorised maxima, and the
best start is stored as the backpointer. Candidates are taken from the longest
to the shortest and replace only worse ones: the tokenizer's rule for ties.

A hash can only name a piece that could be there; every encoded word is
decoded again, and a word that does not come back is encoded by comparing the
pieces themselves. Null texts have null ids, empty texts no ids; decoding
null gives null. Texts of any length are encoded whole.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
from pyspark.sql import DataFrame

from stockpond.llm.common import map_rows, mix64
from stockpond.llm.pieces import BYTE, CONTROL, DEFAULT_MODEL, UNKNOWN, Vocabulary

_BASE = np.uint64(0x9E3779B97F4A7C15)


class PieceCodec:
    def __init__(self, vocabulary: Vocabulary, remember: int = 200_000):
        self.vocabulary = vocabulary
        self.remember = remember
        self.seen: dict[str, np.ndarray] = {}
        by_length = defaultdict(list)
        for piece, number in vocabulary.matched.items():
            by_length[len(piece)].append((piece, number))
        #: Per length: sorted hashes, ids in that order, scores in that order.
        self.tables: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        for length, pairs in by_length.items():
            keys = self._hash(self._points([p for p, _ in pairs], length))
            order = np.argsort(keys)
            ids = np.array([n for _, n in pairs])[order]
            self.tables[length] = keys[order], ids, np.array(vocabulary.scores)[ids]
        self.lengths = sorted(self.tables, reverse=True)
        self.text_of = [
            b"" if kind == CONTROL else bytes([int(piece[3:5], 16)]) if kind == BYTE
            else " ⁇ ".encode() if kind == UNKNOWN else piece.encode("utf-8")
            for piece, kind in zip(vocabulary.pieces, vocabulary.kinds, strict=True)
        ]

    @staticmethod
    def _points(words: list[str], length: int) -> np.ndarray:
        data = "".join(words).encode("utf-32-le", "surrogatepass")
        return np.frombuffer(data, np.uint32).reshape(len(words), length).astype(np.uint64)

    @staticmethod
    def _hash(points: np.ndarray) -> np.ndarray:
        value = np.zeros(len(points), np.uint64)
        for column in points.T:
            value = value * _BASE + mix64(column + np.uint64(1))
        return value

    def encode_words(self, words: list[str]) -> list[np.ndarray]:
        """Piece ids of each word; all words have the same length."""
        size = len(words[0])
        points = self._points(words, size)
        letters = mix64(points + np.uint64(1))
        prefix = np.zeros((size + 1, len(words)), np.uint64)
        for end in range(size):
            prefix[end + 1] = prefix[end] * _BASE + letters[:, end]
        power = {length: np.uint64(pow(int(_BASE), length, 1 << 64)) for length in self.lengths}
        best = np.full((size + 1, len(words)), -np.inf)
        best[0] = 0.0
        start = np.zeros((size + 1, len(words)), np.int32)
        piece = np.full((size + 1, len(words)), -1, np.int32)
        for end in range(1, size + 1):
            known = np.zeros(len(words), bool)
            for length in self.lengths:
                if length > end:
                    continue
                keys, ids, scores = self.tables[length]
                code = prefix[end] - prefix[end - length] * power[length]
                at = np.minimum(np.searchsorted(keys, code), len(keys) - 1)
                hit = keys[at] == code
                if length == 1:
                    known = hit
                total = np.where(hit, scores[at] + best[end - length], -np.inf)
                better = total > best[end]
                best[end][better] = total[better]
                start[end][better] = end - length
                piece[end][better] = ids[at[better]]
            total = np.where(known, -np.inf, self.vocabulary.unknown_score + best[end - 1])
            better = total > best[end]
            best[end][better] = total[better]
            start[end][better] = end - 1
            piece[end][better] = -1
        return self._paths(words, points, start, piece)

    def _paths(self, words: list[str], points: np.ndarray, start: np.ndarray, piece: np.ndarray) -> list[np.ndarray]:
        """Follow all backpointers together; unknown characters become bytes where the vocabulary has them."""
        size = len(words[0])
        at = np.full(len(words), size)
        row = np.arange(len(words))
        taken = np.full((size, len(words)), -2, np.int64)  # by start position
        while (live := row[at[row] > 0]).size:
            end = at[live]
            begin = start[end, live]
            taken[begin, live] = piece[end, live]
            at[live] = begin
            row = live
        out = []
        plain = (taken != -1).all(axis=0)
        for k, word in enumerate(words):
            ids = taken[:, k]
            if plain[k]:
                out.append(ids[ids >= 0].astype(np.int32))
            else:
                spelled: list[int] = []
                for place, one in enumerate(ids.tolist()):
                    if one >= 0:
                        spelled.append(one)
                    elif one == -1:
                        raw = word[place].encode("utf-8", "surrogatepass")
                        spelled += ([self.vocabulary.bytes_of[b] for b in raw] if self.vocabulary.bytes_of
                                    else [self.vocabulary.unknown_id])
                out.append(np.array(spelled, np.int32))
        return out

    def _by_comparison(self, word: str) -> np.ndarray:
        """The same rule with the pieces compared as text."""
        best, came = [0.0] + [-np.inf] * len(word), [(0, -1)] * (len(word) + 1)
        pieces, scores = self.vocabulary.matched, self.vocabulary.scores
        for end in range(1, len(word) + 1):
            options = [(b, pieces[word[b:end]]) for b in range(max(0, end - self.lengths[0]), end) if word[b:end] in pieces]
            rated = [(scores[n] + best[b], b, n) for b, n in options]
            if not options or options[-1][0] != end - 1:
                rated.append((self.vocabulary.unknown_score + best[end - 1], end - 1, -1))
            for score, b, n in rated:
                if score > best[end]:
                    best[end], came[end] = score, (b, n)
        path, end = [], len(word)
        while end:
            b, n = came[end]
            raw = word[b:end].encode("utf-8", "surrogatepass")
            path[:0] = [n] if n >= 0 else (
                [self.vocabulary.bytes_of[x] for x in raw] if self.vocabulary.bytes_of else [self.vocabulary.unknown_id])
            end = b
        return np.array(path, np.int32)

    def learn(self, words: set[str], cells: int = 1 << 21) -> None:
        """Encode words not seen yet, in blocks of words of one length."""
        groups = defaultdict(list)
        for word in words:
            groups[len(word)].append(word)
        for length, group in groups.items():
            block = max(1, cells // (length + 1))
            for first in range(0, len(group), block):
                part = group[first: first + block]
                for word, ids in zip(part, self.encode_words(part), strict=True):
                    same = b"".join([self.text_of[i] for i in ids.tolist()]) == word.encode("utf-8", "surrogatepass")
                    self.seen[word] = ids if same or not self.vocabulary.bytes_of else self._by_comparison(word)

    def encode(self, texts: list[str | None]) -> list[np.ndarray | None]:
        if len(self.seen) > self.remember:
            self.seen.clear()
        cut = [self.vocabulary.words.findall(self.vocabulary.escape(text)) for text in texts]
        self.learn({w for words in cut for w in words if w not in self.seen})
        none = np.zeros(0, np.int32)
        return [
            None if text is None else np.concatenate([self.seen[w] for w in words]) if words else none
            for text, words in zip(texts, cut, strict=True)
        ]

    def decode(self, ids: list[int] | np.ndarray | None) -> str | None:
        """Bytes that are no UTF-8 become the replacement character."""
        if ids is None:
            return None
        raw = b"".join([self.text_of[i] for i in (ids.tolist() if isinstance(ids, np.ndarray) else ids)])
        try:
            text = raw.decode("utf-8", "surrogatepass")
        except UnicodeDecodeError:
            text = raw.decode("utf-8", "replace")
        return self.vocabulary.unescape(text)


def encode(docs: DataFrame, model: str = DEFAULT_MODEL, check: bool = False) -> DataFrame:
    """``docs`` with ``piece_ids`` of each text, and with ``check`` whether decoding gives the text back (``round_trip``).

    A text that holds ``▁`` itself, or starts with a space after the dummy one
    was left out, is the only kind that need not come back.
    """
    columns = [c for c in docs.columns if c not in ("piece_ids", "round_trip")]
    shared = docs.sparkSession.sparkContext.broadcast(Vocabulary.load(model))

    def make():
        codec = PieceCodec(shared.value)

        def step(rows: dict[str, list]) -> dict[str, list]:
            out = {c: rows[c] for c in columns} | {"piece_ids": codec.encode(rows["text"])}
            if check:
                out["round_trip"] = [codec.decode(i) == t for i, t in zip(out["piece_ids"], rows["text"], strict=True)]
            return out

        return step

    ddl = docs.select(*columns).schema.toDDL() + ", piece_ids array<int>" + ", round_trip boolean" * check
    return map_rows(docs.select(*columns), make, ddl)


def decode(encoded: DataFrame, model: str = DEFAULT_MODEL) -> DataFrame:
    """The rows of ``encoded`` with ``decoded``, the text of ``piece_ids``."""
    columns = [c for c in encoded.columns if c != "decoded"]
    shared = encoded.sparkSession.sparkContext.broadcast(Vocabulary.load(model))

    def make():
        codec = PieceCodec(shared.value)
        return lambda rows: {c: rows[c] for c in columns} | {"decoded": [codec.decode(i) for i in rows["piece_ids"]]}

    return map_rows(encoded.select(*columns), make, encoded.select(*columns).schema.toDDL() + ", decoded string")
