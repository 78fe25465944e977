"""Token counts without tokens: Aho-Corasick matches and a Viterbi pass that carries score and count only.

An automaton over the vocabulary lists, for each end position of a word, the
pieces that end there. The pass keeps the best score and its number of pieces
per position; no path is stored. Each task counts a word once and keeps a
bounded table of the words it has seen.

Null and empty texts have no tokens. Nothing is sampled or cut: texts of any
length are counted word by word.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from stockpond.llm.common import map_rows
from stockpond.llm.pieces import DEFAULT_MODEL, Vocabulary


class PieceCounter:
    """Counts the pieces of the best segmentation of a word."""

    def __init__(self, vocabulary: Vocabulary, remember: int = 300_000):
        import ahocorasick

        self.vocabulary = vocabulary
        self.matches = ahocorasick.Automaton()
        for piece, number in vocabulary.matched.items():
            self.matches.add_word(piece, (len(piece), vocabulary.scores[number]))
        self.matches.make_automaton()
        self.remember = remember
        self.seen: dict[str, tuple[int, float]] = {}

    def word(self, word: str) -> tuple[int, float]:
        """(pieces, score) of the best path; of equal paths the one whose last piece starts first.

        That is the tokenizer's rule: candidates reach a position in the order
        of their start and replace only worse ones.
        """
        found: list[list[tuple[int, float]]] = [[] for _ in word]
        for end, match in self.matches.iter(word):
            found[end].append(match)
        unknown = self.vocabulary.unknown_score
        spelled = self.vocabulary.bytes_of is not None
        best, count = [0.0] * (len(word) + 1), [0] * (len(word) + 1)
        for end, matches in enumerate(found, 1):
            top = start = None
            known = False  # a piece of just this character
            for length, score in sorted(matches, reverse=True):
                known |= length == 1
                score += best[end - length]
                if top is None or score > top:
                    top, start = score, end - length
            size = 1
            if not known:
                score = unknown + best[end - 1]
                if top is None or score > top:
                    top, start = score, end - 1
                    size = len(word[end - 1].encode("utf-8", "surrogatepass")) if spelled else 1
            best[end], count[end] = top, count[start] + size
        return count[-1], best[-1]

    def text(self, text: str | None) -> tuple[int, int, float]:
        """(pieces, words, score) of a whole text."""
        if len(self.seen) > self.remember:
            self.seen.clear()
        pieces = words = 0
        total = 0.0
        seen = self.seen
        for word in self.vocabulary.words.findall(self.vocabulary.escape(text)):
            if (one := seen.get(word)) is None:
                one = self.word(word)
                if len(word) <= 64:
                    seen[word] = one
            pieces += one[0]
            words += 1
            total += one[1]
        return pieces, words, total


def count_tokens(docs: DataFrame, model: str = DEFAULT_MODEL) -> DataFrame:
    """``docs`` with ``n_tokens``, ``n_words`` and ``path_score`` of each text; columns of these names are replaced."""
    added = ("n_tokens", "n_words", "path_score")
    columns = [c for c in docs.columns if c not in added]
    shared = docs.sparkSession.sparkContext.broadcast(Vocabulary.load(model))

    def make():
        counter = PieceCounter(shared.value)

        def step(rows: dict[str, list]) -> dict[str, list]:
            counted = [counter.text(text) for text in rows["text"]]
            return {c: rows[c] for c in columns} | {c: [one[k] for one in counted] for k, c in enumerate(added)}

        return step

    ddl = docs.select(*columns).schema.toDDL() + ", n_tokens bigint, n_words bigint, path_score double"
    return map_rows(docs.select(*columns), make, ddl)
