"""Language spans of mixed texts: script ranges, per-word scores, Viterbi with a switching penalty.

Fitting counts character trigrams of words per language over a bounded, stated
sample of labelled texts (``per_lang`` different texts of each language, chosen
by a hash of the text; copies count once). The model is a table of log10 probabilities of hashed trigrams
and, per language, the scripts its letters come from; its size is fixed by
``buckets`` and the number of languages.

Prediction works on whole texts. The scripts of a word name its candidate
languages, the trigrams score them, and a Viterbi pass over the words of a
text, paying ``penalty`` for each change of language, labels spans. A text
gets the language that covers most of its letters (ties: the smaller name);
its score is that share of the letters. Texts that are null or hold no letter
get ``und`` and 0, and so does everything if nothing was learned.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stockpond.llm.common import map_rows, mix64, ranges

UNKNOWN = "und"

#: Code point ranges of scripts (first, last, script).
SCRIPTS = (
    (0x0041, 0x024F, "latin"), (0x0250, 0x02FF, "latin"), (0x0370, 0x03FF, "greek"), (0x0400, 0x052F, "cyrillic"),
    (0x0530, 0x058F, "armenian"), (0x0590, 0x05FF, "hebrew"), (0x0600, 0x077F, "arabic"), (0x0900, 0x097F, "devanagari"),
    (0x0980, 0x09FF, "bengali"), (0x0A00, 0x0A7F, "gurmukhi"), (0x0A80, 0x0AFF, "gujarati"), (0x0B80, 0x0BFF, "tamil"),
    (0x0C00, 0x0C7F, "telugu"), (0x0C80, 0x0CFF, "kannada"), (0x0D00, 0x0D7F, "malayalam"), (0x0E00, 0x0E7F, "thai"),
    (0x10A0, 0x10FF, "georgian"), (0x1100, 0x11FF, "hangul"), (0x1200, 0x137F, "ethiopic"), (0x1E00, 0x1EFF, "latin"),
    (0x1F00, 0x1FFF, "greek"), (0x3040, 0x309F, "hiragana"), (0x30A0, 0x30FF, "katakana"), (0x3400, 0x9FFF, "han"),
    (0xAC00, 0xD7AF, "hangul"), (0x20000, 0x2FA1F, "han"),
)
_FIRST = np.array([a for a, _, _ in SCRIPTS])
_LAST = np.array([b for _, b, _ in SCRIPTS])
_NAMES = sorted({name for _, _, name in SCRIPTS}) + ["other"]
_NUMBER = np.array([_NAMES.index(name) for _, _, name in SCRIPTS])

#: Words are runs of letters; digits and marks belong to no language.
WORD = re.compile(r"[^\W\d_]+")


def scripts_of(points: np.ndarray) -> np.ndarray:
    """The number of the script of each code point."""
    at = np.clip(np.searchsorted(_FIRST, points, side="right") - 1, 0, None)
    inside = (points >= _FIRST[at]) & (points <= _LAST[at])
    return np.where(inside, _NUMBER[at], len(_NAMES) - 1)


def _trigrams(words: list[str], buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hashed trigrams of ``^word$`` in a row, their number per word, all code points, their number per word."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    points = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    room = lengths + 2  # one mark on each side
    padded = np.ones(int(room.sum()), np.uint64)
    padded[np.repeat(np.cumsum(room) - room + 1, lengths) + ranges(lengths)] = points
    start = np.repeat(np.cumsum(room) - room, lengths) + ranges(lengths)
    code = (padded[start] << np.uint64(42)) ^ (padded[start + 1] << np.uint64(21)) ^ padded[start + 2]
    return (mix64(code) % np.uint64(buckets)).astype(np.int64), lengths, points.astype(np.int64), lengths


@dataclass(frozen=True)
class LanguageModel:
    langs: list[str]
    logs: np.ndarray  # (buckets, languages): log10 probability of a trigram
    scripts: np.ndarray  # (scripts, languages): whether a language is a candidate for words of the script

    def word_scores(self, words: list[str]) -> np.ndarray:
        """(words, languages); the candidates of a word come from the script of most of its letters."""
        grams, counts, points, lengths = _trigrams(words, len(self.logs))
        starts = np.cumsum(counts) - counts
        scores = np.add.reduceat(self.logs[grams], starts, axis=0)
        script = scripts_of(points)
        word = np.repeat(np.arange(len(words)), lengths)
        most = np.bincount(word * len(_NAMES) + script, minlength=len(words) * len(_NAMES))
        most = most.reshape(len(words), -1).argmax(axis=1)
        allowed = self.scripts[most]
        return np.where(allowed | ~allowed.any(axis=1, keepdims=True), scores, scores - 100.0)


def sample(docs: DataFrame, per_lang: int) -> DataFrame:
    """(text, lang): ``per_lang`` different texts of each language, or all if there are fewer."""
    labelled = docs.select("text", "lang").where(F.col("text").isNotNull() & F.col("lang").isNotNull())
    hashed = labelled.select("lang", F.xxhash64("text").alias("hash"))
    sizes = hashed.distinct().groupBy("lang").agg(F.count(F.lit(1)).alias("size"))
    # Hashes below the cut leave about twice the texts of the sample, so no language gathers its texts in one task.
    # That is more than ``per_lang`` by many deviations, as every different text has a draw of its own.
    draw = F.pmod(F.xxhash64("text"), F.lit(1 << 40))
    pick = Window.partitionBy("lang").orderBy("draw", "text")
    return (
        labelled.withColumn("draw", draw).join(F.broadcast(sizes), "lang")  # a row per language
        .where(F.col("draw") < F.greatest(F.lit(2 * per_lang), F.lit(64)) / F.col("size") * (1 << 40))
        .select("lang", "draw", "text").distinct()
        .withColumn("pick", F.row_number().over(pick)).where(F.col("pick") <= per_lang).select("text", "lang")
    )


def fit(docs: DataFrame, per_lang: int = 2000, buckets: int = 1 << 16) -> LanguageModel:
    """Learn from ``text`` and non-null ``lang``, from at most ``per_lang`` different texts of each language."""

    def make():
        def step(rows: dict[str, list]) -> dict[str, list]:
            out: dict[str, list] = {"lang": [], "kind": [], "item": [], "n": []}
            for lang in sorted(set(rows["lang"])):
                texts = (t for t, name in zip(rows["text"], rows["lang"], strict=True) if name == lang)
                words = WORD.findall(" ".join(texts).lower())
                if not words:
                    continue
                grams, _, points, _ = _trigrams(words, buckets)
                for kind, values in (("gram", grams), ("script", scripts_of(points))):
                    items, counts = np.unique(values, return_counts=True)
                    out["lang"] += [lang] * len(items)
                    out["kind"] += [kind] * len(items)
                    out["item"] += items.tolist()
                    out["n"] += counts.tolist()
            return out

        return step

    counted = map_rows(sample(docs, per_lang), make, "lang string, kind string, item bigint, n bigint")
    rows = counted.groupBy("lang", "kind", "item").agg(F.sum("n").alias("n")).collect()  # (buckets + scripts) x languages
    langs = sorted({r["lang"] for r in rows})
    grams = np.zeros((buckets, len(langs)))
    letters = np.zeros((len(_NAMES), len(langs)))
    for r in rows:
        (grams if r["kind"] == "gram" else letters)[r["item"], langs.index(r["lang"])] = r["n"]
    totals = grams.sum(axis=0, keepdims=True)
    used = max(1, int((grams.sum(axis=1) > 0).sum()))
    logs = np.log10((grams + 0.1) / (totals + 0.1 * used + 1e-9)).astype(np.float32)
    return LanguageModel(langs, logs, letters >= 0.001 * np.maximum(1, letters.sum(axis=0, keepdims=True)))


def viterbi(scores: np.ndarray, lengths: np.ndarray, penalty: float) -> np.ndarray:
    """Best label of each word of many texts: ``scores`` of all words in a row, ``lengths`` words per text.

    Texts advance together, longest first, so that each step is a few array
    operations over those that still have words. Ties go to the smaller label
    and to staying in it.
    """
    order = np.argsort(-lengths, kind="stable")
    size = lengths[order]
    starts = (np.cumsum(lengths) - lengths)[order]
    labels = np.zeros(len(scores), np.int32)
    if not len(scores):
        return labels
    came = np.zeros(scores.shape, np.int8 if scores.shape[1] < 128 else np.int32)
    best = np.zeros((len(order), scores.shape[1]), np.float64)
    own = np.arange(scores.shape[1])
    live = np.searchsorted(-size, -np.arange(size[0]), side="left")  # texts with more than t words
    for t in range(size[0]):
        n = live[t]
        at = starts[:n] + t
        if t:
            top = best[:n].argmax(axis=1)
            change = best[np.arange(n), top] - penalty
            stays = best[:n] >= change[:, None]
            came[at] = np.where(stays, own, top[:, None])
            best[:n] = np.where(stays, best[:n], change[:, None])
        best[:n] += scores[at]
    last = best.argmax(axis=1)
    for t in range(size[0] - 1, -1, -1):
        n = live[t]
        at = starts[:n] + t
        labels[at] = last[:n]
        if t:
            last[:n] = came[at, last[:n]]
    return labels


def predict(docs: DataFrame, model: LanguageModel, penalty: float = 4.0, spans: bool = False) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``, and with ``spans`` the labelled spans.

    Columns of ``docs`` with these names are replaced. A span is (lang, start,
    end) in code points, from the first letter of its first word to the end of
    its last.
    """
    added = ["lang_pred", "score"] + ["lang_spans"] * spans
    columns = [c for c in docs.columns if c not in added]
    ddl = ", ".join(filter(None, [docs.select(*columns).schema.toDDL(), "lang_pred string, score double",
                                  "lang_spans array<struct<lang: string, start: int, end: int>>" * spans]))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        held = shared.value
        langs = held.langs
        known: dict[str, int] = {}
        table = np.zeros((0, len(langs)), np.float32)

        def step(rows: dict[str, list]) -> dict[str, list]:
            nonlocal known, table
            if len(known) > 200_000:
                known, table = {}, table[:0]
            words = [WORD.findall(text.lower()) if text and langs else [] for text in rows["text"]]
            fresh = [w for w in {w for one in words for w in one} if w not in known]
            if fresh:
                for w in fresh:
                    known[w] = len(known)
                table = np.concatenate([table, held.word_scores(fresh)])
            lengths = np.array([len(one) for one in words], np.int64)
            at = np.fromiter((known[w] for one in words for w in one), np.int64, int(lengths.sum()))
            labels = viterbi(table[at], lengths, penalty)
            letters = np.fromiter((len(w) for one in words for w in one), np.int64, len(at))
            text = np.repeat(np.arange(len(words)), lengths)
            width = max(1, len(langs))
            share = np.bincount(text * width + labels, weights=letters, minlength=len(words) * width).reshape(-1, width)
            total = share.sum(axis=1)
            top = share.argmax(axis=1)
            out = {c: rows[c] for c in columns}
            out["lang_pred"] = [langs[k] if n else UNKNOWN for k, n in zip(top, total, strict=True)]
            out["score"] = (share.max(axis=1) / np.maximum(total, 1)).tolist()
            if spans:
                ends = np.cumsum(lengths)
                out["lang_spans"] = [
                    _spans(t, labels[e - n: e], langs) if n else []
                    for t, e, n in zip(rows["text"], ends, lengths, strict=True)
                ]
            return out

        return step

    return map_rows(docs.select(*columns), make, ddl, rows=256)


def _spans(text: str, labels: np.ndarray, langs: list[str]) -> list[dict]:
    """Positions are those of the text as given; where lower-casing changes its words, spans are left to the whole text."""
    found = list(WORD.finditer(text))
    if len(found) != len(labels):
        return [{"lang": langs[int(np.bincount(labels).argmax())], "start": 0, "end": len(text)}]
    out: list[dict] = []
    for m, k in zip(found, labels, strict=True):
        if out and out[-1]["lang"] == langs[k]:
            out[-1]["end"] = m.end()
        else:
            out.append({"lang": langs[k], "start": m.start(), "end": m.end()})
    return out


def fold_of(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds
