"""Quality rules: a table of thresholds compiled into one projection of built-in functions.

A rule bounds the ratio of two measures of a text. ``compile_rules`` turns a
table of rules into one boolean column per rule, so a run over any table is a
single pass without a shuffle, a join or a user function. Ratios are compared
as products of whole numbers: no rounding decides about a document.

Words are maximal runs of characters other than ``[\\x20\\x09-\\x0D]``, lines are
cut at ``\\n`` and count if they hold a word. ``n_repeat_words`` counts the
words in windows of three words that occur twice or more in the text, the first
occurrence included. Windows are compared by 64-bit hashes within one text,
sorted together with their places, so a text of n words costs n log n, however
often one window repeats; texts without a repeated window skip the sort.

Null texts count as empty, rows without ``doc_id`` and repeated rows are rated
like any other. A rule whose whole is 0 holds. Columns of the given table stay
out of the projection (only ``doc_id`` and the text are read), so their names
cannot clash with those of the measures.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockpond.llm.common import BLANKS

SYMBOLS = "#*$%&|<>"
PUNCTUATION = ".,;:!?\"'()"
BULLETS = ("-", "*", "•", "–")
ELLIPSES = ("...", "…")

#: Frequent function words of the languages that the rules know.
STOP_WORDS = (
    "the", "of", "and", "to", "in", "is", "it", "that", "for", "was", "with", "as", "be", "by", "this", "are", "from",
    "der", "die", "das", "und", "ist", "den", "von", "zu", "mit", "sich", "auf", "nicht", "ein", "eine", "dem",
    "le", "la", "les", "de", "et", "des", "est", "en", "un", "une", "du", "que", "dans", "qui", "pour", "sur",
    "el", "los", "las", "y", "que", "un", "una", "por", "con", "para", "del", "se", "no", "su", "lo",
)


@dataclass(frozen=True)
class Rule:
    """``low <= scale * part / whole <= high``; a missing bound does not bind."""

    name: str
    part: str
    whole: str
    scale: int = 100
    low: int | None = None
    high: int | None = None


#: Words below 50 and repetition above half are the base; these are the method's own thresholds.
RULES = (
    Rule("word_length", "word_chars", "n_words", 10, low=20, high=150),
    Rule("symbols", "n_symbols", "n_words", 100, high=10),
    Rule("letters", "n_letter_words", "n_words", 100, low=60),
    Rule("stop_words", "n_stop_words", "n_words", 1000, low=20),
    Rule("bullet_lines", "n_bullet_lines", "n_lines", 100, high=90),
    Rule("open_lines", "n_open_lines", "n_lines", 100, high=30),
    Rule("repeated_lines", "n_dup_lines", "n_lines", 100, high=50),
)

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_letter_words", "n_stop_words",
            "n_lines", "n_bullet_lines", "n_open_lines")


_BLANK = r"\x20\x09-\x0D"


def _any_of(characters: Sequence[str]) -> str:
    """A pattern for one of the characters."""
    return "[" + "".join("\\" + c for c in characters) + "]"


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once, although ``use`` mentions it often."""
    return F.transform(F.array(value), use)[0]


def _words(text: Column) -> Column:
    for blank in BLANKS[1:]:
        text = F.replace(text, F.lit(blank), F.lit(" "))
    return F.array_remove(F.split(text, " "), "")


def _windows(words: Column, width: int) -> Column:
    """The hash of each window of ``width`` words, in order."""
    count = F.greatest(F.size(words) - (width - 1), F.lit(0))
    return F.transform(F.slice(words, 1, count), lambda w, i: F.xxhash64(w, *[F.get(words, i + k) for k in range(1, width)]))


def _repeated_words(hashes: Column, width: int) -> Column:
    """How many words lie in windows whose hash occurs twice or more."""

    def same(window: Column, other: Column) -> Column:
        return F.coalesce(window["h"] == other["h"], F.lit(False))

    def covered(starts: Column) -> Column:
        following = F.concat(F.slice(starts, 2, F.size(starts)), F.array(F.element_at(starts, -1) + width))
        steps = F.zip_with(starts, following, lambda a, b: F.least(b - a, F.lit(width)))
        return F.aggregate(steps, F.lit(0), lambda total, step: total + step)

    places = F.sequence(F.lit(0), F.size(hashes) - 1)
    ordered = F.sort_array(F.arrays_zip(hashes.alias("h"), places.alias("p")))
    twice = _let(ordered, lambda s: F.filter(
        s, lambda w, i: same(w, F.get(s, i - 1)) | same(w, F.get(s, i + 1))))
    starts = F.sort_array(F.transform(twice, lambda w: w["p"]))
    repeats = F.size(F.array_distinct(hashes)) < F.size(hashes)
    return F.when(repeats, _let(starts, covered)).otherwise(F.lit(0))


def measure(docs: DataFrame, text: str = "text", stop_words: Sequence[str] = STOP_WORDS) -> DataFrame:
    """(doc_id, the ``MEASURES``) of every row, as bigint."""
    given = docs.select("doc_id", F.coalesce(F.col(text), F.lit("")).alias("_text"))
    # Three steps, so that words, lines and windows are made once and used often.
    cut = given.select("doc_id", "_text", _words(F.col("_text")).alias("_words"),
                       F.filter(F.split("_text", "\n"), lambda line: line.rlike(f"[^{_BLANK}]")).alias("_lines"))
    hashed = cut.select("doc_id", "_text", "_words", "_lines", _windows(F.col("_words"), 3).alias("_windows"))

    bare = _words(F.lower(F.regexp_replace("_text", _any_of(PUNCTUATION), "")))
    ends = "|".join(e.replace(".", r"\.") for e in ELLIPSES)
    measures = {
        "n_words": F.size("_words"),
        "word_chars": F.length(F.array_join("_words", "")),
        "n_symbols": F.regexp_count("_text", F.lit(_any_of(SYMBOLS))),
        "n_dup_lines": F.size("_lines") - F.size(F.array_distinct("_lines")),
        "n_repeat_words": _repeated_words(F.col("_windows"), 3),
        "n_letter_words": F.size(F.filter("_words", lambda w: w.rlike(r"\p{L}"))),
        "n_stop_words": F.size(F.filter(bare, lambda w: w.isin(*dict.fromkeys(stop_words)))),
        "n_lines": F.size("_lines"),
        "n_bullet_lines": F.size(F.filter("_lines", lambda line: line.rlike(f"^[{_BLANK}]*{_any_of(BULLETS)}"))),
        "n_open_lines": F.size(F.filter("_lines", lambda line: line.rlike(f"({ends})[{_BLANK}]*\\z"))),
    }
    return hashed.select("doc_id", *[measures[name].cast("bigint").alias(name) for name in MEASURES])


def compile_rules(rules: Sequence[Rule]) -> dict[str, Column]:
    """A condition for each rule, true where the measures keep it."""
    compiled = {}
    for rule in rules:
        part, whole = F.col(rule.part) * rule.scale, F.col(rule.whole)
        held = F.lit(True)
        if rule.low is not None:
            held = held & (part >= whole * rule.low)
        if rule.high is not None:
            held = held & (part <= whole * rule.high)
        compiled[rule.name] = held | (whole == 0)
    return compiled


def base_failed() -> Column:
    """Fewer than 50 words, or more than half of the words in repeated windows."""
    return (F.col("n_words") < 50) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50)


def rate(docs: DataFrame, rules: Sequence[Rule] = RULES, text: str = "text") -> DataFrame:
    """(doc_id, the measures, base_failed, failed_rules, kept): the names of the rules that each document breaks."""
    compiled = compile_rules(rules)
    broken = F.array_compact(F.array(*[F.when(~held, F.lit(name)) for name, held in compiled.items()]))
    return measure(docs, text).select(
        "doc_id", *MEASURES, base_failed().alias("base_failed"),
        (broken if compiled else F.array().cast("array<string>")).alias("failed_rules"),
    ).withColumn("kept", ~F.col("base_failed") & (F.size("failed_rules") == 0))


def keep_good(docs: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """The rows of ``docs`` that break no rule, with all their columns as they are."""
    packed = docs.select("doc_id", "text", F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))
    # Rated in place: no join, so rows that share a doc_id are judged one by one.
    rated = rate(packed.select(F.struct("doc_id", "_row").alias("doc_id"), "text"), rules)
    return rated.where("kept").select("doc_id._row.*")
