"""Quality rules against a plain version, and their cases at the edges."""

from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from stockpond.llm import quality_rules as Q

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text: str | None) -> dict[str, int]:
    text = text or ""
    words = WORD.findall(text)
    lines = [line for line in text.split("\n") if WORD.search(line)]
    windows = [tuple(words[i: i + 3]) for i in range(len(words) - 2)]
    inside = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)}
    bare = [re.sub(r"[.,;:!?\"'()]", "", w.lower()) for w in words]
    blank = " \t\n\x0b\f\r"
    return {
        "n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": sum(text.count(c) for c in "#*$%&|<>"),
        "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(inside),
        "n_letter_words": sum(any(c.isalpha() for c in w) for w in words),
        "n_stop_words": sum(w in Q.STOP_WORDS for w in bare), "n_lines": len(lines),
        "n_bullet_lines": sum(line.strip(blank)[0] in Q.BULLETS for line in lines),
        "n_open_lines": sum(line.strip(blank).endswith(Q.ELLIPSES) for line in lines),
    }


def random_text(rng: random.Random) -> str:
    pool = ["the", "The,", "und", "a", "b", "c#", "**", "été", "-", "1.", "wait...", "end…", " x", "\U0001f600", "<p>"]
    blanks = [" ", "  ", "\n", "\t", "\n\n", " \r\n", "\x0b", "\x85", "\f"]
    return "".join(rng.choice(pool) + rng.choice(blanks) for _ in range(rng.randrange(60)))


def test_measures_against_plain_version(documents):
    rng = random.Random(5)
    texts = [None, "", " \n\t ", "one", "one two", "a b c", "a b c a b c", "x " * 2000, "a\nb\na\n\n a \nb",
             "- one\n* two\n -three\nfour...\nfive… \nsix...x", *[random_text(rng) for _ in range(120)]]
    found = {r["doc_id"]: r for r in Q.measure(documents(*enumerate(texts))).collect()}
    for k, text in enumerate(texts):
        want = plain(text)
        assert {c: found[k][c] for c in Q.MEASURES} == want, text


def test_rules_decide(documents):
    good = " ".join(f"the word{k} of line{k}" for k in range(20))
    bad = {
        2: " ".join(f"w{k}" for k in range(49)),                                  # base: short
        3: "the cat of war " * 20,                                                # base: repeated windows
        4: " ".join(f"the word{k}### of" for k in range(20)),                     # symbols
        5: " ".join(f"the {k}{k} {k}-{k}" for k in range(30)),                    # letters
        6: " ".join(f"word{k} other{k}" for k in range(30)),                      # stop words
        7: "\n".join(f"- w{k} the x{k} of" for k in range(30)),                    # bullets
        8: "\n".join(f"the word{k} of..." for k in range(30)),                    # open lines
        9: " ".join(f"the {'x' * 40}{k}" for k in range(30)),                     # word length
        10: "",
    }
    rows = {r["doc_id"]: r for r in Q.rate(documents((1, good), *bad.items())).collect()}
    assert rows[1]["kept"] and rows[1]["failed_rules"] == [] and not rows[1]["base_failed"]
    assert not any(rows[k]["kept"] for k in bad)
    assert [k for k in bad if rows[k]["base_failed"]] == [2, 3, 10]
    names = {4: "symbols", 5: "letters", 6: "stop_words", 7: "bullet_lines", 8: "open_lines", 9: "word_length"}
    assert {k: rows[k]["failed_rules"] for k in names} == {k: [v] for k, v in names.items()}


@pytest.mark.parametrize("low, high, kept", [(10, None, True), (11, None, False), (None, 10, True), (None, 9, False)])
def test_bounds_are_inclusive(documents, low, high, kept):
    text = " ".join([f"the w{k}" for k in range(45)] + [f"#{k}" for k in range(10)])  # 100 words, 10 symbols
    one = Q.rate(documents((1, text)), [Q.Rule("symbols", "n_symbols", "n_words", 100, low, high)]).first()
    assert one["kept"] is kept


def test_no_rules_and_empty_table(documents):
    assert Q.rate(documents((1, "a b")), []).first()["failed_rules"] == []
    assert Q.rate(documents((1, "a")).where("doc_id > 1")).count() == 0


def test_repeated_rows_nulls_and_clashing_names(documents):
    good = " ".join(f"the word{k} of line{k}" for k in range(20))
    docs = documents((1, good), (1, good), (None, good), (2, None)).withColumns(
        {"n_words": F.lit("x"), "kept": F.lit("y"), "_text": F.lit("z"), "_row": F.lit(1), "odd name.x": F.lit(2)})
    kept = Q.keep_good(docs)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] or 0, r["n_words"], r["kept"], r["odd name.x"]) for r in kept.collect()) == [
        (0, "x", "y", 2), (1, "x", "y", 2), (1, "x", "y", 2)]


def test_native_plan(spark, plan_of):
    docs = spark.range(9).select(F.col("id").alias("doc_id"), F.col("id").cast("string").alias("text"))
    text = plan_of(Q.rate(docs))
    assert "Python" not in text and "Arrow" not in text and "Exchange" not in text


def test_long_text(documents):
    text = " ".join(f"the word{k % 5000} of" for k in range(100_000))
    one = Q.rate(documents((1, text))).first()
    assert one["n_words"] == 300_000 and one["n_repeat_words"] == 300_000 and one["base_failed"]
