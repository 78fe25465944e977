"""The vocabulary of a sentencepiece model file: pieces, scores and the rules for text around them.

Only the pieces and scores are taken. Texts are segmented as a unigram model
over them: the best sum of scores wins. The rules are those of the public
tokenizer: spaces become ``▁``, a dummy ``▁`` goes first if the model says so,
a character that no piece of its own covers costs ``min score - 10`` and is
written as its UTF-8 bytes where the model has byte pieces. Among equal sums
the piece that starts first wins, as candidates replace a path only if they
are strictly better. Sums are exact here; the tokenizer adds in single
precision, so its own choice can differ where sums pass 2**24.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from functools import cached_property

SPACE = "▁"
DEFAULT_MODEL = "/opt/tokenizers/piece_bpe_32k.model"
#: Kinds of pieces in the model file.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNKNOWN_PENALTY = 10.0


def _fields(data: bytes):
    """(number, value) of each field of a protocol buffer message."""
    at = 0

    def number() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        key = number()
        if key & 7 == 0:
            yield key >> 3, number()
        else:
            size = {1: 8, 5: 4}.get(key & 7) or number()
            yield key >> 3, data[at: at + size]
            at += size


@dataclass(frozen=True)
class Vocabulary:
    pieces: list[str]
    scores: list[float]
    kinds: list[int]
    dummy_prefix: bool = True
    squeeze_spaces: bool = False
    byte_fallback: bool = True
    _marks: dict = field(default_factory=dict, compare=False)

    @classmethod
    def load(cls, path: str = DEFAULT_MODEL) -> Vocabulary:
        """Read a model file on the driver; executors get the vocabulary, not the path."""
        import struct

        pieces, scores, kinds, rules, trainer = [], [], [], {}, {}
        with open(path, "rb") as file:
            for number, value in _fields(file.read()):
                if number == 1:
                    one = dict(_fields(value))
                    pieces.append(one[1].decode("utf-8"))
                    scores.append(struct.unpack("<f", one.get(2, b"\0\0\0\0"))[0])
                    kinds.append(one.get(3, NORMAL))
                elif number == 2:
                    trainer = dict(_fields(value))
                elif number == 3:
                    rules = dict(_fields(value))
        if rules.get(2):
            raise ValueError("this vocabulary normalises characters by a table, which is not supported")
        return cls(pieces, scores, kinds, bool(rules.get(3, 1)), bool(rules.get(4, 1)), bool(trainer.get(35, 0)))

    @cached_property
    def matched(self) -> dict[str, int]:
        """Pieces that can match text, with their ids."""
        return {p: i for i, (p, k) in enumerate(zip(self.pieces, self.kinds, strict=True)) if k == NORMAL}

    @cached_property
    def unknown_score(self) -> float:
        return min(s for s, k in zip(self.scores, self.kinds, strict=True) if k == NORMAL) - UNKNOWN_PENALTY

    @cached_property
    def unknown_id(self) -> int:
        return self.kinds.index(UNKNOWN)

    @cached_property
    def bytes_of(self) -> list[int] | None:
        """The piece ids of the 256 bytes."""
        ids = {p: i for i, (p, k) in enumerate(zip(self.pieces, self.kinds, strict=True)) if k == BYTE}
        return [ids[f"<0x{b:02X}>"] for b in range(256)] if self.byte_fallback and len(ids) == 256 else None

    @cached_property
    def longest(self) -> int:
        return max(map(len, self.matched))

    @cached_property
    def words(self) -> re.Pattern:
        """Cuts escaped text into words no piece reaches across.

        If every piece has its ``▁`` at the front, texts are cut before each run
        of ``▁``; characters of no piece (mostly line ends) are words of their
        own. Otherwise a text is one word.
        """
        if any(SPACE in p.lstrip(SPACE) for p in self.matched):
            return re.compile(r"(?s).+")
        if any("\n" in p for p in self.matched):
            return re.compile(rf"(?s){SPACE}*[^{SPACE}]+|{SPACE}+")
        return re.compile(rf"\n|{SPACE}*[^{SPACE}\n]+|{SPACE}+")

    def escape(self, text: str | None) -> str:
        """Text as the pieces see it. Null and empty texts have no pieces."""
        if not text:
            return ""
        if self.squeeze_spaces:
            text = re.sub(" +", " ", text).strip(" ")
            if not text:
                return ""
        return SPACE * self.dummy_prefix + text.replace(" ", SPACE)

    def unescape(self, text: str) -> str:
        """The text of decoded pieces: ``▁`` is a space again, the dummy one goes."""
        text = text.replace(SPACE, " ")
        return text[1:] if self.dummy_prefix and text.startswith(" ") else text
