"""The public tokenizer over the same pieces, as a unigram model."""

from __future__ import annotations

from stockpond.llm.pieces import DEFAULT_MODEL, _fields


def _number(value: int) -> bytes:
    out = b""
    while value > 127:
        out += bytes([value & 127 | 128])
        value >>= 7
    return out + bytes([value])


def unigram_model(path: str = DEFAULT_MODEL) -> bytes:
    """The model file with the model type of its trainer settings set to unigram."""
    out = b""
    for number, value in _fields(open(path, "rb").read()):
        if number == 2:
            value += b"\x18\x01"  # the last value of a field counts
        out += _number(number << 3 | 2) + _number(len(value)) + value
    return out
