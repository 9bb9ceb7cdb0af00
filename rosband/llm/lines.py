"""Normalised lines, shared by the line-based operators."""

from __future__ import annotations

import re

import xxhash

_DIGITS = re.compile(rb"[0-9]+")


def line_words(line: str) -> list[bytes]:
    """The words of a line, lower-cased (Unicode), runs of digits as one 0."""
    data = line.lower().encode("utf-8", "surrogatepass")
    return _DIGITS.sub(b"0", data).split()


def line_hash(words: list[bytes]) -> int:
    """Signed 64-bit hash of a normalised line: its words joined by single spaces."""
    h = xxhash.xxh64_intdigest(b" ".join(words), 0)
    return h - (1 << 64) if h >> 63 else h
