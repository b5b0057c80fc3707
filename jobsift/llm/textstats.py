"""Counts over one text's UTF-8 bytes, shared by the quality operators and language identification.

Words are runs of anything but the six ASCII white-space bytes, which is what
``bytes.split()`` gives; whole texts are read.
"""

from __future__ import annotations

from operator import eq

import numpy as np

SYMBOLS = np.frombuffer(b"#*$%&|<>", np.uint8)
SPACE = np.frombuffer(b"\x20\x09\x0a\x0b\x0c\x0d", np.uint8)
UPPER, LOWER = slice(65, 91), slice(97, 123)


def repeat_words(words: list[bytes], window: int = 5) -> int:
    """Words covered by a window of words that occurs twice or more, its first occurrence included."""
    n = len(words)
    if n <= window:
        return 0
    index: dict[bytes, int] = {}
    ids = np.array([index.setdefault(w, len(index)) for w in words], np.int64)
    v = len(index)
    if v == n:
        return 0
    code, bound = ids[:n - window + 1], v
    for k in range(1, window):
        if bound > (1 << 62) // v:  # number the prefixes anew before the code would overflow
            code = np.unique(code, return_inverse=True)[1]
            bound = len(code)
        code = code * v + ids[k:n - window + 1 + k]
        bound *= v
    _, inverse, count = np.unique(code, return_inverse=True, return_counts=True)
    twice = np.flatnonzero(count[inverse] > 1)
    edge = np.zeros(n + 1, np.int64)
    edge[twice] += 1
    edge[twice + window] -= 1
    return int((np.cumsum(edge[:-1]) > 0).sum())


class Counts:
    """Byte histogram, words and lines of a text (null: empty)."""

    def __init__(self, raw: bytes | None):
        raw = raw or b""
        self.words = raw.split()
        self.n = len(self.words)
        self.hist = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
        self.lines = [x for x in raw.split(b"\n") if x.strip()]
        self.code_points = int(self.hist.sum() - self.hist[0x80:0xC0].sum())
        self.word_chars = self.code_points - int(self.hist[SPACE].sum())
        self.symbols = int(self.hist[SYMBOLS].sum())
        self.dup_lines = len(self.lines) - len(set(self.lines))

    def upper_share(self) -> float:
        up, low = int(self.hist[UPPER].sum()), int(self.hist[LOWER].sum())
        return up / max(up + low, 1)

    def per_word(self, what: int | np.ndarray) -> float:
        return float(np.sum(self.hist[what])) / max(self.n, 1)

    def distinct_share(self) -> float:
        return len(set(self.words)) / max(self.n, 1)

    def adjacent_share(self) -> float:
        """Words equal to the word before them."""
        return sum(map(eq, self.words, self.words[1:])) / max(self.n - 1, 1)


def hashed_grams(raw: bytes, dim: int, order: int = 3) -> np.ndarray:
    """Counts of byte n-grams hashed to ``dim`` (a power of two) places."""
    a = np.frombuffer(raw, np.uint8).astype(np.uint32)
    if len(a) < order:
        return np.zeros(dim)
    h = np.zeros(len(a) - order + 1, np.uint32)
    for k in range(order):
        h *= np.uint32(0x01000193)
        h ^= a[k:len(a) - order + 1 + k] * np.uint32(0x9E3779B1)
    h ^= h >> np.uint32(15)
    return np.bincount(h & np.uint32(dim - 1), minlength=dim).astype(np.float64)
