"""Character n-grams of cleaned texts as numpy hashes."""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np

#: Characters that one pass over a text holds; its arrays fit the processor's cache.
PASS_CHARS = 1 << 15
_MIX = np.uint64(0x9E3779B97F4A7C15)


@functools.lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Code point -> its lower-case letter, or a blank."""
    out = np.full(0x110000, 32, dtype=np.uint32)
    for c in range(0x110000):
        ch = chr(c)
        if ch.isalpha():
            low = ch.lower()
            out[c] = ord(low) if len(low) == 1 else c
    return out


def clean(text: str) -> np.ndarray:
    """Lower-case letters with single blanks between and around words; empty without a letter."""
    raw = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    c = np.empty(len(raw) + 2, dtype=np.uint64)
    c[0] = c[-1] = 32
    c[1:-1] = _letters()[raw]
    blank = c == 32
    c = c[np.concatenate([[True], ~(blank[1:] & blank[:-1])])]
    return c if len(c) > 1 else c[:0]


def ngrams(c: np.ndarray, least: int, most: int) -> Iterator[np.ndarray]:
    """64-bit hashes of all n-grams, an array per size; the hash of an n-gram extends that of its first n - 1."""
    h = c
    for n in range(2, most + 1):
        if len(c) < n:
            return
        h = (h[:-1] ^ c[n - 1:]) * _MIX
        h ^= h >> np.uint64(29)
        if n >= least:
            yield h


def passes(text: str, overlap: int = 0) -> Iterator[str]:
    """The whole text, a part at a time; each part but the first repeats ``overlap`` characters."""
    for i in range(0, len(text), PASS_CHARS):
        yield text[max(0, i - overlap):i + PASS_CHARS]
