"""Tokenizer files inside Python tasks: one loaded tokenizer and one word memo per worker process."""

from __future__ import annotations

import functools
import os
import re
import sys
from array import array

#: Unicode White_Space as the tokenizer's normaliser sees it (fixed values).
WHITE_SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_WORD = re.compile(f"[^{WHITE_SPACE}]+")
#: Characters that str.split() cuts at although they are no White_Space (fixed values).
_EXTRA_CUT = re.compile("[\x1c-\x1f]")


@functools.lru_cache(maxsize=4)
def load_json_tokenizer(path: str):
    """A tokenizers file; its own threads are off, Spark runs a task per core."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(path)
    tok.no_truncation()
    tok.no_padding()
    return tok


def words(text: str) -> list[str]:
    return _WORD.findall(text) if _EXTRA_CUT.search(text) else text.split()


if sys.byteorder != "little" or array("I").itemsize != 4:  # ids travel as such bytes
    raise ImportError("a little-endian machine with 32-bit ints is needed")


class WordIds(dict):
    """Ids of texts through a memo of words, for tokenizers that cut at white space and drop it.

    Such a tokenizer encodes each word by itself, so a text's ids are its
    words' ids in order. A word of Latin letters with one ending mark is its
    lower-case letters, then the mark; letters go straight to the tokenizer's
    model. Both hold for tokenizers that fold case and part letters from
    marks, which is tried out on loading; others encode every word in full.
    The memo only saves work: it holds ``limit`` words at most and starts anew
    when full, and results never depend on it.
    """

    _MARKS = ".,;:!?"

    def __init__(self, path: str, limit: int = 600_000):
        super().__init__()
        self.tok, self.limit = load_json_tokenizer(path), limit
        self.model = self.tok.model
        letters = [chr(c) for c in range(256) if chr(c).isalpha()]
        split = self.tok.pre_tokenizer.pre_tokenize_str if self.tok.pre_tokenizer else (lambda s: [(s, None)])
        self.bytes = {ord(c): split(c)[0][0] for c in letters}
        tried = [*letters, "Walk", "straße", "Élan", "naïve", "señor", "isn", "the"]
        self.plain = all(self._whole(w + m) == self._letters(w.lower()) + (self._whole(m) if m else b"")
                         for w in tried for m in ["", *self._MARKS])

    def _whole(self, word: str) -> bytes:
        return array("I", self.tok.encode(word, add_special_tokens=False).ids).tobytes()

    def _letters(self, word: str) -> bytes:
        return array("I", [t.id for t in self.model.tokenize(word.translate(self.bytes))]).tobytes()

    def __missing__(self, word: str) -> bytes:
        core, mark = (word[:-1], word[-1]) if len(word) > 1 and word[-1] in self._MARKS else (word, "")
        low = core.lower()
        if not (self.plain and low.isalpha() and (low.isascii() or max(low) < "\u0100")):
            ids = self._whole(word)
        elif mark or low != core:
            ids = self[low] + (self[mark] if mark else b"")
        else:
            ids = self._letters(low)
        self[word] = ids
        return ids

    def encode(self, texts: list[str]) -> list[bytes]:
        """Each text's ids as little-endian unsigned 32-bit numbers."""
        if len(self) > self.limit:
            self.clear()
        return [b"".join(map(self.__getitem__, words(t))) for t in texts]


@functools.lru_cache(maxsize=4)
def word_ids(path: str) -> WordIds:
    return WordIds(path)
