"""Words of letters as arrays of code points, without a loop over characters."""

from __future__ import annotations

import unicodedata
from functools import lru_cache

import numpy as np

#: First code points of writing systems (each up to the next entry), for the choice of languages.
SCRIPTS = (
    (0x0000, "latin"),
    (0x0370, "greek"),
    (0x0400, "cyrillic"),
    (0x0530, "armenian"),
    (0x0590, "hebrew"),
    (0x0600, "arabic"),
    (0x0900, "devanagari"),
    (0x0980, "bengali"),
    (0x0B80, "tamil"),
    (0x0E00, "thai"),
    (0x0E80, "other"),
    (0x10A0, "georgian"),
    (0x1100, "hangul"),
    (0x1200, "other"),
    (0x1E00, "latin"),
    (0x1F00, "greek"),
    (0x2000, "other"),
    (0x3040, "kana"),
    (0x3100, "other"),
    (0x3400, "han"),
    (0xA000, "other"),
    (0xAC00, "hangul"),
    (0xD7B0, "other"),
    (0xF900, "han"),
    (0xFB00, "other"),
    (0x20000, "han"),
)
SCRIPT_NAMES = sorted({name for _, name in SCRIPTS})
_FROM = np.array([first for first, _ in SCRIPTS])
_SCRIPT = np.array([SCRIPT_NAMES.index(name) for _, name in SCRIPTS], np.int8)


@lru_cache(1)
def tables() -> tuple[np.ndarray, np.ndarray]:
    """By code point: part of a word (letters and combining marks), and its lower case where that is one code point."""
    points = [chr(i) for i in range(0x110000)]
    inside = np.fromiter((c.isalpha() or unicodedata.category(c)[0] == "M" for c in points), bool, 0x110000)
    lower = np.fromiter((ord(x) if len(x := c.lower()) == 1 else ord(c) for c in points), np.uint32, 0x110000)
    return inside, lower


class LetterWords:
    """The words of a list of texts: runs of letters, lower-cased.

    ``points``: code points of all texts, each text followed by a line feed; ``starts``, ``ends``: each
    word's place there; ``bounds``: the words of text i are ``bounds[i]`` to ``bounds[i + 1]``;
    ``texts``: where each text begins.
    """

    def __init__(self, texts: list[str | None]):
        inside, lower = tables()
        joined = "\n".join(text or "" for text in texts) + "\n"
        self.points = points = lower[np.frombuffer(joined.encode("utf-32-le"), np.uint32)]
        word = np.concatenate(([False], inside[points], [False]))
        change = np.flatnonzero(word[1:] != word[:-1])
        self.starts, self.ends = change[0::2], change[1::2]
        sizes = np.fromiter((len(text or "") + 1 for text in texts), np.int64, len(texts))
        self.texts = np.concatenate(([0], np.cumsum(sizes)))
        self.bounds = np.searchsorted(self.starts, self.texts)

    def scripts(self) -> np.ndarray:
        """The writing system of each word's first letter, as an index into SCRIPT_NAMES."""
        return _SCRIPT[np.searchsorted(_FROM, self.points[self.starts], "right") - 1]

    def grams(self, bits: int) -> np.ndarray:
        """For each letter in turn: a bucket for the letter with both neighbours in its word."""
        letters = self._letters()
        before, after = self.points[letters - 1].copy(), self.points[letters + 1].copy()
        first = np.cumsum(self.ends - self.starts) - (self.ends - self.starts)
        before[first] = 0
        after[first + (self.ends - self.starts) - 1] = 0
        x = before * np.uint32(0x9E3779B1) ^ self.points[letters] * np.uint32(0x85EBCA77) ^ after * np.uint32(0xC2B2AE3D)
        x = (x ^ (x >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
        return x >> np.uint32(32 - bits)

    def _letters(self) -> np.ndarray:
        sizes = self.ends - self.starts
        return np.arange(int(sizes.sum())) + np.repeat(self.starts - (np.cumsum(sizes) - sizes), sizes)

    def word(self, i: int) -> str:
        return self.points[self.starts[i] : self.ends[i]].tobytes().decode("utf-32-le")
