"""Texts as arrays of word codes, for operators that compare words of whole texts in numpy.

A word is ``[^\\x20\\x09-\\x0D]+``; ``bytes.split`` cuts at exactly these characters.
"""

from __future__ import annotations

import numpy as np

# Odd multipliers that mix 64-bit numbers.
MIX_A, MIX_B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A hash of pairs of 64-bit numbers; the order of the pair matters."""
    x = a * MIX_A + ((b << np.uint64(29)) | (b >> np.uint64(35)))
    x ^= x >> np.uint64(32)
    x *= MIX_B
    return x ^ (x >> np.uint64(29))


class _Codes(dict):
    """A number for every word, in the order of first use."""

    def __missing__(self, word: bytes) -> int:
        self[word] = code = len(self)
        return code


class Laid:
    """Texts one after the other: ``code`` holds a number per word, equal for equal words, and a number of its own before, between and after the texts.

    ``place`` tells where each text stood in the input; with ``longest_first`` texts with more words come first.
    """

    def __init__(self, texts: list[bytes], longest_first: bool = False) -> None:
        code_of = _Codes().__getitem__
        parts = [np.array([*map(code_of, text.split())], np.int64) for text in texts]
        size = np.array([len(p) for p in parts], np.int64)
        self.place = np.argsort(-size, kind="stable") if longest_first else np.arange(len(parts))
        self.size = size[self.place]
        self.first = np.cumsum(self.size + 1) - self.size
        marks = [np.array([-1 - i]) for i in range(len(parts) + 1)]
        self.code = np.concatenate([x for i, p in enumerate(self.place.tolist()) for x in (marks[i], parts[p])] + marks[-1:])

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each code."""
        code = self.code.astype(np.uint64)
        return mix(code, code)

    def text_of(self, positions: np.ndarray) -> np.ndarray:
        """Which text each position of a word lies in."""
        return np.searchsorted(self.first, positions, side="right") - 1


def covered(starts: np.ndarray, ends: np.ndarray, n: int) -> np.ndarray:
    """Whether each of ``n`` positions lies in any of the spans (end exclusive)."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, ends, -1)
    return np.cumsum(change[:-1]) > 0


__all__ = ["mix", "Laid", "covered"]
