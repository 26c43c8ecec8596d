"""Vectorised scans of Arrow text columns: byte runs and running hashes.

Bytes of one range of texts are looked at as one numpy array; runs never cross a
text's end.  Hashes are Karp-Rabin polynomials modulo 2**64 with an odd base, so the
hash of any byte range follows from two running sums; whoever needs equality compares
the bytes themselves after a hash match.
"""

from __future__ import annotations

import re
import unicodedata
from functools import cache

import numpy as np

BASE = np.uint64(0x9E3779B97F4A7C15)


def _inverse(x: int) -> int:
    return pow(int(x), -1, 1 << 64)


def byte_table(member) -> np.ndarray:
    return np.array([bool(member(b)) for b in range(256)])


#: Letters, digits and every byte of a non-ASCII character.
WORD = byte_table(lambda b: b >= 128 or chr(b).isalnum())


_OTHER = re.compile(r"[^\x00-\x7f\w]+")


@cache
def _shown(char: str) -> str:
    kind = unicodedata.category(char)
    if kind == "Cf" and char != "\u200b":  # a zero width space parts words as other spaces do
        return ""
    return " " if kind[0] in "ZPS" or kind in ("Cc", "Cf") else char


def folded(text: bytes) -> bytes:
    """``text`` without case: Unicode case folding, non-ASCII spaces, punctuation, symbols and controls as
    blanks, format characters (soft hyphens, joiners, byte order marks) left out; marks stay in their words."""
    if text.isascii():
        return text.lower()
    t = text.decode("utf-8", "replace").upper().casefold()  # upper first: a dotless i has no capital of its own
    return _OTHER.sub(lambda m: "".join(map(_shown, m[0])), t).encode()


_POWERS = np.ones(1, dtype=np.uint64)
_INVERSES = np.ones(1, dtype=np.uint64)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i modulo 2**64 for i < n, kept between calls."""
    global _POWERS, _INVERSES
    if len(_POWERS) < n:
        size = max(n, 1 << 16)
        grow = lambda x: np.concatenate((np.ones(1, np.uint64), np.cumprod(np.full(size - 1, x, dtype=np.uint64))))
        _POWERS, _INVERSES = grow(BASE), grow(np.uint64(_inverse(BASE)))
    return _POWERS[:n], _INVERSES[:n]


class Texts:
    """Several texts as one byte array with offsets; ``lower`` folds them first."""

    def __init__(self, texts: list[bytes], lower: bool = True):
        if lower:
            texts = [folded(t) for t in texts]
        self.size = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
        self.offsets = np.concatenate((np.zeros(1, np.int64), np.cumsum(self.size)))
        self.buf = np.frombuffer(b"".join(texts), dtype=np.uint8)

    def runs(self, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start, end, text) of all maximal runs of bytes of ``table`` within a text."""
        n = len(self.buf)
        if not n:
            z = np.zeros(0, dtype=np.int64)
            return z, z, z
        hit = table[self.buf]
        first = hit.copy()
        first[1:] &= ~hit[:-1]
        last = hit.copy()
        last[:-1] &= ~hit[1:]
        heads = self.offsets[:-1][self.size > 0]
        first[heads] = hit[heads]
        tails = self.offsets[1:][self.size > 0] - 1
        last[tails] = hit[tails]
        start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
        return start, end, np.searchsorted(self.offsets, start, side="right") - 1

    def running(self) -> np.ndarray:
        """Running sums for :meth:`hashes`."""
        pw, _ = _powers(len(self.buf) + 1)
        out = np.zeros(len(self.buf) + 1, dtype=np.uint64)
        np.cumsum((self.buf.astype(np.uint64) + np.uint64(1)) * pw[:-1], out=out[1:])
        return out

    def hashes(self, running: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hash of bytes start..end (exclusive), the same wherever they stand."""
        _, inv = _powers(len(self.buf) + 1)
        return (running[end] - running[start]) * inv[start]


def mix(h: np.ndarray) -> np.ndarray:
    """Spreads a polynomial hash over all bits (finaliser of splitmix64)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))
