"""Word and character shingles as 64-bit hashes, in numpy inside the tasks."""

from __future__ import annotations

import re

import numpy as np
import xxhash

WORD = re.compile(r"\w+")
MIX = np.uint64(0x9E3779B97F4A7C15)
STEP = np.uint64(0xD6E8FEB86659FD93)
#: Words whose hashes a worker keeps; a full table is emptied.
CACHE = 200_000


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijection that spreads the bits of 64-bit values (splitmix64)."""
    with np.errstate(over="ignore"):
        h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class WordHashes(dict):
    """word -> 8 bytes; joined they are an array of hashes."""

    def __missing__(self, word: str) -> bytes:
        if len(self) >= CACHE:
            self.clear()
        got = self[word] = xxhash.xxh64_digest(word.encode("utf-8", "surrogatepass"))
        return got


def rolling(h: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of n neighbours."""
    if len(h) < n:
        return h[:0]
    with np.errstate(over="ignore"):
        # Polynomials in STEP of one neighbour, then of twice as many, and of one more where n is odd.
        total, width = h, 1
        for bit in f"{n:b}"[1:]:
            total = total[:-width] * np.uint64(pow(int(STEP), width, 1 << 64)) + total[width:]
            width *= 2
            if bit == "1":
                total = total[:-1] * STEP + h[width:]
                width += 1
        return mixed(total + MIX)


def word_shingles(text: str, n: int, cache: WordHashes) -> np.ndarray:
    """Distinct hashes, ascending, of all runs of n lower-case words.

    A text of fewer words has one shingle, all of them; one without words none.
    """
    words = WORD.findall(text.lower())
    h = np.frombuffer(b"".join(map(cache.__getitem__, words)), dtype="<u8")
    return np.unique(rolling(h, min(n, len(h)))) if len(h) else h


def char_shingles(text: str, n: int) -> np.ndarray:
    """Hashes, with repeats, of all runs of n characters; all of a shorter text."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64)
    return rolling(codes + MIX, min(n, len(codes))) if len(codes) else codes
