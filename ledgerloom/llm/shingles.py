"""Word shingles of a text as 64-bit fingerprints."""

from __future__ import annotations

from hashlib import blake2b

import numpy as np

# The prints of so many words are at hand in a task (8 MB); most words of a text that are not among them occur once.
KEPT_WORDS = 50_000


class _WordPrints(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= KEPT_WORDS:
            self.clear()
        self[word] = found = int.from_bytes(blake2b(word, digest_size=8).digest(), "little")
        return found


def mixed(x: np.ndarray) -> np.ndarray:
    """Every bit of the result depends on every bit of ``x``."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


# Odd, and without a simple relation to each other: sums of words in another order differ.
_MULTIPLIERS = mixed(np.arange(1, 65, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


class Shingler:
    """Sets of word shingles; ``size`` words each."""

    def __init__(self, size: int = 5):
        self.size = size
        self.prints = _WordPrints()

    def shingles(self, text: str | None) -> np.ndarray:
        """The sorted distinct fingerprints of the shingles of ``text``.

        A-Z are lower-cased; words are what ASCII blanks part. Fewer words than ``size`` are one
        shingle together; no words, or null, give none.
        """
        words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
        if len(words) < self.size:
            if not words:
                return np.empty(0, np.uint64)
            whole = blake2b(b" ".join(words), digest_size=8, person=b"short").digest()
            return np.frombuffer(whole, np.uint64).copy()
        prints = np.fromiter(map(self.prints.__getitem__, words), np.uint64, len(words))
        last = len(words) - self.size + 1
        total = prints[:last] * _MULTIPLIERS[0]
        for i in range(1, self.size):
            total += prints[i : i + last] * _MULTIPLIERS[i]
        return np.unique(mixed(total))
