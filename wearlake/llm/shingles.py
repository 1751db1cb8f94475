"""Word shingles of a text as sorted 64-bit hashes, in numpy."""

from __future__ import annotations

import numpy as np
import xxhash

# Odd multipliers, one for each place of a shingle, from the splitmix64 sequence.
_MASK = (1 << 64) - 1


def split_mix(count: int, seed: int = 0) -> np.ndarray:
    """``count`` well mixed 64-bit numbers."""
    found, state = [], seed
    for _ in range(count):
        state = (state + 0x9E3779B97F4A7C15) & _MASK
        z = state
        z = ((z ^ (z >> 30)) * 0xBF58476D1CE4E5B9) & _MASK
        z = ((z ^ (z >> 27)) * 0x94D049BB133111EB) & _MASK
        found.append(z ^ (z >> 31))
    return np.array(found, dtype=np.uint64)


class WordHashes(dict):
    """Remembers the hashes of words; forgets all when full."""

    def __init__(self, most: int = 500_000):
        super().__init__()
        self.most = most

    def __missing__(self, word: bytes) -> int:
        found = xxhash.xxh64_intdigest(word)
        if len(word) <= 64:
            if len(self) >= self.most:
                self.clear()
            self[word] = found
        return found


def mixed(values: np.ndarray) -> np.ndarray:
    """A one-to-one scramble of 64-bit numbers."""
    values = values ^ (values >> np.uint64(32))
    values = values * np.uint64(0xD6E8FEB86659FD93)
    values = values ^ (values >> np.uint64(29))
    values = values * np.uint64(0x9FB21C651E98DF25)
    return values ^ (values >> np.uint64(32))


class Shingler:
    """Sets of shingles of ``size`` words; A-Z in lower case, ASCII blanks part words."""

    def __init__(self, size: int = 5):
        self.size = size
        self.places = split_mix(size, seed=5) | np.uint64(1)
        self.hashes = WordHashes()

    def __call__(self, text: str | None) -> np.ndarray:
        """Distinct shingle hashes in order; a shorter text is one shingle of its words."""
        # bytes.lower and bytes.split know ASCII letters and exactly these six blanks.
        parts = (text or "").encode("utf-8", "surrogatepass").lower().split()
        if not parts:
            return np.empty(0, np.uint64)
        hashes = self.hashes
        coded = np.array([hashes[part] for part in parts], dtype=np.uint64)
        width = min(self.size, len(coded))
        count = len(coded) - width + 1
        total = np.full(count, np.uint64(width))
        for place in range(width):
            total += coded[place : place + count] * self.places[place]
        return np.unique(mixed(total))
