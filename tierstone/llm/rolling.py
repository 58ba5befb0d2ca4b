"""Hashes of word windows: random values of words, summed with powers of an odd base modulo 2^64."""

from __future__ import annotations

import numpy as np

#: Two odd multipliers; a window hash of two columns uses both.
BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_POWERS: dict[int, np.ndarray] = {}
#: Values of at most so many words, of at most so many bytes each, are remembered by a task.
REMEMBERED_WORDS, REMEMBERED_BYTES = 1_000_000, 64


def powers(base: int, n: int) -> np.ndarray:
    """base^0 ... base^(n-1) modulo 2^64, remembered up to the longest text seen."""
    known = _POWERS.get(base)
    if known is None or len(known) < n:
        steps = np.full(max(2 * n, 4096), base, np.uint64)
        steps[0] = 1
        known = _POWERS[base] = np.cumprod(steps)
    return known[:n]


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class WordValues(dict):
    """Word -> XXH64, computed once per word while remembered."""

    def __missing__(self, word: bytes) -> int:
        import xxhash

        value = xxhash.xxh64_intdigest(word, 7)
        if len(word) <= REMEMBERED_BYTES:
            if len(self) >= REMEMBERED_WORDS:
                self.clear()
            self[word] = value
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def prefix_sums(values: np.ndarray, base: int = BASES[0]) -> np.ndarray:
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers(base, len(values)), out=out[1:])
    return out


def window_hashes(sums: np.ndarray, starts: np.ndarray, width: int, base: int = BASES[0]) -> np.ndarray:
    """Hash of the `width` words from each start; equal for equal words wherever they stand."""
    back = powers(pow(base, -1, 1 << 64), len(sums))
    return (sums[starts + width] - sums[starts]) * back[starts]
