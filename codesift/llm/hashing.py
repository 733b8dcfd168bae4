"""64-bit hashes of words and numbers, alike on every machine."""

from __future__ import annotations

import numpy as np

ODD = np.uint64(0x9E3779B97F4A7C15)
_KEPT_WORDS = 200_000


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) >= _KEPT_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


_HASHES = _WordHashes()


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    """Unsigned 64-bit numbers, well mixed."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def window_hashes(hashes: np.ndarray, width: int) -> np.ndarray:
    """One hash for each run of ``width`` hashes; none if there are fewer."""
    n = max(len(hashes) - width + 1, 0)
    total = np.full(n, width, np.uint64)
    for i in range(width):
        total = total * ODD + hashes[i: i + n]
    return mixed(total)
