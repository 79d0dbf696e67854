"""Word shingles as 64-bit hashes (numpy, for use inside tasks)."""

from __future__ import annotations

import numpy as np
import xxhash

from lodgeflow.llm.common import lower_words

#: Words whose hash a task remembers before it starts afresh.
REMEMBERED = 500_000
_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93,
                 0xA0761D6478BD642F], np.uint64)  # fixed odd multipliers, one per place


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


_KNOWN = _WordHashes()


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(_KNOWN.__getitem__, words), np.uint64, len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit values."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def shingle_hashes(words: list[bytes], width: int) -> np.ndarray:
    """Hash of every run of ``width`` words in order; of the whole sequence
    when there are fewer; nothing without words."""
    if not words:
        return np.empty(0, np.uint64)
    w = word_hashes(words)
    n, k = len(w), min(width, len(w))
    total = np.full(n - k + 1, k, np.uint64)
    for i in range(k):
        total = mixed(total) + w[i:n - k + 1 + i] * _MIX[i % len(_MIX)]
    return mixed(total)


def shingle_set(text: bytes, width: int) -> np.ndarray:
    """Sorted distinct shingle hashes of a text."""
    return np.unique(shingle_hashes(lower_words(text), width))
