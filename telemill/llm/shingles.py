"""Word shingles of texts as sets of 64-bit hashes."""

from __future__ import annotations

import numpy as np

from telemill.llm.common import mix, word_hashes

_FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)


def shingle_sets(data: np.ndarray, places: np.ndarray, width: int = 3) -> tuple[np.ndarray, np.ndarray]:
    """The distinct `width`-word shingles of each text, as sorted hashes, and the n + 1 places where texts start.

    A text of fewer words has one shingle, its whole word sequence; a text without words has none.
    """
    words, counts = word_hashes(data, places)
    ends = np.cumsum(counts)
    texts = np.repeat(np.arange(len(counts)), counts)
    left = np.repeat(ends, counts) - np.arange(len(words))  # words from here to the end of the text
    n = len(words)
    total = np.zeros(n, np.uint64)
    for j in range(width):
        shifted = np.zeros(n, np.uint64)
        shifted[: max(0, n - j)] = words[j:]
        shifted[left <= j] = np.uint64(j)
        total = mix(total * _FACTORS[j % 3] + shifted)
    short = counts < width
    kept = (left >= width) | (short[texts] & (left == counts[texts]))
    texts, hashes = texts[kept], total[kept]
    order = np.lexsort((hashes, texts))
    texts, hashes = texts[order], hashes[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (texts[1:] != texts[:-1])
    texts, hashes = texts[new], hashes[new]
    return hashes, np.searchsorted(texts, np.arange(len(counts) + 1))
