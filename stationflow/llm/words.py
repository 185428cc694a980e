"""Hashes of words and word shingles of a text, a whole text at a time.

Words are runs of ASCII letters, digits and non-ASCII characters, ASCII letters
in lower case.
"""

from __future__ import annotations

import numpy as np

from stationflow.llm.suffixes import byte_sums

SHINGLE = 5
#: Bytes of UTF-8: ASCII letters in lower case, other ASCII but digits as spaces.
PLAIN = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 97 <= c <= 122 or 48 <= c <= 57 else 32 for c in range(256))


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ h >> np.uint64(32)) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ h >> np.uint64(32)


def word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word, and the byte at which it begins."""
    plain = np.frombuffer(data.translate(PLAIN), np.uint8)
    inside = np.zeros(len(plain) + 2, np.int8)
    inside[1:-1] = plain != 32
    edges = np.flatnonzero(np.diff(inside))
    starts, ends = edges[::2], edges[1::2]
    sums, down = byte_sums(plain)
    return mixed((sums[ends] - sums[starts]) * down[starts]), starts


def shingles(h: np.ndarray, width: int = SHINGLE) -> np.ndarray:
    """Hash of the ``width`` words from every word, by the words' hashes; of fewer words, nothing."""
    n = max(len(h) - width + 1, 0)
    state = h[:n].copy()
    for j in range(1, width if n else 0):
        state *= np.uint64(0x9E3779B97F4A7C15)
        state ^= state >> np.uint64(31)
        state += h[j : n + j]
    return mixed(state)
