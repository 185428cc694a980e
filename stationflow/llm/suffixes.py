"""Sampled suffixes of byte strings: anchors that equal passages have in common.

Of all windows of ``WINDOW`` bytes, each has an anchor: the start of its
``GRAM``-byte piece with the smallest hash, the leftmost among equals. The anchor
depends on the window's bytes alone, so equal windows, wherever they stand, have
anchors at the same place with the same piece. Neighbouring windows share an
anchor; such a run of windows is one entry of a suffix array, about one in 150
bytes.
"""

from __future__ import annotations

import numpy as np
import xxhash

WINDOW = 400
GRAM = 100
_FACTOR = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_FACTOR, -1, 1 << 64)
#: One number for each byte, drawn from a fixed seed.
_BYTES = np.random.default_rng(400).integers(0, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _upto(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the factor and of its inverse."""
    if len(_powers[0]) < n:
        size = 1 << (n - 1).bit_length()
        for i, base in enumerate((_FACTOR, _INVERSE)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[i] = np.cumprod(steps, dtype=np.uint64)
    return _powers[0][:n], _powers[1][:n]


def byte_sums(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Running sum of weighted bytes, and what makes differences of it independent of place."""
    up, down = _upto(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTES[data] * up[:-1], out=sums[1:])
    return sums, down


def gram_hashes(data: np.ndarray, gram: int = GRAM) -> np.ndarray:
    """Hash of the ``gram`` bytes from every place, by differences of one running sum."""
    sums, down = byte_sums(data)
    h = (sums[gram:] - sums[:-gram]) * down[: len(data) - gram + 1]
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    return h


def runs(data: bytes, window: int = WINDOW, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """First and last window start of every run, and the hash of its anchor's piece."""
    if len(data) < window:
        return (np.zeros(0, np.int64),) * 2 + (np.zeros(0, np.uint64),)
    h = gram_hashes(np.frombuffer(data, np.uint8), gram)
    low = np.uint64(0xFFFFFFFF)
    least = (h & ~low) | np.arange(len(h), dtype=np.uint64)  # by the upper half, then by place
    width, wanted = 1, window - gram + 1
    while 2 * width <= wanted:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if width < wanted:
        least = np.minimum(least[: len(least) - (wanted - width)], least[wanted - width :])
    anchor = (least & low).astype(np.int64)
    begin = np.concatenate([[0], np.flatnonzero(np.diff(anchor)) + 1])
    end = np.concatenate([begin[1:], [len(anchor)]]) - 1
    return begin, end, h[anchor[begin]]


def run_hashes(data: bytes, begin: np.ndarray, end: np.ndarray, window: int = WINDOW) -> list[int]:
    """Hash of all bytes that the windows of each run cover."""
    digest = xxhash.xxh3_64_intdigest
    return [digest(data[i:j]) for i, j in zip(begin.tolist(), (end + window).tolist(), strict=True)]
