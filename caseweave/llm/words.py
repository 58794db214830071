"""Words of many texts at once, as 64-bit hashes in numpy arrays.

A word is a run of ASCII letters, digits and non-ASCII characters; A-Z count as a-z. Hashes are
polynomials over bytes modulo 2**64, mixed; equal words have equal hashes on every machine.
"""

from __future__ import annotations

import numpy as np

#: Byte -> lower-cased byte of a word, or 0 between words.
WORD_BYTES = np.zeros(256, np.uint8)
WORD_BYTES[0x30:0x3A] = np.arange(0x30, 0x3A)
WORD_BYTES[0x61:0x7B] = np.arange(0x61, 0x7B)
WORD_BYTES[0x41:0x5B] = np.arange(0x61, 0x7B)
WORD_BYTES[0x80:] = np.arange(0x80, 0x100)

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    """base ** 0..n-1 modulo 2**64; grown by doubling and kept."""
    have = _powers.get(base)
    if have is None:
        have = np.ones(1, np.uint64)
    while len(have) < n:
        step = np.uint64(pow(base, len(have), 1 << 64))
        have = np.concatenate([have, have * step])
    if len(have) <= 1 << 23:
        _powers[base] = have
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _ranges(values: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Polynomial of each range [begin, end) of ``values``, independent of its place."""
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * _power(_BASE, len(values)), out=sums[1:])
    return (sums[end] - sums[begin]) * _power(_INVERSE, len(values) + 1)[begin]


def word_hashes(
    data: np.ndarray, offsets: np.ndarray, table: np.ndarray = WORD_BYTES
) -> tuple[np.ndarray, np.ndarray]:
    """The hash of every word, and for each text the index of its first word (one more at the end).

    ``table`` gives what each byte counts as, 0 between words.
    """
    low = table[data]
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = low != 0
    begin = inside[1:-1] & ~inside[:-2]
    end = inside[1:-1] & ~inside[2:]
    edges = offsets[1:-1]
    edges = edges[(edges > 0) & (edges < len(data))]
    begin[edges] = inside[1:-1][edges]
    end[edges - 1] = inside[1:-1][edges - 1]
    first, last = np.flatnonzero(begin), np.flatnonzero(end) + 1
    hashes = mix(_ranges(low.astype(np.uint64), first, last) + (last - first).astype(np.uint64))
    return hashes, np.searchsorted(first, offsets, "left")


def windows(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` consecutive words, across texts too; see ``whole``."""
    n = max(0, len(hashes) - size + 1)
    at = np.arange(n)
    return mix(_ranges(hashes, at, at + size)) if n else np.zeros(0, np.uint64)


def whole(starts: np.ndarray, size: int, n: int) -> np.ndarray:
    """Which of the ``n`` windows of ``size`` words lie in one text."""
    left = np.repeat(starts[1:], np.diff(starts))[:n] - np.arange(n)
    return left >= size
