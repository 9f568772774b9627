"""Word shingles as 64-bit hashes, computed for many texts at once."""

from __future__ import annotations

import numpy as np

BASE = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def word_hashes(raw: bytes) -> np.ndarray:
    """One hash for each word (run of bytes other than blank, tab and line ends) of one text."""
    data = np.frombuffer(raw, np.uint8)
    inside = np.concatenate(([False], ~((data == 32) | ((data >= 9) & (data <= 13))), [False]))
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    begin, end = edges[::2], edges[1::2]
    sums = np.concatenate(
        (np.zeros(1, np.uint64), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(BASE, len(data)), dtype=np.uint64))
    )
    return mixed((sums[end] - sums[begin]) * powers(INVERSE, len(data) + 1)[begin])


def shingles(text: str | None, words: int) -> np.ndarray:
    """Distinct shingles of ``words`` words, sorted; a shorter text is one shingle, an empty one has none."""
    hashes = word_hashes((text or "").encode("utf-8", "replace"))
    if not len(hashes):
        return hashes
    n = max(1, len(hashes) - words + 1)
    out = np.zeros(n, np.uint64)
    for k in range(min(words, len(hashes))):
        out = out * BASE + hashes[k : k + n]
    return np.unique(mixed(out + np.uint64(min(words, len(hashes)))))
