"""Shingle sets of texts as sorted 64-bit hashes."""

from __future__ import annotations

import numpy as np
import xxhash

from .tallies import distinct


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: every input bit affects every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def tokenised(texts: list[str | None]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Different words, the word number of every token, and the position at which each text starts (and the end)."""
    numbers: dict[bytes, int] = {}
    parts, starts = [], [0]
    for text in texts:
        words = (text or "").encode().lower().split()
        parts.append(np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words)))
        starts.append(starts[-1] + len(words))
    return list(numbers), np.concatenate(parts) if parts else np.empty(0, np.int64), np.array(starts)


def shingle_sets(texts: list[str | None], size: int) -> list[np.ndarray]:
    """The sorted different 64-bit shingle hashes of each text."""
    words, tokens, starts = tokenised(texts)
    hashes = np.array([xxhash.xxh3_64_intdigest(w) for w in words], np.uint64)[tokens] if words else np.empty(0, np.uint64)
    n = max(0, len(hashes) - size + 1)
    windows = np.full(n, size, np.uint64)
    for k in range(size):
        windows = mixed(windows * np.uint64(0x9E3779B97F4A7C15) + hashes[k : k + n])
    sets = []
    for a, z in zip(starts[:-1], starts[1:], strict=True):
        if z - a >= size:
            sets.append(distinct(windows[a : z - size + 1]))
        elif z > a:
            short = np.full(1, z - a, np.uint64)
            for h in hashes[a:z]:
                short = mixed(short * np.uint64(0x9E3779B97F4A7C15) + h)
            sets.append(short)
        else:
            sets.append(np.empty(0, np.uint64))
    return sets
