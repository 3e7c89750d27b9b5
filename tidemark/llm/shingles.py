"""Word shingles of texts as sets of 64-bit hashes."""

from __future__ import annotations

import numpy as np

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, *range(9, 14)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_A, _B, _C = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_BASE = 0x100000001B3
_POWERS = np.cumprod(np.full(4096, _BASE, np.uint64))


def mixed(x: np.ndarray) -> np.ndarray:
    """Each 64-bit number scrambled, one to one."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * _B
        x = (x ^ (x >> np.uint64(27))) * _C
        return x ^ (x >> np.uint64(31))


def word_hashes(raw: bytes) -> np.ndarray:
    """A hash of each run of bytes other than ASCII white space, A-Z lower-cased."""
    b = np.frombuffer(raw, np.uint8)
    inside = ~_SPACE[b]
    edge = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8)))
    start, end = edge[::2], edge[1::2]
    if not len(start):
        return np.empty(0, np.uint64)
    length = end - start
    longest = int(length.max())
    with np.errstate(over="ignore"):
        powers = _POWERS if longest <= len(_POWERS) else np.cumprod(np.full(longest, _BASE, np.uint64))
        at = np.arange(len(b)) - np.repeat(np.concatenate([[0], start]), np.diff(np.concatenate([[0], start, [len(b)]])))
        value = np.where(inside, (_LOWER[b].astype(np.uint64) + np.uint64(7)) * powers[np.minimum(at, len(powers) - 1)], np.uint64(0))
        total = np.concatenate([[np.uint64(0)], np.cumsum(value)])
        return mixed((total[end] - total[start]) * _A + length.astype(np.uint64))


def shingle_set(text: str | None, words: int = 5) -> np.ndarray:
    """Sorted distinct hashes of all runs of ``words`` words; of the whole sequence if it is
    shorter; none without words."""
    h = word_hashes((text or "").encode("utf-8", "replace"))
    if not len(h):
        return h
    n = max(1, len(h) - words + 1)
    out = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(min(words, len(h))):
            out = mixed(out * _A + h[k : k + n] + np.uint64(k + 1))
    return np.unique(out)
