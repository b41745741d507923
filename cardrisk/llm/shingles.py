"""Hashed word shingles of whole texts."""

from __future__ import annotations

import hashlib

import numpy as np

from .common import mix64

_BYTE = mix64(np.arange(1, 257, dtype=np.uint64))
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32


def _powers(n: int) -> np.ndarray:
    out = np.ones(max(1, n), np.uint64)
    with np.errstate(over="ignore"):
        np.cumprod(np.full(max(0, n - 1), _MULTIPLIER), out=out[1:])
    return out


_POWERS = _powers(64)


def word_hashes(text: str) -> np.ndarray:
    """64-bit hashes of the words ``[^\\x20\\x09-\\x0D]+``, A-Z lower-cased, in order."""
    global _POWERS
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    solid = np.concatenate([[False], ~_IS_SPACE[raw], [False]])
    edge = np.flatnonzero(solid[1:] != solid[:-1])
    starts, ends = edge[::2], edge[1::2]
    if not len(starts):
        return np.zeros(0, np.uint64)
    at = np.arange(len(raw)) - np.repeat(starts, np.diff(np.append(starts, len(raw)))) if starts[0] == 0 else \
        np.arange(len(raw)) - np.concatenate([np.zeros(starts[0], np.int64), np.repeat(starts, np.diff(np.append(starts, len(raw))))])
    longest = int((ends - starts).max())
    if longest > len(_POWERS):
        _POWERS = _powers(2 * longest)
    with np.errstate(over="ignore"):
        value = _BYTE[_LOWER[raw]] * _POWERS[np.minimum(at, longest - 1)]
        value[~solid[1:-1]] = 0
        return mix64(np.add.reduceat(value, starts) + (ends - starts).astype(np.uint64))


def shingle_set(text: str, width: int) -> np.ndarray:
    """Sorted distinct hashes of the ``width``-word shingles; with fewer words the whole sequence is one."""
    w = word_hashes(text)
    n = len(w)
    if not n:
        return w
    k = min(width, n)
    with np.errstate(over="ignore"):
        h = w[:n - k + 1] + np.uint64(k)
        for i in range(1, k):
            h = mix64(h) + w[i:n - k + 1 + i]
    return np.unique(mix64(h))


def set_digest(s: np.ndarray) -> bytes:
    """128 bits that stand for a whole set."""
    return hashlib.blake2b(s.tobytes(), digest_size=16).digest()


def signature(s: np.ndarray, multipliers: np.ndarray) -> np.ndarray:
    """One minimum of the set per multiplier (multiply-shift hashes; the upper 32 bits)."""
    out = np.full(len(multipliers), np.iinfo(np.uint64).max, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(0, len(s), 4096):
            np.minimum(out, (s[None, i:i + 4096] * multipliers[:, None]).min(1), out=out)
    return out
