"""Word shingles as 64-bit numbers, shared by the shingle operators.

A word is a maximal run of bytes other than space and 0x09-0x0D in the UTF-8
text after A-Z were lower-cased (``bytes.lower`` touches ASCII only). A
shingle is a run of consecutive words; its number mixes the words' 64-bit
hashes in order. All steps are numpy over whole texts, block by block, so a
text of any length needs memory for its words, not for per-word objects.
"""

from __future__ import annotations

import re

import numpy as np

_BASE = 0x9E3779B97F4A7C15
_ORDER = np.uint64(0xD6E8FEB86659FD93)
_MIX1 = np.uint64(0xBF58476D1CE4E5B9)
_MIX2 = np.uint64(0x94D049BB133111EB)

#: Bytes hashed at a time; a block ends at white space, so a longer word makes a longer block.
BLOCK = 1 << 16

_space = np.zeros(256, dtype=bool)
_space[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_BREAK = re.compile(rb"[\x20\x09-\x0D]")


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers (splitmix64's finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * _MIX1
    x = (x ^ (x >> np.uint64(27))) * _MIX2
    return x ^ (x >> np.uint64(31))


_letter = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))
_powers = (np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64))


def _powers_to(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base and of its inverse modulo 2**64."""
    global _powers
    if len(_powers[0]) < n:
        size = max(n, BLOCK + 1024)
        both = []
        for base in (_BASE, pow(_BASE, -1, 1 << 64)):
            p = np.full(size, np.uint64(base))
            p[0] = 1
            both.append(np.cumprod(p, dtype=np.uint64))
        if size > 1 << 22:  # of a huge word: not kept
            return tuple(both)
        _powers = tuple(both)
    return _powers


def _block_hashes(data: np.ndarray) -> np.ndarray:
    gap = _space[data]
    edge = np.diff(gap.astype(np.int8), prepend=1, append=1)
    start, end = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    if not len(start):
        return np.empty(0, dtype=np.uint64)
    up, down = _powers_to(len(data))
    total = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_letter[data] * up[:len(data)], out=total[1:])
    return mix((total[end] - total[start]) * down[start] + (end - start).astype(np.uint64))


def word_hashes(text: str | None) -> np.ndarray:
    """64-bit hashes of a text's words in order (none for a null)."""
    data = text.encode("utf-8").lower() if text else b""
    parts, at = [], 0
    while at < len(data):
        stop = len(data)
        if stop - at > BLOCK:
            gap = _BREAK.search(data, at + BLOCK)
            stop = gap.start() if gap else stop
        parts.append(_block_hashes(np.frombuffer(data, dtype=np.uint8, count=stop - at, offset=at)))
        at = stop
    if not parts:
        return np.empty(0, dtype=np.uint64)
    return parts[0] if len(parts) == 1 else np.concatenate(parts)


def windows(hashes: np.ndarray, size: int) -> np.ndarray:
    """Numbers of all runs of ``size`` words, in text order, repeats included."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.empty(0, dtype=np.uint64)
    out = np.full(n, np.uint64(size))
    for k in range(size):
        out = out * _ORDER + hashes[k:k + n]
    return mix(out)


def distinct(x: np.ndarray) -> np.ndarray:
    x = np.sort(x)
    return x[np.concatenate(([True], x[1:] != x[:-1]))] if len(x) else x


def shingle_set(text: str | None, size: int = 5) -> np.ndarray:
    """Sorted distinct shingles of a text; a text of fewer words gives its
    whole sequence as one shingle, a text without words none."""
    h = word_hashes(text)
    return distinct(windows(h, min(size, len(h)))) if len(h) else h
