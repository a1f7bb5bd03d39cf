"""Vectorised words, hashes and shingles of whole texts (numpy over the bytes of many texts at once)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
#: Texts are hashed together up to so many bytes (a longer text alone), which bounds memory.
GROUP_BYTES = 1 << 20
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit mixer (splitmix64's finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def keys(n: int, seed: int) -> np.ndarray:
    """n fixed odd 64-bit numbers."""
    return mix64(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(_BASE) + np.uint64(seed)) | np.uint64(1)


_BYTE = keys(256, 1)
_BYTE_LOWER = _BYTE.copy()
_BYTE_LOWER[65:91] = _BYTE[97:123]
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _pow(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        for i, b in enumerate((_BASE, _INVERSE)):
            p = np.full(max(n, GROUP_BYTES + 1), b, np.uint64)
            p[0] = 1
            _powers[i] = np.cumprod(p)
    out = _powers[0][:n], _powers[1][:n]
    if n > 4 * GROUP_BYTES:  # not kept for an unusually long text
        _powers[:] = [p[:GROUP_BYTES + 1].copy() for p in _powers]
    return out


def groups(texts: list[str | None]) -> Iterator[list[bytes]]:
    """The texts in UTF-8 (null: empty), in groups of bounded size."""
    group, size = [], 0
    for t in texts:
        raw = t.encode() if t else b""
        if group and size + len(raw) > GROUP_BYTES:
            yield group
            group, size = [], 0
        group.append(raw)
        size += len(raw) + 1
    if group:
        yield group


class Words:
    """The words of a group of texts: ``hash`` of each, its ``start`` and ``end`` in ``buf``; text i has the
    words first[i] to first[i+1]."""

    def __init__(self, group: list[bytes], lower: bool):
        self.buf = np.frombuffer(b" ".join(group) + b" ", np.uint8)
        edge = np.flatnonzero(np.diff(~_SPACE[self.buf], prepend=False))
        self.start, self.end = edge[0::2], edge[1::2]
        power, inverse = _pow(len(self.buf) + 1)
        run = np.zeros(len(self.buf) + 1, np.uint64)
        np.cumsum((_BYTE_LOWER if lower else _BYTE)[self.buf] * power[:-1], out=run[1:])
        self.hash = mix64((run[self.end] - run[self.start]) * inverse[self.start]
                          + (self.end - self.start).astype(np.uint64))
        offsets = np.cumsum([0] + [len(g) + 1 for g in group])
        self.first = np.searchsorted(self.start, offsets)

    def __len__(self) -> int:
        return len(self.first) - 1

    def ngrams(self, i: int, n: int) -> np.ndarray:
        """Hashes of the n-word shingles of text i; with fewer words, of the whole sequence as one."""
        return shingles(self.hash[self.first[i]:self.first[i + 1]], n)


_PLACE = keys(64, 2)


def shingles(h: np.ndarray, n: int) -> np.ndarray:
    if len(h) < n:
        if not len(h):
            return h
        n = len(h)
        return mix64(np.array([(h * _PLACE[:n]).sum() + np.uint64(n)], np.uint64))
    out = h[:len(h) - n + 1] * _PLACE[0]
    for j in range(1, n):
        out = out + h[j:len(h) - n + 1 + j] * _PLACE[j]
    return mix64(out)
