"""Word shingles of many texts at once, as 64-bit hashes, on numpy arrays.

Words are runs of bytes other than space and ``\\t \\n \\v \\f \\r`` of the UTF-8 text, A-Z lower-cased. A shingle is five
words in a row; a text with one to four words has its whole sequence as its only shingle.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np

WORDS = 5
_BLOCK = 1 << 19  # bytes hashed at once; a longer text is a block of its own
_U = np.uint64


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> _U(33))
    x = x * _U(0xFF51AFD7ED558CCD)
    x = x ^ (x >> _U(29))
    x = x * _U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> _U(32))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out)


class Shingler:
    """Hashes texts; equal seeds give equal hashes everywhere."""

    def __init__(self, seed: int = 0) -> None:
        values = mixed(np.arange(1, 257, dtype=np.uint64) + _U(seed * 1000))
        fold = np.arange(256)
        fold[65:91] += 32
        self._values = values[fold]
        self._blank = np.isin(np.arange(256), [32, 9, 10, 11, 12, 13])
        self._base = 0x9E3779B97F4A7C15 | 3
        self._inverse = pow(self._base, -1, 1 << 64)
        self._up, self._down = _powers(self._base, _BLOCK + 2), _powers(self._inverse, _BLOCK + 2)
        self._steps = mixed(np.arange(100, 100 + WORDS, dtype=np.uint64)) | _U(1)
        self._short = mixed(np.arange(200, 200 + WORDS, dtype=np.uint64))

    def _words(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all words, and the number of words before each text."""
        data = np.frombuffer(b" " + b" ".join(texts) + b" ", np.uint8)
        if len(data) > len(self._up):
            self._up, self._down = _powers(self._base, len(data)), _powers(self._inverse, len(data))
        inside = ~self._blank[data]
        edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
        starts, ends = edges[::2], edges[1::2]
        sums = np.cumsum(self._values[data] * self._up[: len(data)])
        words = mixed((sums[ends - 1] - sums[starts - 1]) * self._down[starts])
        lengths = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
        firsts = np.concatenate(([0], np.cumsum(lengths)))
        return words, np.searchsorted(starts, firsts)

    def _block(self, texts: list[bytes]) -> Iterator[np.ndarray]:
        words, bounds = self._words(texts)
        windows = np.zeros(max(0, len(words) - WORDS + 1), np.uint64)
        for k in range(WORDS):
            windows += words[k : k + len(windows)] * self._steps[k]
        windows = mixed(windows)
        for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            if b - a >= WORDS:
                yield np.unique(windows[a : b - WORDS + 1])
            elif b > a:
                some = (words[a:b] * self._steps[: b - a]).sum(dtype=np.uint64, keepdims=True)
                yield mixed(some + self._short[b - a])
            else:
                yield np.empty(0, np.uint64)

    def sets(self, texts: Iterable[str | None]) -> Iterator[np.ndarray]:
        """The distinct shingles of each text, ascending."""
        held: list[bytes] = []
        size = 0
        for text in texts:
            raw = (text or "").encode("utf-8", "surrogatepass")
            if held and size + len(raw) + 1 > _BLOCK:
                yield from self._block(held)
                held, size = [], 0
            held.append(raw)
            size += len(raw) + 1
        if held:
            yield from self._block(held)
