"""Elias-Fano coding of a non-decreasing sequence of non-negative integers, as bytes.

With n values up to u, the lowest ``floor(log2(u / n))`` bits of each value are packed one after the other and the rest
is written in unary into a bit string of at most 3n bits. The place of every ``STEP``-th one in it is stored too, so
``select`` scans a few bytes only.

Layout, little-endian: n (u64), number of low bits (u8), bytes of the low part (u64), bytes of the high part (u64), low
part, high part, samples (u64 each).
"""

from __future__ import annotations

import struct

import numpy as np

STEP = 256
_HEAD = struct.Struct("<QBQQ")
_ONES = np.array([bin(b).count("1") for b in range(256)], np.uint8)


def encode(values: np.ndarray) -> bytes:
    values = np.ascontiguousarray(values, np.uint64)
    n = len(values)
    top = int(values[-1]) if n else 0
    low_bits = max(0, (top // max(n, 1)).bit_length() - 1)
    shifts = np.arange(low_bits, dtype=np.uint64)
    low = np.packbits((values[:, None] >> shifts & np.uint64(1)).astype(np.uint8).ravel(), bitorder="little").tobytes()
    ones = (values >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
    bits = np.zeros(int(ones[-1]) + 1 if n else 0, np.uint8)
    bits[ones] = 1
    high = np.packbits(bits, bitorder="little").tobytes()
    return _HEAD.pack(n, low_bits, len(low), len(high)) + low + high + ones[::STEP].astype("<u8").tobytes()


class Boundaries:
    """Reads an encoded sequence without unpacking it."""

    def __init__(self, data: bytes) -> None:
        self.n, self.low_bits, low, high = _HEAD.unpack_from(data)
        at = _HEAD.size
        self._low = np.frombuffer(data, np.uint8, low, at)
        self._high = np.frombuffer(data, np.uint8, high, at + low)
        self._samples = np.frombuffer(data, "<u8", -(-self.n // STEP), at + low + high)

    def select(self, i: int) -> int:
        """The i-th value."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        place = int(self._samples[i // STEP])
        left = i % STEP  # ones still to pass, after the sampled one
        byte = place // 8
        # the sampled one and what lies before it in its byte do not count
        counts = _ONES[self._high[byte : byte + 1] & (0xFF << (place % 8) & 0xFF)]
        left += 1
        width = 64
        passed = byte
        while True:
            chunk = _ONES[self._high[passed : passed + width]].astype(np.int64)
            if passed == byte:
                chunk[0] = counts[0]
            total = np.cumsum(chunk)
            if total[-1] >= left:
                k = int(np.searchsorted(total, left))
                before = int(total[k - 1]) if k else 0
                value = int(self._high[passed + k])
                if passed + k == byte:
                    value &= 0xFF << (place % 8) & 0xFF
                for _ in range(left - before - 1):
                    value &= value - 1  # clear the lowest one
                bit = (value & -value).bit_length() - 1
                return self._value(i, 8 * (passed + k) + bit)
            left -= int(total[-1])
            passed += width

    def _value(self, i: int, place: int) -> int:
        low = 0
        for j in range(self.low_bits):
            bit = i * self.low_bits + j
            low |= (int(self._low[bit // 8]) >> (bit % 8) & 1) << j
        return (place - i) << self.low_bits | low

    def all(self) -> np.ndarray:
        """Every value at once."""
        ones = np.flatnonzero(np.unpackbits(self._high, bitorder="little"))[: self.n]
        bits = np.unpackbits(self._low, count=self.n * self.low_bits, bitorder="little").reshape(self.n, self.low_bits)
        low = (bits.astype(np.int64) << np.arange(self.low_bits)).sum(axis=1) if self.low_bits else 0
        return (ones - np.arange(self.n) << self.low_bits) + low
