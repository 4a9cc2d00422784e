"""Elias-Fano coding of non-decreasing integers, with select.

``n`` values up to ``u`` take about ``2 + log2(u / n)`` bits each: the low ``l`` bits of every value
are packed side by side; the high parts are unary-coded, value ``i`` setting bit ``high_i + i``.
Select(i) finds the i-th set bit of the upper bits and reads ``l`` low bits: the set bits before every
``SELECT_STEP``-th bit are kept, 32 bits each, and bytes are counted between two of these.

Layout (little-endian): n u64, l u8, bytes of low part u64, bytes of upper part u64, low, upper.
"""

from __future__ import annotations

import struct

import numpy as np

_HEADER = "<QBQQ"
SELECT_STEP = 512
_STEP_BYTES = SELECT_STEP // 8
#: Places that one call looks up at a time.
_AT_ONCE = 4096


def encode(values: np.ndarray) -> bytes:
    """``values``: non-negative, non-decreasing; may be empty."""
    values = np.asarray(values, dtype=np.uint64)
    n = len(values)
    if n == 0:
        return struct.pack(_HEADER, 0, 0, 0, 0)
    if np.any(values[1:] < values[:-1]):
        raise ValueError("values must not decrease")
    low_bits = max(0, (int(values[-1]) // n).bit_length() - 1)
    low = np.zeros(0, np.uint8)
    if low_bits:
        bits = (values[:, None] >> np.arange(low_bits, dtype=np.uint64)) & np.uint64(1)
        low = np.packbits(bits.astype(np.uint8).ravel(), bitorder="little")
    at = (values >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
    upper = np.zeros(int(at[-1]) + 1, np.uint8)
    upper[at] = 1
    upper = np.packbits(upper, bitorder="little")
    return struct.pack(_HEADER, n, low_bits, len(low), len(upper)) + low.tobytes() + upper.tobytes()


class EliasFano:
    """Reads an encoded sequence in place."""

    def __init__(self, blob: bytes | memoryview, start: int = 0):
        self.n, self.low_bits, low, upper = struct.unpack_from(_HEADER, blob, start)
        start += struct.calcsize(_HEADER)
        self.low = np.frombuffer(blob, np.uint8, low, start)
        self.upper = np.frombuffer(blob, np.uint8, upper, start + low)
        self.end = start + low + upper
        # Set bits before every SELECT_STEP-th bit, the last step filled up with zeros.
        steps = -(-len(self.upper) // _STEP_BYTES)
        counts = np.bitwise_count(self.upper)
        counts = np.add.reduceat(counts, np.arange(steps) * _STEP_BYTES, dtype=np.uint32) if steps else np.zeros(0, np.uint32)
        self._before = np.concatenate([[0], np.cumsum(counts, dtype=np.uint32)[:-1]]).astype(np.uint32) if steps else counts

    def __len__(self) -> int:
        return self.n

    def select(self, i: int) -> int:
        """The i-th value."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        return int(self.select_many(np.array([i]))[0])

    def select_many(self, places: np.ndarray) -> np.ndarray:
        """The values at ``places``."""
        out = np.empty(len(places), np.int64)
        for at in range(0, len(places), _AT_ONCE):
            out[at : at + _AT_ONCE] = self._select(np.asarray(places[at : at + _AT_ONCE], np.int64))
        return out

    def _select(self, places: np.ndarray) -> np.ndarray:
        step = np.searchsorted(self._before, places, side="right") - 1
        rank = places - self._before[step]
        # The step's bytes, then the bits of the byte that holds the wanted one.
        at = step[:, None] * _STEP_BYTES + np.arange(_STEP_BYTES)
        inside = np.where(at < len(self.upper), self.upper[np.minimum(at, len(self.upper) - 1)], 0).astype(np.uint8)
        seen = np.cumsum(np.bitwise_count(inside), axis=1, dtype=np.int64)
        byte = (seen <= rank[:, None]).sum(axis=1)
        row = np.arange(len(places))
        rank -= np.where(byte > 0, seen[row, byte - 1], 0)
        bits = np.cumsum((inside[row, byte][:, None] >> np.arange(8, dtype=np.uint8)) & 1, axis=1)
        bit = (bits <= rank[:, None]).sum(axis=1)
        high = (step * _STEP_BYTES + byte) * 8 + bit - places
        return (high << self.low_bits) | self._low(places)

    def _low(self, places: np.ndarray) -> np.ndarray:
        out = np.zeros(len(places), np.int64)
        for bit in range(self.low_bits):
            at = places * self.low_bits + bit
            out |= ((self.low[at >> 3] >> (at & 7).astype(np.uint8)) & 1).astype(np.int64) << bit
        return out

    def values(self) -> np.ndarray:
        """All values at once."""
        if not self.n:
            return np.zeros(0, np.int64)
        high = np.flatnonzero(np.unpackbits(self.upper, bitorder="little"))[: self.n] - np.arange(self.n)
        out = high.astype(np.int64) << self.low_bits
        if self.low_bits:
            bits = np.unpackbits(self.low, bitorder="little", count=self.n * self.low_bits).reshape(self.n, self.low_bits)
            out |= bits.astype(np.int64) @ (np.int64(1) << np.arange(self.low_bits, dtype=np.int64))
        return out
