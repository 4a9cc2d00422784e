"""Words and their hashes for whole Arrow batches, without a Python loop over words.

A word is a maximal run of bytes outside space and 0x09-0x0D, so UTF-8 letters are never split.
Texts are handled in blocks of about ``BLOCK_BYTES``; a longer text is a block of its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK_BYTES = 500_000
#: Powers kept for texts up to this size.
POWERS = 600_000
WORD_BASE = np.uint64(0x9E3779B97F4A7C15)
WINDOW_BASE = np.uint64(0xD6E8FEB86659FD93)


@cache
def _byte_values(lower: bool) -> np.ndarray:
    """A fixed 64-bit value per byte; zero for white space, equal for A-Z and a-z if ``lower``."""
    values = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xA24BAED4963EE407))
    if lower:
        values[65:91] = values[97:123]
    values[_spaces()] = 0
    return values


@cache
def _spaces() -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    table[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
    return table


def _powers(base: np.uint64, count: int) -> np.ndarray:
    out = np.full(max(count, 1), base, dtype=np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


@cache
def _block_powers() -> tuple[np.ndarray, np.ndarray]:
    return _powers(WORD_BASE, POWERS), _powers(inverse(WORD_BASE), POWERS)


def inverse(odd: np.uint64) -> np.uint64:
    return np.uint64(pow(int(odd), -1, 1 << 64))


def mix64(x: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit values; a bijection."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x7FB5D329728EA185)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


@dataclass
class Block:
    """Words of consecutive texts: ``bounds[i]:bounds[i + 1]`` are the words of row ``first + i``."""

    first: int
    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    bounds: np.ndarray

    @property
    def rows(self) -> np.ndarray:
        """Row of the block that each word belongs to."""
        return np.repeat(np.arange(len(self.bounds) - 1), np.diff(self.bounds))


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    width = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, dtype=width)[column.offset : column.offset + len(column) + 1] if offsets else np.zeros(1, width)
    return (np.frombuffer(data, dtype=np.uint8) if data else np.zeros(0, np.uint8)), offsets.astype(np.int64)


def text_blocks(offsets: np.ndarray, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows whose texts come to about ``limit`` bytes, one row at least."""
    row, rows = 0, len(offsets) - 1
    while row < rows:
        stop = max(row + 1, int(np.searchsorted(offsets, offsets[row] + limit, side="right")) - 1)
        yield row, min(stop, rows)
        row = stop


def word_blocks(column: pa.Array, lower: bool) -> Iterator[Block]:
    data, offsets = text_buffers(column)
    for first, stop in text_blocks(offsets):
        low, high = offsets[first], offsets[stop]
        yield words_of(data[low:high], offsets[first : stop + 1] - low, lower, first)


def words_of(data: np.ndarray, offsets: np.ndarray, lower: bool, first: int = 0) -> Block:
    size = len(data)
    solid = ~_spaces()[data]
    begins = np.zeros(size + 1, dtype=bool)
    begins[offsets] = True
    start = solid.copy()
    start[1:] &= ~solid[:-1] | begins[1:size]
    end = solid.copy()
    end[:-1] &= ~solid[1:] | begins[1:size]
    starts, ends = np.flatnonzero(start), np.flatnonzero(end) + 1
    if size <= POWERS:
        up, down = _block_powers()
    else:
        up, down = _powers(WORD_BASE, size), _powers(inverse(WORD_BASE), size)
    if len(starts):
        sums = np.add.reduceat(_byte_values(lower)[data] * up[:size], starts)
        hashes = mix64(sums * down[starts] + (ends - starts).astype(np.uint64))
    else:
        hashes = np.zeros(0, dtype=np.uint64)
    return Block(first, data, starts, ends, hashes, np.searchsorted(starts, offsets))


@cache
def _any_byte() -> np.ndarray:
    return mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xA24BAED4963EE407))


def span_hashes(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of ``data``; a span ends where the next one starts."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    size = len(data)
    up, down = _block_powers() if size <= POWERS else (_powers(WORD_BASE, size), _powers(inverse(WORD_BASE), size))
    sums = np.add.reduceat(_any_byte()[data] * up[:size], starts)
    return mix64(sums * down[starts] + np.diff(starts, append=size).astype(np.uint64))


def window_hashes(block: Block, size: int) -> tuple[np.ndarray, np.ndarray]:
    """First word and hash of each window of ``size`` words inside one text."""
    count = len(block.hashes) - size + 1
    if count <= 0:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
    rows = block.rows
    at = np.flatnonzero(rows[:count] == rows[size - 1 :])
    total = np.zeros(count, dtype=np.uint64)
    for j in range(size):
        total = total * WINDOW_BASE + block.hashes[j : j + count]
    return at, mix64(total[at])
