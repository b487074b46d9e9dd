"""The texts of an Arrow batch as arrays of bytes: words, lines and hashes without a Python loop per word.

Work goes through a batch in blocks of about a megabyte, so memory stays bounded however many rows a
batch has; one text is never cut, so a single long text makes one larger block.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator
from typing import TypeVar

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

T = TypeVar("T")
BLOCK_BYTES = 1 << 20
BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so it has an inverse modulo 2**64
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))

_BYTES = np.arange(256)
LOWER = np.where((_BYTES >= 65) & (_BYTES <= 90), _BYTES + 32, _BYTES).astype(np.uint8)
SPACE = np.isin(_BYTES, [9, 10, 11, 12, 13, 32])
# Digits, letters and every byte of a character outside ASCII.
WORD = (_BYTES >= 128) | ((_BYTES >= 48) & (_BYTES <= 57)) | ((_BYTES >= 65) & (_BYTES <= 90)) | (
    (_BYTES >= 97) & (_BYTES <= 122))


def members(characters: bytes) -> np.ndarray:
    """Table of 256 truth values: which bytes are among ``characters``."""
    return np.isin(_BYTES, list(characters))


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of unsigned 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def kept(name: str, make: Callable[[], T]) -> T:
    """A value made once per Python process. Modules of this package may be sent to workers with each task, so it is kept outside them."""
    values = vars(sys).setdefault("lakeops_kept", {})
    if name not in values:
        values[name] = make()
    return values[name]


def _powers(n: int) -> list[np.ndarray]:
    held = kept("powers", lambda: [np.empty(0), np.empty(0)])
    if len(held[0]) < n:
        size = max(n, 2 * BLOCK_BYTES)
        held[:] = [np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(size, b, np.uint64)])) for b in (BASE, INVERSE)]
    return held


class Block:
    """Consecutive texts: ``data`` are their bytes, text i is ``data[bounds[i]:bounds[i + 1]]``."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray):
        self.data, self.bounds = data, bounds
        self._sums: np.ndarray | None = None

    def __len__(self) -> int:
        return len(self.bounds) - 1

    def lowered(self) -> Block:
        """A-Z in lower case, all else as it is."""
        return Block(LOWER[self.data], self.bounds)

    def text(self, i: int) -> bytes:
        return self.data[self.bounds[i]:self.bounds[i + 1]].tobytes()

    def runs(self, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of the maximal runs of bytes in ``table``; no run crosses two texts."""
        inside, n = table[self.data], len(self.data)
        if not n:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        first, last = np.empty(n, bool), np.empty(n, bool)
        first[0] = last[-1] = True
        np.logical_not(inside[:-1], out=first[1:])
        np.logical_not(inside[1:], out=last[:-1])
        inner = self.bounds[(self.bounds > 0) & (self.bounds < n)]
        first[inner] = True
        last[inner - 1] = True
        return np.flatnonzero(inside & first), np.flatnonzero(inside & last) + 1

    def owner(self, positions: np.ndarray) -> np.ndarray:
        """The text that each byte position belongs to."""
        return np.searchsorted(self.bounds, positions, "right") - 1

    def counted(self, flags: np.ndarray) -> np.ndarray:
        """How many bytes of each text are flagged."""
        sums = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
        return sums[self.bounds[1:]] - sums[self.bounds[:-1]]

    def hashes(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """64-bit hash of each byte range; equal bytes have equal hashes in every block."""
        powers, inverse = _powers(len(self.data) + 1)
        if self._sums is None:
            values = (self.data.astype(np.uint64) + np.uint64(1)) * powers[:len(self.data)]
            self._sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)])
        plain = (self._sums[ends] - self._sums[starts]) * inverse[starts]
        return mix(plain + (ends - starts).astype(np.uint64))


def blocks(column: pa.Array, size: int = BLOCK_BYTES) -> Iterator[tuple[int, int, Block]]:
    """(first row, row after the last, block) over a string column; null texts are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if not len(column):
        return
    _, offsets, raw = column.buffers()
    bounds = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.empty(0, np.uint8)
    low = 0
    while low < len(column):
        high = max(low + 1, int(np.searchsorted(bounds, bounds[low] + size, "right")) - 1)
        yield low, high, Block(data[bounds[low]:bounds[high]], bounds[low:high + 1] - bounds[low])
        low = high


def lists(lengths: np.ndarray, values: pa.Array) -> pa.Array:
    """List column whose row i holds the next ``lengths[i]`` values."""
    offsets = np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), values)
