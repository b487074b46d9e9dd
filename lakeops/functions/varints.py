"""Lists of whole numbers as bytes."""

from __future__ import annotations

import numpy as np
import pyarrow as pa


def varints(values: np.ndarray, lengths: np.ndarray) -> pa.Array:
    """Lists of unsigned numbers as bytes, seven bits in each; the last byte of a number has its top bit clear."""
    sizes = np.ones(len(values), np.int64)
    for bits in range(7, 64, 7):
        sizes += values >= np.uint64(1 << bits)
    ends = np.cumsum(sizes)
    data = np.empty(int(ends[-1]) if len(ends) else 0, np.uint8)
    for i in range(int(sizes.max(initial=0))):
        has = sizes > i
        more = (sizes[has] > i + 1).astype(np.uint8) << np.uint8(7)
        data[(ends - sizes)[has] + i] = ((values[has] >> np.uint64(7 * i)) & np.uint64(127)).astype(np.uint8) | more
    offsets = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(lengths)])].astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(lengths), [None, pa.py_buffer(offsets), pa.py_buffer(data)])


def numbers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of ``varints`` and how many each row holds."""
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]] if offsets[-1] > offsets[0] else np.empty(0, np.uint8)
    last = np.flatnonzero(data < 128)
    first = np.concatenate([[0], last[:-1] + 1]) if len(last) else last
    values = np.zeros(len(last), np.uint64)
    for i in range(int((last - first).max(initial=-1)) + 1):
        has = first + i <= last
        values[has] |= (data[(first + i)[has]].astype(np.uint64) & np.uint64(127)) << np.uint64(7 * i)
    return values, np.diff(np.searchsorted(last, offsets - offsets[0]))
