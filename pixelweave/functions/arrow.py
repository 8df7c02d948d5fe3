"""Views between Arrow binary columns and NumPy blocks of equal-shaped tensors.

A column of ``n`` tensors of one shape is one contiguous buffer, so a whole Arrow batch
is transformed by a single NumPy call and no Python code runs per row.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Upper bound of the bytes put into one Arrow array; offsets are 32-bit.
MAX_BLOCK_BYTES = 32 << 20

FLOAT = np.dtype("<f4")
PIXEL = np.dtype("u1")


def block_of(column: pa.Array, dtype: np.dtype, shape: tuple[int, ...]) -> np.ndarray:
    """``(n, *shape)`` view of a binary column whose rows all have that size."""
    n = len(column)
    if n == 0:
        return np.empty((0, *shape), dtype)
    offset_type = np.int64 if pa.types.is_large_binary(column.type) else np.int32
    _, offsets, values = column.buffers()
    first = np.frombuffer(offsets, offset_type, count=1, offset=column.offset * offset_type().nbytes)
    count = n * math.prod(shape)
    return np.frombuffer(values, dtype, count=count, offset=int(first[0])).reshape(n, *shape)


def column_of(block: np.ndarray) -> pa.Array:
    """Binary column with one row per entry of the first axis."""
    n = len(block)
    if n == 0:
        return pa.array([], pa.binary())
    flat = np.ascontiguousarray(block)
    width = flat.nbytes // n
    if n * width > np.iinfo(np.int32).max:
        raise ValueError("a block of tensors must stay under 2 GiB")
    offsets = np.arange(n + 1, dtype=np.int32) * np.int32(width)
    return pa.BinaryArray.from_buffers(
        pa.binary(), n, [None, pa.py_buffer(offsets), pa.py_buffer(flat)]
    )


def fitting(column: pa.Array, width: int) -> pa.BooleanArray:
    """Which rows hold exactly ``width`` bytes; null rows do not."""
    return pc.fill_null(pc.equal(pc.binary_length(column), width), False)


def map_block(
    column: pa.Array,
    fn: Callable[[np.ndarray], np.ndarray],
    dtype: np.dtype,
    shape: tuple[int, ...],
) -> pa.Array:
    """Apply ``fn`` to the well-formed rows of a column; the others become null."""
    good = fitting(column, math.prod(shape) * dtype.itemsize)
    if pc.all(good, min_count=0).as_py():
        return column_of(fn(block_of(column, dtype, shape)))
    done = column_of(fn(block_of(column.filter(good), dtype, shape)))
    mask = good.to_numpy(zero_copy_only=False)
    slots = pa.array(np.cumsum(mask) - 1, pa.int64(), mask=~mask)
    return done.take(slots)
