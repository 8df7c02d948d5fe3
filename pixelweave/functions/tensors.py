"""Tensor functions on a ``binary`` column of little-endian float32 HWC values.

Each function returns a Column. The Arrow forms work on whole batches; the ``*_expr``
forms are plain Spark expressions on arrays, for short vectors and as a cross-check.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, functions as F

from pixelweave import fixed
from pixelweave.functions.arrow import (
    FLOAT,
    MAX_BLOCK_BYTES,
    PIXEL,
    block_of,
    fitting,
    map_block,
)

Shape = tuple[int, int, int]


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _blockwise(fn: Callable[[np.ndarray], np.ndarray], shape: Shape) -> Callable:
    def apply(column: pa.Array) -> pa.Array:
        return map_block(column, fn, FLOAT, shape)

    apply.__annotations__ = {"column": pa.Array, "return": pa.Array}
    return F.arrow_udf(apply, "binary")


def _in_pieces(
    kernel: Callable[[np.ndarray], np.ndarray], dtype: np.dtype, shape: Shape, out_values: int
) -> Callable:
    """Like ``_blockwise`` where output outgrows input: a batch leaves in bounded pieces."""
    step = max(1, MAX_BLOCK_BYTES // (out_values * FLOAT.itemsize))

    def apply(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in columns:
            for at in range(0, len(column), step):
                yield map_block(column.slice(at, step), kernel, dtype, shape)

    apply.__annotations__ = {"columns": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(apply, "binary")


# --- NumPy kernels, shared with the image operator -------------------------------------


def swap_channels(block: np.ndarray) -> np.ndarray:
    """Reverse the channel axis, which is last."""
    return block[..., ::-1]


def axis_taps(n_in: int, n_out: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lower tap, upper tap and upper weight of every output position of one axis.

    Pixel centres lie at half integers and taps are clamped to the edge.
    """
    centre = (np.arange(n_out) + 0.5) * n_in / n_out - 0.5
    low = np.floor(centre)
    weight = centre - low
    low = low.astype(np.int64)
    return np.clip(low, 0, n_in - 1), np.clip(low + 1, 0, n_in - 1), weight


def bilinear(block: np.ndarray, h: int, w: int) -> np.ndarray:
    """Resize ``(..., H, W, C)`` to ``(..., h, w, C)``; the aspect ratio may change."""
    height, width = block.shape[-3:-1]
    if (height, width) == (h, w):
        return block.astype(np.float64)
    channels = block.shape[-1]
    y0, y1, wy = axis_taps(height, h)
    x0, x1, wx = axis_taps(width, w)
    # One pixel row is one flat run of values, which NumPy gathers much faster than pixels.
    lines = block.reshape(*block.shape[:-2], width * channels)
    offset = np.arange(channels)
    left, right = ((x[:, None] * channels + offset).ravel() for x in (x0, x1))
    # 8-bit pixels and their weights fit float32; tensors are blended in float64.
    work = np.float32 if block.dtype == np.uint8 else np.float64
    u, v = np.repeat(wx, channels).astype(work), wy[:, None].astype(work)

    def across(rows: np.ndarray) -> np.ndarray:
        picked = lines[..., rows, :]
        return picked[..., left] * (1.0 - u) + picked[..., right] * u

    resized = across(y0) * (1.0 - v) + across(y1) * v
    return resized.reshape(*block.shape[:-3], h, w, channels)


def normalise(block: np.ndarray, mean: Sequence[float], std: Sequence[float]) -> np.ndarray:
    """Per-channel ``(x - mean) / std``."""
    return (block - np.asarray(mean)) / np.asarray(std)


def pixel_table(mean: Sequence[float], std: Sequence[float]) -> np.ndarray:
    """Standardised value of each 8-bit level, one row per channel in R, G, B order."""
    levels = np.arange(int(fixed.PIXEL_MAX) + 1) / fixed.PIXEL_MAX
    return normalise(levels[:, None], mean, std).astype(FLOAT).T


def look_up(pixels: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Standardised tensor of 8-bit RGB pixels."""
    rows = np.arange(len(table)) * table.shape[1]
    return table.ravel()[pixels.astype(np.intp) + rows]


# --- Arrow forms -----------------------------------------------------------------------


def to_bytes(c: Column | str) -> Column:
    """``array<float>`` to tensor bytes."""

    @F.arrow_udf("binary")
    def pack(column: pa.Array) -> pa.Array:
        sizes = np.where(
            column.is_valid().to_numpy(zero_copy_only=False),
            np.diff(column.offsets.to_numpy()),
            0,
        )
        values = column.flatten().to_numpy(zero_copy_only=False).astype(FLOAT, copy=False)
        offsets = np.concatenate([[0], np.cumsum(sizes * FLOAT.itemsize)]).astype(np.int32)
        packed = pa.BinaryArray.from_buffers(
            pa.binary(),
            len(column),
            [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(values))],
        )
        if column.null_count:
            slots = np.arange(len(column))
            return packed.take(pa.array(slots, mask=column.is_null().to_numpy(zero_copy_only=False)))
        return packed

    return pack(_col(c).cast("array<float>"))


def from_bytes(c: Column | str, shape: Shape) -> Column:
    """Tensor bytes to ``array<float>``; null where the length does not fit the shape."""
    size = int(np.prod(shape))

    @F.arrow_udf("array<float>")
    def unpack(column: pa.Array) -> pa.Array:
        good = fitting(column, size * FLOAT.itemsize)
        values = block_of(column.filter(good), FLOAT, (size,)).reshape(-1)
        mask = good.to_numpy(zero_copy_only=False)
        offsets = np.concatenate([[0], np.cumsum(mask * size)]).astype(np.int32)
        return pa.ListArray.from_arrays(
            pa.array(offsets), pa.array(values), mask=pc.invert(good)
        )

    return unpack(_col(c))


def payload_fits(c: Column | str, shape: Shape) -> Column:
    """True where the payload has exactly the bytes of one tensor."""
    return F.length(_col(c)) == int(np.prod(shape)) * FLOAT.itemsize


def bgr_to_rgb(c: Column | str, shape: Shape) -> Column:
    """Reverse the channel order of every pixel."""
    return _blockwise(swap_channels, shape)(_col(c))


def scale01(c: Column | str, shape: Shape) -> Column:
    """Map the pixel range to [0, 1]."""
    return _blockwise(lambda b: (b / FLOAT.type(fixed.PIXEL_MAX)).astype(FLOAT), shape)(_col(c))


def standardize(
    c: Column | str,
    shape: Shape,
    mean: Sequence[float] = fixed.CHANNEL_MEAN,
    std: Sequence[float] = fixed.CHANNEL_STD,
) -> Column:
    """Per-channel ``(x - mean) / std``."""
    return _blockwise(lambda b: normalise(b, mean, std).astype(FLOAT), shape)(_col(c))


def resize(c: Column | str, shape: Shape, h: int, w: int) -> Column:
    """Bilinear resize to ``h`` x ``w``."""
    return _in_pieces(
        lambda block: bilinear(block, h, w).astype(FLOAT), FLOAT, shape, h * w * shape[2]
    )(_col(c))


def standardize_pixels(
    c: Column | str,
    shape: Shape,
    mean: Sequence[float] = fixed.CHANNEL_MEAN,
    std: Sequence[float] = fixed.CHANNEL_STD,
) -> Column:
    """Tensor of 8-bit RGB pixels, which take a quarter of the storage of the tensor."""
    table = pixel_table(mean, std)
    return _in_pieces(
        lambda block: look_up(block, table), PIXEL, shape, int(np.prod(shape))
    )(_col(c))


def as_float32(c: Column | str, array: bool = False) -> Column:
    """Cast a number, or an array of numbers, to float32."""
    return _col(c).cast("array<float>" if array else "float")


# --- Expression forms on arrays --------------------------------------------------------


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once per row, not once per array element."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def bgr_to_rgb_expr(a: Column | str, channels: int = 3) -> Column:
    """Channel reversal of an HWC array."""
    last = F.lit(channels - 1)
    return _once(
        _col(a),
        lambda arr: F.transform(arr, lambda _, i: F.get(arr, i - i % channels + (last - i % channels))),
    )


def scale01_expr(a: Column | str) -> Column:
    """Division by the pixel range."""
    return F.transform(_col(a), lambda x: x / F.lit(fixed.PIXEL_MAX))


def standardize_expr(
    a: Column | str,
    mean: Sequence[float] = fixed.CHANNEL_MEAN,
    std: Sequence[float] = fixed.CHANNEL_STD,
) -> Column:
    """Per-channel ``(x - mean) / std`` of an HWC array, in double precision."""
    means = F.lit([float(m) for m in mean])
    stds = F.lit([float(s) for s in std])
    k = len(mean)
    return F.transform(
        _col(a),
        lambda x, i: (x.cast("double") - F.get(means, i % k)) / F.get(stds, i % k),
    )


def _number_array(values: np.ndarray, kind: str) -> Column:
    """Array literal in one piece; Spark folds the cast away while planning."""
    return F.split(F.lit(",".join(map(repr, values.tolist()))), ",").cast(f"array<{kind}>")


def resize_expr(a: Column | str, shape: Shape, h: int, w: int) -> Column:
    """Bilinear resize of an HWC array, in double precision; taps are literals."""
    height, width, channels = shape
    y0, y1, wy = axis_taps(height, h)
    x0, x1, wx = axis_taps(width, w)
    row, column, channel = np.unravel_index(np.arange(h * w * channels), (h, w, channels))

    def corner(y: np.ndarray, x: np.ndarray) -> Column:
        return _number_array((y[row] * width + x[column]) * channels + channel, "int")

    corners = [corner(y, x) for y in (y0, y1) for x in (x0, x1)]
    across, down = _number_array(wx[column], "double"), _number_array(wy[row], "double")

    def pixel(arr: Column, i: Column) -> Column:
        top_left, top_right, low_left, low_right = (F.get(arr, F.get(c, i)) for c in corners)
        u, v = F.get(across, i), F.get(down, i)
        top = top_left * (1.0 - u) + top_right * u
        low = low_left * (1.0 - u) + low_right * u
        return top * (1.0 - v) + low * v

    every = F.sequence(F.lit(0), F.lit(h * w * channels - 1))
    return _once(
        _col(a).cast("array<double>"), lambda arr: F.transform(every, lambda i: pixel(arr, i))
    )
