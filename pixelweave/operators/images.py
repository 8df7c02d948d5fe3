"""Decoded images to standardised tensors, and augmentation of tensors.

Images differ in size, so this is the one place where Python handles one row at a time;
each row is a few NumPy calls on a view of the Arrow buffer.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from pixelweave import fixed
from pixelweave.functions.arrow import FLOAT, MAX_BLOCK_BYTES, block_of, column_of
from pixelweave.functions.storage import Storage
from pixelweave.functions.tensors import Shape, bilinear, look_up, pixel_table, swap_channels

Decoder = Callable[[bytes], "np.ndarray | None"]


def three_channels(pixels: np.ndarray) -> np.ndarray:
    """Grey is repeated, a fourth (alpha) channel is dropped."""
    if pixels.ndim == 2:
        pixels = pixels[..., None]
    return np.repeat(pixels, 3, axis=-1) if pixels.shape[-1] == 1 else pixels[..., :3]


def resized_pixels(bgr: np.ndarray, h: int, w: int) -> np.ndarray:
    """8-bit RGB pixels of the target size, rounded to whole levels."""
    resized = bilinear(three_channels(bgr), h, w) + 0.5
    return swap_channels(resized.astype(np.uint8))


def _struct_pixels(images: pa.StructArray) -> Iterator[np.ndarray | None]:
    heights, widths, channels = (
        images.field(f).fill_null(-1).to_numpy(zero_copy_only=False)
        for f in ("height", "width", "nChannels")
    )
    for i, data in enumerate(images.field("data")):
        raw = data.as_buffer()
        shape = (heights[i], widths[i], channels[i])
        valid = raw is not None and shape[0] > 0 and raw.size == shape[0] * shape[1] * shape[2]
        yield np.frombuffer(raw, np.uint8).reshape(shape) if valid else None


def _decoded(content: bytes | None, decode: Decoder) -> np.ndarray | None:
    if content is None:
        return None
    try:
        return decode(content)
    except ImportError:
        raise
    except Exception:  # a file that cannot be decoded is a dropped row
        return None


def _content_pixels(contents: pa.Array, decode: Decoder) -> Iterator[np.ndarray | None]:
    for content in contents:
        yield _decoded(content.as_py(), decode)


def _file_pixels(paths: pa.Array, decode: Decoder) -> Iterator[np.ndarray | None]:
    storage = Storage()
    for path in paths.to_pylist():
        content, _ = storage.read(path)
        yield _decoded(content, decode)


def _image_rows(
    df: DataFrame,
    column: str,
    decoded: Callable[[pa.Array], Iterator[np.ndarray | None]],
    h: int,
    w: int,
    finish: Callable[[np.ndarray], np.ndarray],
    output: str,
    keep_input: bool = False,
) -> DataFrame:
    keep = [c for c in df.columns if c != column or keep_input]
    flush_at = max(1, MAX_BLOCK_BYTES // (h * w * 3 * FLOAT.itemsize))

    def transform(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, blocks = [], []

            def ready() -> pa.RecordBatch:
                kept = batch.select(keep).take(pa.array(rows, pa.int64()))
                done = column_of(finish(np.stack(blocks)))
                return pa.RecordBatch.from_arrays([*kept.columns, done], [*keep, output])

            for i, image in enumerate(decoded(batch.column(column))):
                if image is None or image.size == 0:
                    continue
                rows.append(i)
                blocks.append(resized_pixels(image, h, w))
                if len(rows) == flush_at:
                    yield ready()
                    rows, blocks = [], []
            if rows:
                yield ready()

    schema = df.select(*keep).schema.add(output, "binary")
    return df.mapInArrow(transform, schema)


def _standardiser(mean: Sequence[float], std: Sequence[float]):
    table = pixel_table(mean, std)
    return lambda pixels: look_up(pixels, table)


def image_to_pixels(
    df: DataFrame,
    h: int = fixed.IMAGE_SHAPE[0],
    w: int = fixed.IMAGE_SHAPE[1],
    image: str = "image",
) -> DataFrame:
    """Replace the image struct by resized 8-bit RGB ``pixels``.

    They are a quarter of the size of the tensor and hold the same information; apply
    ``standardize_pixels`` where the tensor is needed.
    """
    return _image_rows(df, image, _struct_pixels, h, w, lambda p: p, "pixels")


def image_to_tensor(
    df: DataFrame,
    h: int = fixed.IMAGE_SHAPE[0],
    w: int = fixed.IMAGE_SHAPE[1],
    mean: Sequence[float] = fixed.CHANNEL_MEAN,
    std: Sequence[float] = fixed.CHANNEL_STD,
    image: str = "image",
) -> DataFrame:
    """Replace the image struct by a ``tensor`` column; undecodable rows are dropped."""
    return _image_rows(df, image, _struct_pixels, h, w, _standardiser(mean, std), "tensor")


def content_to_tensor(
    df: DataFrame,
    h: int = fixed.IMAGE_SHAPE[0],
    w: int = fixed.IMAGE_SHAPE[1],
    mean: Sequence[float] = fixed.CHANNEL_MEAN,
    std: Sequence[float] = fixed.CHANNEL_STD,
    content: str = "content",
    *,
    decode: Decoder,
) -> DataFrame:
    """Like ``image_to_tensor`` for encoded files packed in a Parquet column.

    Rows can be filtered before anything is decoded, and no small files are listed.
    ``decode`` turns file bytes into BGR pixels (H, W, C).
    """
    return _image_rows(
        df, content, lambda c: _content_pixels(c, decode), h, w, _standardiser(mean, std), "tensor"
    )


def path_to_tensor(
    df: DataFrame,
    h: int = fixed.IMAGE_SHAPE[0],
    w: int = fixed.IMAGE_SHAPE[1],
    mean: Sequence[float] = fixed.CHANNEL_MEAN,
    std: Sequence[float] = fixed.CHANNEL_STD,
    path: str = "path",
    *,
    decode: Decoder,
) -> DataFrame:
    """Add the tensor of the image file each row names; missing files are dropped.

    Only narrow rows are filtered, numbered and shuffled before this step, and pixels are
    never shuffled at all. The files must be reachable by all executors.
    """
    return _image_rows(
        df,
        path,
        lambda p: _file_pixels(p, decode),
        h,
        w,
        _standardiser(mean, std),
        "tensor",
        keep_input=True,
    )


def uniform(seed: int, epoch: Column, key: Column, use: str) -> Column:
    """Pseudo-random number in [0, 1) from seed, epoch, row key and purpose."""
    text = F.concat_ws("-", F.lit(str(seed)), epoch.cast("string"), key.cast("string"), F.lit(use))
    head = F.substring(F.md5(text.cast("binary")), 1, 8)
    return F.conv(head, 16, 10).cast("double") / F.lit(float(1 << 32))


def augment(
    df: DataFrame,
    shape: Shape,
    key: str,
    seed: int,
    epoch: str | None = None,
    tensor: str = "tensor",
    brightness: float = 0.2,
    contrast: tuple[float, float] = (0.8, 1.2),
) -> DataFrame:
    """Random horizontal flip, brightness shift and contrast around the channel mean.

    The draw depends only on seed, epoch and key, so a recomputed row is the same row.
    """
    e = F.col(epoch) if epoch else F.lit(0)
    low, high = contrast

    @F.arrow_udf("binary")
    def change(tensors: pa.Array, flips: pa.Array, shifts: pa.Array, gains: pa.Array) -> pa.Array:
        block = block_of(tensors, FLOAT, shape).astype(np.float64)
        flip = flips.to_numpy(zero_copy_only=False)[:, None, None, None]
        block = np.where(flip, block[:, :, ::-1, :], block)
        block = block + shifts.to_numpy()[:, None, None, None]
        centre = block.mean(axis=(1, 2), keepdims=True)
        block = (block - centre) * gains.to_numpy()[:, None, None, None] + centre
        return column_of(block.astype(FLOAT))

    changed = change(
        F.col(tensor),
        uniform(seed, e, F.col(key), "flip") < 0.5,
        (uniform(seed, e, F.col(key), "brightness") * 2.0 - 1.0) * brightness,
        uniform(seed, e, F.col(key), "contrast") * (high - low) + low,
    )
    fits = F.length(tensor) == int(np.prod(shape)) * FLOAT.itemsize
    return df.where(fits).withColumn(tensor, changed)
