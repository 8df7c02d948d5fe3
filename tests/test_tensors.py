"""Tensor kernels: properties in NumPy, Arrow forms against expression forms."""

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from pixelweave import fixed
from pixelweave.functions import tensors as T
from pixelweave.functions.arrow import FLOAT, block_of, column_of, map_block
from pixelweave.operators import filters, images

SHAPE = (4, 5, 3)
SIZE = 60
sides = st.integers(1, 12)


@given(sides, sides)
@settings(max_examples=60, deadline=None)
def test_taps_stay_inside(n_in, n_out):
    low, high, weight = T.axis_taps(n_in, n_out)
    assert ((0 <= low) & (low <= high) & (high < n_in)).all()
    assert ((0 <= weight) & (weight < 1)).all()


@given(sides, sides, sides, sides)
@settings(max_examples=40, deadline=None)
def test_constant_image_stays_constant(h, w, out_h, out_w):
    block = np.full((2, h, w, 3), 7.5, FLOAT)
    assert np.allclose(T.bilinear(block, out_h, out_w), 7.5)


def by_hand(image, h, w):
    height, width, channels = image.shape
    out = np.zeros((h, w, channels))
    for y in range(h):
        for x in range(w):
            sy, sx = (y + 0.5) * height / h - 0.5, (x + 0.5) * width / w - 0.5
            y0, x0 = int(np.floor(sy)), int(np.floor(sx))
            fy, fx = sy - y0, sx - x0
            ys = [min(max(v, 0), height - 1) for v in (y0, y0 + 1)]
            xs = [min(max(v, 0), width - 1) for v in (x0, x0 + 1)]
            for i, wy in zip(ys, (1 - fy, fy)):
                for j, wx in zip(xs, (1 - fx, fx)):
                    out[y, x] += wy * wx * image[i, j]
    return out


@given(sides, sides, sides, sides, st.integers(0, 1000))
@settings(max_examples=40, deadline=None)
def test_resize_equals_four_tap_sum(h, w, out_h, out_w, seed):
    image = np.random.default_rng(seed).random((h, w, 3))
    assert np.allclose(T.bilinear(image, out_h, out_w), by_hand(image, out_h, out_w))


def test_same_size_is_identity():
    image = np.random.default_rng(1).random((6, 7, 3)).astype(FLOAT)
    assert (T.bilinear(image, 6, 7) == image).all()


@given(st.integers(0, 9), st.integers(0, 3))
@settings(max_examples=30, deadline=None)
def test_codec_round_trip_on_slices(n, start):
    block = np.random.default_rng(n).random((n, 2, 3)).astype(FLOAT)
    column = column_of(block).slice(min(start, n))
    assert (block_of(column, FLOAT, (2, 3)) == block[min(start, n):]).all()


def test_bad_rows_become_null():
    good = np.ones(6, FLOAT).tobytes()
    column = pa.array([good, None, b"short", good], pa.binary())
    out = map_block(column, lambda b: b * 2, FLOAT, (6,))
    assert [None if v is None else np.frombuffer(v, FLOAT).tolist() for v in out.to_pylist()] == [
        [2.0] * 6, None, None, [2.0] * 6,
    ]


@pytest.fixture(scope="module")
def arrays(spark):
    rng = np.random.default_rng(4)
    rows = [(i, rng.random(SIZE).astype(FLOAT).tolist()) for i in range(40)]
    return spark.createDataFrame(rows, "id int, a array<float>").repartition(3)


def values(df, column):
    return {r["id"]: r["x"] for r in df.select("id", column.alias("x")).collect()}


@pytest.mark.parametrize(
    "bytewise,expression,shape",
    [
        (lambda b: T.bgr_to_rgb(b, SHAPE), T.bgr_to_rgb_expr, SHAPE),
        (lambda b: T.scale01(b, SHAPE), T.scale01_expr, SHAPE),
        (lambda b: T.standardize(b, SHAPE), T.standardize_expr, SHAPE),
        (lambda b: T.resize(b, SHAPE, 7, 2), lambda a: T.resize_expr(a, SHAPE, 7, 2), (7, 2, 3)),
    ],
)
def test_arrow_form_equals_expression_form(arrays, bytewise, expression, shape):
    df = arrays.withColumn("b", T.to_bytes("a"))
    got, want = values(df, T.from_bytes(bytewise(F.col("b")), shape)), values(df, expression("a"))
    for i in want:
        assert np.allclose(got[i], want[i], rtol=1e-6, atol=1e-6)


def test_bytes_round_trip_is_exact(arrays):
    df = arrays.withColumn("b", T.to_bytes("a"))
    assert values(df, T.from_bytes("b", SHAPE)) == values(df, F.col("a"))


def test_nulls_and_short_payloads(spark):
    df = spark.createDataFrame([(0, [1.0, 2.0]), (1, None), (2, [3.0]), (3, [4.0, 5.0])], "id int, a array<float>")
    packed = df.withColumn("b", T.to_bytes("a"))
    assert values(packed, F.length("b")) == {0: 8, 1: None, 2: 4, 3: 8}
    assert values(packed, T.from_bytes("b", (1, 1, 2))) == {0: [1, 2], 1: None, 2: None, 3: [4, 5]}
    assert {r["id"] for r in filters.drop_bad_payload(packed, 1, 1, 2, "b").collect()} == {0, 3}


def test_growing_resize_is_emitted_in_pieces(spark):
    # 200 tensors of 602,112 bytes are about 120 MB, more than one piece may hold.
    df = spark.range(200, numPartitions=1).select(
        "id", T.to_bytes(F.array_repeat(F.col("id").cast("float"), 48)).alias("b")
    )
    big = T.resize("b", (4, 4, 3), 224, 224)
    got = df.select("id", big.alias("t")).agg(F.count("t").alias("n"), F.sum(F.length("t")).alias("bytes")).first()
    assert (got["n"], got["bytes"]) == (200, 200 * 224 * 224 * 3 * 4)


def test_augmentation_is_reproducible(arrays):
    df = arrays.withColumn("tensor", T.to_bytes("a")).select("id", "tensor")
    once = values(images.augment(df, SHAPE, "id", 3), F.col("tensor"))
    again = values(images.augment(df.repartition(5), SHAPE, "id", 3), F.col("tensor"))
    other = values(images.augment(df, SHAPE, "id", 4), F.col("tensor"))
    assert once == again and once != other


def test_augmentation_limits(arrays):
    df = arrays.withColumn("tensor", T.to_bytes("a")).select("id", "a", "tensor")
    rows = images.augment(df, SHAPE, "id", 9).collect()
    for r in rows:
        before = np.array(r["a"], FLOAT).reshape(SHAPE)
        after = np.frombuffer(r["tensor"], FLOAT).reshape(SHAPE)
        shift = after.mean(axis=(0, 1)) - before.mean(axis=(0, 1))
        assert np.allclose(shift, shift[0], atol=1e-5) and abs(shift[0]) <= 0.2 + 1e-5
        gain = after.std(axis=(0, 1)) / before.std(axis=(0, 1))
        assert np.allclose(gain, gain[0], atol=1e-4) and 0.8 - 1e-4 <= gain[0] <= 1.2 + 1e-4


def test_float32_cast(spark):
    row = spark.range(1).select(
        T.as_float32(F.lit(0.1)).alias("x"), T.as_float32(F.array(F.lit(0.1)), array=True).alias("a")
    )
    assert [t for _, t in row.dtypes] == ["float", "array<float>"]


def test_fixed_chunk_bytes():
    assert 50 * int(np.prod(fixed.IMAGE_SHAPE)) * 4 == 30_105_600
