"""Exact top-k against all products."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from pixelweave.llm import inner_product

SCHEMA = "vec_id long, embedding array<float>, score string, rank int"


def expected(rows, k, every):
    whole = {}
    for key, vector in rows:
        if key is not None and vector is not None and all(x is not None and np.isfinite(x) for x in vector):
            whole[key] = [int(np.floor(256 * float(np.float32(x)))) for x in vector]
    out = []
    for q in whole:
        if q % every == 0:
            scores = sorted((-sum(a * b for a, b in zip(whole[q], v)), i) for i, v in whole.items() if i != q)
            out += [(q, rank, i, -s) for rank, (s, i) in enumerate(scores[:k], 1)]
    return sorted(out)


def run(spark, rows, k=5, every=10):
    frame = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], SCHEMA)
    return sorted(map(tuple, inner_product.top_k(frame, F.col("vec_id") % every == 0, k=k).collect()))


@pytest.mark.parametrize("block, query_block", [(4096, 1024), (16, 3)])
@pytest.mark.parametrize("kind", ["normal", "sizes", "ties", "few"])
def test_random(spark, monkeypatch, block, query_block, kind):
    monkeypatch.setattr(inner_product, "BLOCK", block)
    monkeypatch.setattr(inner_product, "QUERY_BLOCK", query_block)
    monkeypatch.setattr(inner_product, "STEP", 8)
    rng = np.random.default_rng(4)
    n = 3 if kind == "few" else 150
    vectors = rng.normal(size=(n, 24))
    if kind == "sizes":
        vectors *= rng.exponential(3, (n, 1))
    if kind == "ties":
        vectors = np.repeat(vectors[: n // 10], 10, axis=0)
    rows = [(i, [float(np.float32(x)) for x in v]) for i, v in enumerate(vectors)]
    assert run(spark, rows) == expected(rows, 5, 10)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 2.0]), (1, None), (2, [nan, 1.0]), (3, [inf, 0.0]), (4, [None, 1.0]), (5, [0.5, -0.25]),
        (6, []), (7, [1.0]), (8, [-1.0, -2.0, 3.0]), (None, [9.0, 9.0]), (10, [0.0, 0.0]), (20, [1.0, 2.0]),
    ]
    assert run(spark, rows, k=3) == expected(rows, 3, 10)
    assert run(spark, []) == []
    assert run(spark, [(0, [1.0])]) == []


@pytest.mark.parametrize("size", [1e5, 1e9, 1e18, 3e38])
def test_large_components(spark, size):
    """Exact ranks beyond 64 bits; scores there are cut to 64 bits."""
    rng = np.random.default_rng(7)
    rows = [(i, [float(np.float32(x)) for x in v]) for i, v in enumerate(rng.normal(size=(40, 6)))]
    rows += [(40 + i, [float(np.float32(x * size)) for x in rng.uniform(-1, 1, 6)]) for i in range(8)]
    rows += [(60, [float(np.float32(size)), 1.0]), (61, [float(np.float32(size)), 2.0]), (62, [1.0])]
    ends = np.iinfo(np.int64)
    want = [(q, r, i, min(max(s, ends.min), ends.max)) for q, r, i, s in expected(rows, 5, 10)]
    assert run(spark, rows) == want
