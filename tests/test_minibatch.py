"""Minibatch fits against a plain NumPy run: weights, history, resumed fits, search."""

import numpy as np
import pytest

from pixelweave.learning import minibatch
from pixelweave.learning.minibatch import Candidate

K, D = 3, 5


def rows_of(n, seed=0, noise=0.6):
    rng = np.random.default_rng(seed)
    y = rng.integers(0, K, n)
    x = (rng.normal(0, noise, (n, D)) + 1.5 * np.eye(K, D)[y]).astype("<f4")
    return x, y.astype(int)


def stored(spark, x, y, size, parts=3, weight=None):
    order = np.random.default_rng(1).permutation(len(x))
    rows = [(int(i), x[i].tobytes(), int(y[i]), float(weight[i]) if weight is not None else 1.0) for i in order]
    df = spark.createDataFrame(rows, "pos long, tensor binary, label_idx int, w double").repartition(parts)
    return minibatch.minibatches(df, "pos", size, weight="w")


def slow(x, y, size, epochs, rate, penalty=0.0, weight=None):
    """Adam on softmax regression, row by row order."""
    x, weight = np.c_[x.astype(float), np.ones(len(x))], np.ones(len(x)) if weight is None else weight
    w, m, v, t, history = np.zeros((K, D + 1)), 0.0, 0.0, 0, []
    for _ in range(epochs):
        loss = hits = 0.0
        for at in range(0, len(x), size):
            a, b, c = x[at : at + size], y[at : at + size], weight[at : at + size]
            z = a @ w.T
            p = np.exp(z - z.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            loss += -(c * np.log(np.clip(p[np.arange(len(b)), b], 1e-7, 1 - 1e-7))).sum()
            hits += (c * (p.argmax(1) == b)).sum()
            g = ((p - np.eye(K)[b]) * c[:, None]).T @ a / c.sum()
            g[:, :-1] += penalty * w[:, :-1]
            t += 1
            m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
            w = w - rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-7)
        history.append((loss / weight.sum(), hits / weight.sum()))
    return w, history


@pytest.mark.parametrize("size, parts", [(7, 1), (7, 5), (32, 3), (1000, 4)])
def test_equals_numpy_for_any_partitioning(spark, monkeypatch, size, parts):
    monkeypatch.setattr(minibatch, "_FILE_BYTES", 1000)
    x, y = rows_of(60)
    state = minibatch.fit(stored(spark, x, y, size, parts), K, [Candidate(0.05, 0.01)], epochs=2)
    want, history = slow(x, y, size, 2, 0.05, 0.01)
    assert np.allclose(state.weights[0], want, atol=1e-12)
    assert np.allclose([(h["loss"], h["accuracy"]) for h in state.history], history)


def test_weighted_rows_and_a_tree_of_sums(spark, monkeypatch):
    monkeypatch.setattr(minibatch, "_FILE_BYTES", 200)
    monkeypatch.setattr(minibatch, "_FAN", 2)
    x, y = rows_of(40)
    weight = np.where(y == 0, 3.0, 0.5)
    data = stored(spark, x, y, 1000, weight=weight)
    monkeypatch.setattr(minibatch, "_FILE_BYTES", 64 << 20)
    state = minibatch.fit(data, K, [Candidate(0.1)], epochs=2)
    assert np.allclose(state.weights[0], slow(x, y, 1000, 2, 0.1, weight=weight)[0], atol=1e-12)


def test_resumed_equals_uninterrupted(spark, tmp_path):
    x, y = rows_of(50)
    data, held = stored(spark, x, y, 16), stored(spark, *rows_of(30, 5), 16)
    grid, table = [Candidate(0.05), Candidate(0.2, 0.1)], str(tmp_path / "state")
    whole = minibatch.fit(data, K, grid, epochs=4, validation=held, seed=3)
    minibatch.fit(data, K, grid, epochs=2, validation=held, seed=3, state_table=table)
    resumed = minibatch.fit(data, K, grid, epochs=4, validation=held, seed=3, state_table=table)
    for name in ("weights", "first", "second", "best", "best_epoch", "best_score"):
        assert (getattr(whole, name) == getattr(resumed, name)).all()
    assert whole.history == resumed.history and [h["epoch"] for h in whole.history] == [1, 1, 2, 2, 3, 3, 4, 4]
    assert minibatch.history(spark, resumed).count() == 8
    with pytest.raises(ValueError):
        minibatch.fit(data, K, grid[:1], epochs=5, state_table=table)


def test_search_finds_what_single_fits_find(spark):
    x, y = rows_of(80, noise=1.2)
    data, held = stored(spark, x, y, 40), stored(spark, *rows_of(40, 9, 1.2), 40)
    grid = [Candidate(r, p) for r in (0.001, 0.3) for p in (0.0, 1.0)]
    together = minibatch.fit(data, K, grid, epochs=3, validation=held)
    alone = [minibatch.fit(data, K, [c], epochs=3, validation=held) for c in grid]
    for i, one in enumerate(alone):
        assert np.allclose(together.best[i], one.best[0], atol=1e-12)
        assert together.best_epoch[i] == one.best_epoch[0]
    assert together.winner() == max(range(4), key=lambda i: alone[i].best_score[0])
    halved = minibatch.fit(data, K, grid, epochs=3, validation=held, halve_after=(1, 2))
    assert [sum(h["epoch"] == e for h in halved.history) for e in (1, 2, 3)] == [4, 2, 1]


def test_early_stop_keeps_the_best_epoch(spark):
    x, y = rows_of(40)
    held = stored(spark, x, (y + 1) % K, 40)
    state = minibatch.fit(stored(spark, x, y, 40), K, [Candidate(0.5)], epochs=9, validation=held, patience=2)
    scores = [h["val_accuracy"] for h in state.history]
    assert state.epoch == state.best_epoch[0] + 2 < 9
    assert scores[state.best_epoch[0] - 1] == max(scores)


def test_bad_rows_and_empty_tables(spark):
    x, y = rows_of(6)
    empty = minibatch.minibatches(
        spark.createDataFrame([], "pos long, tensor binary, label_idx int"), "pos", 4)
    assert minibatch.fit(empty, K, epochs=2).history == []
    for bad in ([(0, b"1234", 0), (1, b"12345678", 0)], [(0, b"12345", 0)]):
        with pytest.raises(ValueError):
            minibatch.minibatches(spark.createDataFrame(bad, "pos long, tensor binary, label_idx int"), "pos", 4)
    for label in (None, K, -1):
        rows = [(0, x[0].tobytes(), label)]
        with pytest.raises(Exception):
            minibatch.fit(minibatch.minibatches(
                spark.createDataFrame(rows, "pos long, tensor binary, label_idx int"), "pos", 4), K, epochs=1)
