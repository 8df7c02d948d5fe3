"""The line field against enumeration of all labellings, and its accuracy on held-out rows."""

import itertools

import numpy as np
import pytest
from conftest import MEDIUM
from pyspark.sql import functions as F

from pixelweave.llm import quality
from pixelweave.llm.registered import op1_line_field


def enumerated(emission, step):
    """Marginals and summed pair marginals of one chain by all its labellings."""
    n = len(emission)
    marginal, pairs, total = np.zeros((n, 2)), np.zeros((2, 2)), 0.0
    for labels in itertools.product((0, 1), repeat=n):
        p = np.exp(sum(emission[t][y] for t, y in enumerate(labels)) + sum(step[a][b] for a, b in zip(labels, labels[1:])))
        total += p
        for t, y in enumerate(labels):
            marginal[t, y] += p
        for a, b in zip(labels, labels[1:]):
            pairs[a, b] += p
    return marginal / total, pairs / total


def test_forward_backward():
    rng = np.random.default_rng(0)
    lengths = np.array([6, 4, 4, 1])
    emission, step = rng.normal(size=(4, 6, 2)), rng.normal(size=(2, 2))
    marginal, pairs = quality.forward_backward(emission, lengths, step)
    want = np.zeros((2, 2))
    for chain, n, got in zip(emission, lengths, marginal):
        m, p = enumerated(chain[:n], step)
        assert np.allclose(got[:n], m)
        want += p
    assert np.allclose(pairs, want)


@pytest.mark.parametrize("text", ["", "one line.", "a b c\n\nd e f\na b c", "x\n" * 5])
def test_score_is_the_weighted_mean_of_marginals(text):
    rng = np.random.default_rng(1)
    field = quality.Field(rng.normal(size=quality.N_FEATURES), rng.normal(size=(2, 2)))
    features, lengths = quality.line_features(text)
    emission = np.stack([np.zeros(len(features)), features @ field.weights], 1)
    marginal, _ = enumerated(emission, field.step)
    assert field.score(text) == pytest.approx(marginal[:, 1] @ lengths / lengths.sum())


def test_features_see_neighbours():
    features, _ = quality.line_features("alpha beta gamma delta.\n### $$$ ###\nalpha beta gamma delta.")
    n = quality._OWN
    assert (features[0, 2 * n : 3 * n] == features[1, :n]).all() and (features[2, n : 2 * n] == features[1, :n]).all()
    assert features[2, 10] == 1 and features[0, 10] == 0


def test_held_out_accuracy(spark):
    labels = spark.read.parquet(f"{MEDIUM}/labels.parquet").select("doc_id", "quality")
    got = op1_line_field(spark, MEDIUM)
    assert got.count() == spark.read.parquet(f"{MEDIUM}/documents.parquet").count()
    rows = got.join(labels, "doc_id").where("held_out").collect()
    assert len(rows) > 50
    assert sum(r["predicted"] == r["quality"] for r in rows) >= 0.95 * len(rows)
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_held_out_labels_do_not_matter(spark, tmp_path):
    """Turning every held-out label around leaves all scores as they are."""
    docs = spark.read.parquet(f"{MEDIUM}/documents.parquet").limit(300)
    labels = spark.read.parquet(f"{MEDIUM}/labels.parquet")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    for name, quality_ in (("a", F.col("quality")), ("b", F.when(held, 1 - F.col("quality")).otherwise(F.col("quality")))):
        docs.write.parquet(f"{tmp_path}/{name}/documents.parquet")
        labels.withColumn("quality", quality_).write.parquet(f"{tmp_path}/{name}/labels.parquet")
    a, b = (sorted(map(tuple, op1_line_field(spark, f"{tmp_path}/{n}").collect())) for n in "ab")
    assert a == b


@pytest.mark.parametrize("labels", [[], [(1, 1)], [(1, 1), (2, 0)], [(1, None), (None, 0), (2, 0), (2, 0), (9, 1)]])
def test_edges(spark, labels):
    rows = [(1, "good text here.", 1), (2, None, 1), (2, "", 1), (None, "x\n" * 3000, 1), (3, "y " * 50_000, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score int")
    known = spark.createDataFrame([(*r, 0) for r in labels], "doc_id long, quality int, toxic int")
    field = quality.learn(docs, known)
    got = docs.withColumn("score", quality.scored(field, F.col("text"))).collect()
    assert len(got) == 5 and all(0 <= r["score"] <= 1 for r in got)
    assert quality.learn(docs.limit(0), known).weights is None


def test_sample_is_bounded(spark, monkeypatch):
    """A key of many rows teaches as one document, a text of many lines by a run of them."""
    rows = [(1, f"shared key {i}\nline two.") for i in range(400)] + [(1, "same row")] * 400
    rows += [(i, f"own key {i}\nline two.") for i in range(2, 40)] + [(40, "".join(f"line {i}\n" for i in range(20_000)))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    known = spark.createDataFrame([(i, i % 2) for i in range(1, 41)], "doc_id long, quality int")
    taught = []
    monkeypatch.setattr(quality, "fit", lambda documents, labels: taught.append((documents, labels)))
    for _ in range(2):
        quality.learn(docs, known, lines=300)
    (documents, labels), again = taught
    assert len(documents) == 40 and sorted(labels) == [0] * 20 + [1] * 20
    assert sorted(map(len, documents))[-2:] == [2, 300]
    assert all((a == b).all() for a, b in zip(documents, again[0]))
    quality.learn(docs, known, per_label=5)
    assert sorted(taught[2][1]) == [0] * 5 + [1] * 5


def test_hot_key_does_not_decide_the_fit(spark):
    rng = np.random.default_rng(6)
    good = [" ".join(f"word{j}" for j in rng.integers(0, 900, 30)) + "." for _ in range(60)]
    rows = [(i, good[i]) for i in range(30)] + [(i, "### $$$ ### $$$") for i in range(30, 60)]
    labels = [(i, int(i < 30)) for i in range(60)] + [(99, 0)]
    hot = [(99, text) for text in good[30:] * 20]
    known = spark.createDataFrame(labels, "doc_id long, quality int")
    field = quality.learn(spark.createDataFrame(rows + hot, "doc_id long, text string"), known)
    assert np.mean([field.score(text) for text in good[:30]]) > 0.9
