"""Metrics, scoring, model round trip and streams."""

import math

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from pixelweave import plans
from pixelweave.learning import scoring, training
from pixelweave.operators import aggregates as A
from pixelweave.streaming import build


def scored(spark, rows):
    return spark.createDataFrame(rows, "probs array<double>, y int")


def test_ties_go_to_the_lowest_index(spark):
    df = scored(spark, [([0.4, 0.4, 0.2], 0), ([0.4, 0.4, 0.2], 1)])
    assert A.accuracy(df, "probs", "y").first()["accuracy"] == 0.5


def test_zero_probability_is_floored(spark):
    df = scored(spark, [([0.0, 1.0], 0)])
    assert A.mean_cross_entropy(df, "probs", "y").first()["loss"] == pytest.approx(-math.log(1e-7))


def test_evaluation(spark):
    df = scored(spark, [([0.5, 0.5], 0), ([0.1, 0.9], 1), ([0.8, 0.2], 1)])
    row = A.evaluation(df, "probs", "y").first()
    assert row["loss"] == pytest.approx(-(math.log(0.5) + math.log(0.9) + math.log(0.2)) / 3)
    assert row["accuracy"] == pytest.approx(2 / 3)


@pytest.fixture(scope="module")
def points(spark):
    rng = np.random.default_rng(0)
    rows = [(i, i % 3, (rng.normal(0, 0.2, 4) + 2 * np.eye(3, 4)[i % 3]).tolist()) for i in range(240)]
    return spark.createDataFrame(rows, "id int, label int, v array<double>").repartition(4)


def test_class_means_and_scores(spark, points):
    means = scoring.class_means(points, "v", [0, 1, 2, 9])
    rows = [r for r in points.collect()]
    for k in range(3):
        assert np.allclose(means[k], np.mean([r["v"] for r in rows if r["label"] == k], axis=0))
    assert (means[3] == 0).all()
    got = {r["id"]: r["probs"] for r in scoring.score(points, means, "v", batch_size=7).collect()}
    for r in rows:
        logits = np.array(r["v"]) @ means.T
        assert np.allclose(got[r["id"]], np.exp(logits) / np.exp(logits).sum())


def test_scores_do_not_depend_on_the_batch_size(points):
    means = scoring.class_means(points, "v", [0, 1, 2])
    runs = [
        {r["id"]: r["probs"] for r in scoring.score(points, means, "v", batch_size=b).collect()}
        for b in (1, 32, None)
    ]
    for i in runs[0]:
        assert np.allclose(runs[0][i], runs[1][i]) and np.allclose(runs[0][i], runs[2][i])


def test_fit_save_load_evaluate(spark, points, tmp_path):
    rows = training.with_features(points.withColumn("label_idx", F.col("label").cast("double")), "v")
    model = training.fit_classifier(rows, epochs=30)
    training.save_model(model, str(tmp_path / "m"))
    training.save_model(model, str(tmp_path / "m"))
    loaded = training.load_model(str(tmp_path / "m"))
    assert scoring.evaluate(rows, loaded).first()["accuracy"] > 0.95
    history = training.training_history(model, rows)
    first = history.where("epoch = 0").first()["loss"]
    assert A.last_epoch_metric(history, "loss").first()["loss"] < first


def test_label_encoder_follows_the_list(spark):
    df = spark.createDataFrame([("dog",), ("person",)], "label string")
    names = ["person", "cat", "dog"]
    coded = training.label_encoder(names).transform(df)
    assert {r["label"]: r["label_idx"] for r in coded.collect()} == {"dog": 2.0, "person": 0.0}
    back = training.label_decoder(names, output="back").transform(coded)
    assert back.where("back <> label").count() == 0
    with pytest.raises(Exception):
        training.label_encoder(["cat"]).transform(df).collect()


def test_grid_search_keeps_the_best_and_ignores_partitions(spark, points):
    rows = training.with_features(points.withColumn("label_idx", F.col("label").cast("double")), "v")
    grid = {"regParam": [10.0, 0.0], "elasticNetParam": [0.0, 1.0]}
    found, model = training.grid_search(rows, grid, "id", epochs=3)
    scores = sorted(map(tuple, found.collect()))
    assert len(scores) == 4
    best = A.best_candidate(found, "candidate", "accuracy").first()["candidate"]
    assert f"regParam={model.stages[-1].getOrDefault('regParam')}" in scores[best][1]
    again, _ = training.grid_search(rows.repartition(1), grid, "id", epochs=3)
    assert [(i, p) for i, p, _ in sorted(map(tuple, again.collect()))] == [(i, p) for i, p, _ in scores]
    assert np.allclose([a for _, _, a in scores], [r["accuracy"] for r in again.orderBy("candidate").collect()])


def test_class_weights_balance_a_fit(spark):
    rng = np.random.default_rng(2)
    rows = [(float(i % 20 == 0), [float(rng.normal((i % 20 == 0) * 0.8, 1.0))]) for i in range(2000)]
    df = training.with_features(spark.createDataFrame(rows, "label_idx double, v array<double>"), "v")

    def recall(**params):
        model = training.fit_classifier(training.with_class_weights(df), epochs=20, **params)
        found = scoring.score(df.where("label_idx = 1"), model)
        return found.agg(F.avg((F.get("probs", F.lit(1)) > 0.5).cast("double"))).first()[0]

    assert recall() < 0.1 < 0.4 < recall(weightCol="weight")


def test_stream_continues_after_a_restart(spark, tmp_path):
    source, sink, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    schema = "id bigint, label string"

    def arrive(lo, hi):
        rows = spark.range(lo, hi).select("id", F.when(F.col("id") % 3 == 0, "cat").otherwise("zebra").alias("label"))
        rows.write.mode("append").parquet(source)
        arriving = build.read_stream(spark, source, spark.createDataFrame([], schema).schema, files_per_trigger=2)
        build.stream_build(arriving, sink, state).awaitTermination()
        return spark.read.parquet(sink)

    assert arrive(0, 30).count() == 10
    landed = arrive(30, 60)
    assert sorted(r["id"] for r in landed.collect()) == list(range(0, 60, 3))
    assert {r["label_idx"] for r in landed.collect()} == {1}


@pytest.mark.parametrize("parts", [0, 3])
@pytest.mark.parametrize("name", ["stream_build", "stream_scoring"])
def test_streams_of_tables_in_files_and_folders(spark, tmp_path, name, parts):
    """A table is one file, or a folder of files that Spark wrote."""
    tables = {
        "events": pa.table({"event_id": range(12), "event_type": ["view", "error", "click"] * 4}),
        "embeddings": pa.table({
            "vec_id": range(12), "label": pa.array([0, 1, 2] * 4, pa.int32()),
            "embedding": pa.array([[float(i == j) for j in range(64)] for i in range(12)], pa.list_(pa.float32())),
        }),
    }
    for table, rows in tables.items():
        path = tmp_path / f"{table}.parquet"
        if parts:
            path.mkdir()
            (path / "_SUCCESS").touch()
        for i in range(max(parts, 1)):
            own = rows.slice(i * 4, 4) if parts else rows
            pq.write_table(own, path / f"part-{i}.parquet" if parts else path)
    found = plans.queries()[name](spark, str(tmp_path)).collect()
    if name == "stream_build":
        assert sorted(r["event_id"] for r in found) == [i for i in range(12) if i % 3 != 1]
    else:
        expected = plans.queries()["batch_scoring"](spark, str(tmp_path)).collect()
        assert sorted(found) == sorted(expected) and len(found) == 12 * 5
