"""Windowed quality of streamed scores: late rows, model versions, replays."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from pixelweave.sinks import snapshots
from pixelweave.streaming import build, quality

SCHEMA = "time timestamp, features array<double>, label_idx int"
ZERO = dt.datetime(2024, 1, 1)


def row(minute, good, label=0):
    return (ZERO + dt.timedelta(minutes=minute), [2.0, 0.0] if good == (label == 0) else [0.0, 2.0], label)


def windows(spark, table, **kw):
    found = quality.quality_over_time(spark, table, **kw).collect()
    return {(r["start"].minute + 60 * r["start"].hour, r["model"]): (r["n"], r["accuracy"]) for r in found}


def test_late_rows_versions_and_replays(spark, tmp_path):
    source, models, table, state = (str(tmp_path / n) for n in ("in", "m", "t", "state"))

    def arrive(*rows):
        spark.createDataFrame(list(rows), SCHEMA).coalesce(1).write.mode("append").parquet(source)
        arriving = build.read_stream(spark, source, spark.createDataFrame([], SCHEMA).schema, files_per_trigger=1)
        quality.stream_quality(arriving, models, table, state, "10 minutes", 300).awaitTermination()

    quality.publish_model(spark, np.eye(2), models)
    arrive(row(1, True), row(2, False), row(12, True, 1), (None, [1.0, 0.0], 0), (ZERO, [1.0, 0.0], None))
    # The watermark is minute 7: the first window is open and takes late rows.
    quality.publish_model(spark, np.eye(2)[::-1].copy(), models)
    arrive(row(3, True), row(25, True))
    # Now it is minute 20: windows that ended by then are closed.
    arrive(row(4, True), row(19, True), row(21, False))
    want = {(0, 1): (2, 0.5), (10, 1): (1, 1.0), (0, 2): (1, 0.0), (20, 2): (2, 0.5)}
    assert windows(spark, table) == want
    assert windows(spark, table, closed=True) == {k: v for k, v in want.items() if k[0] < 20}
    notes = snapshots.latest(spark, table).notes
    assert (notes["batch"], notes["late"], notes["models"]) == (2, 2, [1, 2, 2])
    again = spark.createDataFrame([row(25, True)], SCHEMA)
    assert not quality.land_quality(again, 1, models, table, "10 minutes", 300)
    assert windows(spark, table) == want


def test_sums_are_added_up_and_an_interrupted_batch_is_repeated(spark, tmp_path, monkeypatch):
    models, table = str(tmp_path / "m"), str(tmp_path / "t")
    quality.publish_model(spark, np.eye(2), models)
    monkeypatch.setattr(quality, "_APART", 2)
    commit = snapshots._commit
    for batch in range(5):
        rows = spark.createDataFrame([row(batch, True), row(batch, batch % 2 == 0)], SCHEMA)
        if batch == 3:
            monkeypatch.setattr(snapshots, "_commit", lambda *a: 1 / 0)
            with pytest.raises(ZeroDivisionError):
                quality.land_quality(rows, batch, models, table, "10 minutes", 60)
            monkeypatch.setattr(snapshots, "_commit", commit)
        assert quality.land_quality(rows, batch, models, table, "10 minutes", 60)
    assert windows(spark, table) == {(0, 1): (10, 0.8)}
    assert len(snapshots.latest(spark, table).folders) <= 2


def test_an_empty_batch(spark, tmp_path):
    models, table = str(tmp_path / "m"), str(tmp_path / "t")
    quality.publish_model(spark, np.eye(2), models)
    none = spark.createDataFrame([], SCHEMA)
    assert quality.land_quality(none, 0, models, table, "10 minutes", 60)
    assert quality.quality_over_time(spark, table, closed=True).count() == 0
    assert quality.land_quality(spark.createDataFrame([row(0, True)], SCHEMA), 1, models, table, "10 minutes", 60)
    assert windows(spark, table) == {(0, 1): (1, 1.0)}
