"""Quality of a model over time, on labelled samples that arrive as files.

Every micro-batch is scored with the newest version of the model and adds, per window of event
time and model version, its rows, hits and loss to a table. The sums, the batch's number, the
watermark and the model's version become valid in one commit, so a micro-batch that Spark runs
again is skipped and a reader sees whole batches only. Sums of a window merge in any order.

Defined cases: a row without a time or a label is not scored; a row whose window ended at or
before the watermark of the batches before is late, counted and not scored; without rows a
batch adds nothing but its number. The watermark is the latest event time less the delay and
never goes back.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from pixelweave.learning.scoring import score
from pixelweave.operators import aggregates as A
from pixelweave.sinks import snapshots

# Micro-batches whose sums lie apart before they are added up into one folder.
_APART = 50
_WINDOW = ["start", "end", "model"]


def publish_model(spark: SparkSession, weights: np.ndarray, root: str) -> int:
    """Make ``weights``, one row per class, the newest version of a model; its number."""
    rows = [(i, [float(x) for x in row]) for i, row in enumerate(weights)]
    return snapshots.replace(spark.createDataFrame(rows, "class_idx int, weights array<double>"), root)


def stored_model(spark: SparkSession, root: str, version: int) -> np.ndarray:
    """The weights of a version."""
    rows = snapshots.read(spark, root, version).orderBy("class_idx").collect()
    return np.array([row["weights"] for row in rows])


def _merged(sums: DataFrame) -> DataFrame:
    return sums.groupBy(*_WINDOW).agg(*[F.sum(c).alias(c) for c in ("n", "hits", "loss")])


def land_quality(
    rows: DataFrame, batch: int, models: str, table: str, window: str, delay: int,
    time: str = "time", values: str = "features", label: str = "label_idx",
) -> bool:
    """Add the sums of one micro-batch; False, and nothing added, if it is there already.

    ``window`` is a duration such as ``1 hour``, ``delay`` the seconds rows may come late.
    """
    spark = rows.sparkSession
    found = snapshots.latest(spark, table)
    notes = found.notes if found else {}
    if notes.get("batch", -1) >= batch:
        return False
    mark = notes.get("watermark")
    version = snapshots.find(spark, models).version
    whole = rows.where(F.col(time).isNotNull() & F.col(label).isNotNull())
    placed = whole.withColumn("__window", F.window(time, window))
    late = F.lit(False) if mark is None else F.unix_micros(F.col("__window.end")) <= F.lit(mark)
    seen = placed.agg(
        F.max(F.unix_micros(F.col(time))).alias("latest"), F.count_if(late).alias("late")
    ).first()
    scored = score(placed.where(~late), stored_model(spark, models, version), values, "__probs")
    probs = F.col("__probs")
    sums = scored.groupBy(
        F.col("__window.start").alias("start"), F.col("__window.end").alias("end"),
        F.lit(version).cast("bigint").alias("model"),
    ).agg(
        F.count("*").alias("n"),
        F.count_if(A.predicted_class(probs) == F.col(label)).alias("hits"),
        F.sum(A.cross_entropy(probs, F.col(label))).alias("loss"),
    )
    marks = [m for m in (mark, None if seen["latest"] is None else seen["latest"] - delay * 1_000_000) if m is not None]
    following = {
        "batch": batch, "watermark": max(marks, default=None),
        "late": notes.get("late", 0) + seen["late"], "models": [*notes.get("models", []), version][-_APART:],
    }
    if found and len(found.folders) >= _APART:
        both = snapshots.read(spark, table, found.version).unionByName(sums)
        snapshots.replace(_merged(both), table, notes=following)
    else:
        snapshots.append(sums, table, notes=following)
    return True


def stream_quality(
    source: DataFrame, models: str, table: str, checkpoint: str, window: str, delay: int, **columns: str
) -> StreamingQuery:
    """Score arriving labelled rows and keep the model's quality per window of event time; read
    the result with ``quality_over_time``. ``columns`` name time, values and label."""
    return (
        source.writeStream.foreachBatch(
            lambda rows, batch: land_quality(rows, batch, models, table, window, delay, **columns)
        )
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def quality_over_time(spark: SparkSession, table: str, closed: bool = False) -> DataFrame:
    """``(start, end, model, n, accuracy, loss)`` per window and model version; with ``closed``
    only of windows that no later row can change."""
    found = snapshots.find(spark, table)
    sums = _merged(snapshots.read(spark, table, found.version))
    if closed:
        mark = found.notes["watermark"]
        sums = sums.where(F.lit(mark is not None) & (F.unix_micros("end") <= F.lit(mark or 0)))
    return sums.select(
        *_WINDOW, "n", (F.col("hits") / F.col("n")).alias("accuracy"), (F.col("loss") / F.col("n")).alias("loss")
    )
