"""Run metadata, derived by aggregates and written as one JSON object."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from pixelweave import fixed, schemas
from pixelweave.functions.labels import label_lookup
from pixelweave.workspace import one_row


def batch_info(
    df: DataFrame,
    batch_dir: str,
    classes: Sequence = fixed.TARGET_CLASSES,
    label: str = "label",
) -> DataFrame:
    """Location, kept rows, batches and kept classes of loaded batches; one row.

    A batch counts even if the class filter leaves none of its rows.
    """
    # One partial row per (batch, label) leaves each task, so no row is shuffled.
    cells = df.groupBy("batch_id", label).agg(F.count("*").alias("n"))
    listed = F.col(label).isin(list(classes))
    return cells.agg(
        F.lit(batch_dir).alias("batch_dir"),
        F.coalesce(F.sum(F.when(listed, F.col("n"))), F.lit(0)).cast("bigint").alias("total_images"),
        F.count_distinct("batch_id").alias("num_batches"),
        F.count_distinct(F.when(listed, F.col(label))).alias("num_classes"),
    )


def run_config(
    spark: SparkSession,
    num_batches: int,
    num_classes: int = len(fixed.TARGET_CLASSES),
    epochs: int = fixed.EPOCHS,
    batch_size: int = fixed.MINIBATCH_SIZE,
    learning_rate: float = fixed.LEARNING_RATE,
    chunks_per_batch: int = fixed.CHUNKS_PER_BATCH,
) -> DataFrame:
    """Training settings; one row."""
    row = (epochs, batch_size, learning_rate, num_classes, num_batches, chunks_per_batch)
    return spark.createDataFrame([row], schemas.RUN_CONFIG)


def label_map(spark: SparkSession, classes: Sequence = fixed.TARGET_CLASSES) -> DataFrame:
    """One JSON object of label to index."""
    pairs = [x for label, idx in label_lookup(classes).items() for x in (F.lit(label), F.lit(idx))]
    return one_row(spark).select(F.to_json(F.create_map(*pairs)).alias("value"))


def write_meta(df: DataFrame, path: str) -> None:
    """One object per row. A column named ``value`` alone is taken as finished JSON."""
    one_file = df.coalesce(1).write.mode("overwrite")
    if df.columns == ["value"]:
        one_file.text(path)
    else:
        one_file.json(path)
