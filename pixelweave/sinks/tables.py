"""Parquet writers. Executors write their own rows; each table is one job.

Tables replace their predecessor in one step (``sinks.snapshots``): rows of an earlier run are
never read again, and a run that fails leaves the earlier table readable.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from pixelweave import fixed
from pixelweave.functions import labels as L
from pixelweave.operators.filters import keep_classes
from pixelweave.sinks import snapshots, zones


def read_table(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """Rows of a table that one of these writers made; its newest version unless one is given."""
    return snapshots.read(spark, root, version)


def write_raw(df: DataFrame, root: str) -> None:
    """Kept source images as rows ``(name, split, content, label)``, by split."""
    rows = df.select("name", "content", "label", "split")
    snapshots.replace(rows, root, ["split"])


def write_chunks(df: DataFrame, path: str) -> None:
    """Processed samples with their ``chunk_id``, by split, and the zone map of their files."""
    spark = df.sparkSession
    snapshots.replace(df, path, ["split"], describe=lambda folder: zones.build(spark, folder, df.schema))


def write_batches(
    df: DataFrame, path: str, classes: Sequence = fixed.TARGET_CLASSES, label: str = "label"
) -> None:
    """Rows of the target classes with their ``batch_id``."""
    snapshots.replace(keep_classes(df, classes, label), path)


def training_set(
    df: DataFrame, classes: Sequence = fixed.TARGET_CLASSES, label: str = "label"
) -> DataFrame:
    """Class filter, class index and one-hot target."""
    n = len(L.label_lookup(classes))
    kept = keep_classes(df, classes, label)
    encoded = kept.withColumn("label_idx", L.label_index(label, classes))
    return encoded.withColumn("target", L.one_hot("label_idx", n))


def write_training_set(df: DataFrame, path: str) -> None:
    """Training rows: tensor, index and target side by side."""
    snapshots.replace(df, path)


def write_label_lines(df: DataFrame, path: str, order: str = "pos") -> None:
    """Labels with position and image name as JSON lines, by split, beside loose images.

    Spark tables carry the label in the sample row instead.
    """
    rows = df.select("split", order, "name", "label")
    rows.write.mode("overwrite").partitionBy("split").json(path)
