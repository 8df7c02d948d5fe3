"""Annotated samples."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pixelweave import schemas
from pixelweave.operators.filters import select_split
from pixelweave.operators.layout import head


def read_samples(
    spark: SparkSession,
    path: str,
    split: str,
    max_samples: int | None = None,
    fmt: str = "parquet",
) -> DataFrame:
    """Samples of one split in id order, optionally only the first ``max_samples``.

    A missing path is an error, as a run without a split is of no use.
    """
    table = spark.read.schema(schemas.ANNOTATED_SAMPLE).format(fmt).load(path)
    samples = select_split(table, split)
    return samples if max_samples is None else head(samples, max_samples, "sample_id")


def id_range(spark: SparkSession, start: int, end: int, name: str = "chunk_id") -> DataFrame:
    """Ids ``[start, end)`` as a table."""
    return spark.range(start, end).withColumnRenamed("id", name)
