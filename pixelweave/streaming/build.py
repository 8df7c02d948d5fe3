"""Incremental build and scoring of a dataset whose samples arrive as files.

Row-wise steps run in the stream and land in a file sink, which commits each micro-batch once, so
a restarted query continues where it stopped. ``stream_layout`` gives arriving samples dense
positions, chunks and batches, too: a micro-batch is numbered on from where the one before
ended, and its rows, its number and the next positions become valid in one commit.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from pixelweave import fixed, schemas
from pixelweave.functions import labels as L
from pixelweave.learning.scoring import score
from pixelweave.operators import layout
from pixelweave.operators.numbering import Order, with_position
from pixelweave.sinks import snapshots
from pixelweave.sinks.tables import training_set


def read_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    name_glob: str | None = "*.parquet",
    files_per_trigger: int | None = None,
) -> DataFrame:
    """Parquet files of a folder, as they arrive."""
    reader = spark.readStream.schema(schema)
    if name_glob:
        reader = reader.option("pathGlobFilter", name_glob)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def read_table_stream(
    spark: SparkSession, folder: str, name: str, schema: T.StructType, files_per_trigger: int | None = None
) -> DataFrame:
    """A Parquet table ``name`` of a folder, be it one file or a folder of files, as its files arrive.

    The name is given as a pattern: a stream takes a plain path for a folder, and a filter on
    names sees the files inside a table's folder only.
    """
    return read_stream(spark, f"{folder}/{{{name}}}", schema, None, files_per_trigger)


def read_image_stream(
    spark: SparkSession, path: str, files_per_trigger: int | None = None
) -> DataFrame:
    """Image files of a folder as ``(name, content)``, as they arrive."""
    reader = spark.readStream.format("binaryFile").schema(schemas.FILE_ROW)
    reader = reader.option("pathGlobFilter", fixed.IMAGE_GLOB)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(path).select(L.basename("path").alias("name"), "content")


def append(df: DataFrame, sink: str, checkpoint: str) -> StreamingQuery:
    """Append all files present now to a Parquet sink, then stop."""
    return (
        df.writeStream.format("parquet")
        .option("path", sink)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )


def stream_build(
    source: DataFrame,
    sink: str,
    checkpoint: str,
    classes: Sequence = fixed.TARGET_CLASSES,
    prepare: Callable[[DataFrame], DataFrame] | None = None,
    label: str = "label",
) -> StreamingQuery:
    """Class filter, encoding and any other row-wise ``prepare`` step, appended to a sink."""
    rows = prepare(source) if prepare else source
    return append(training_set(rows, classes, label), sink, checkpoint)


def stream_score(
    source: DataFrame,
    model: np.ndarray,
    sink: str,
    checkpoint: str,
    values: str = "features",
) -> StreamingQuery:
    """Class probabilities of arriving rows, appended to a sink."""
    return append(score(source, model, values), sink, checkpoint)


def land(
    rows: DataFrame,
    batch: int,
    table: str,
    order_by: Order,
    by: str | None = None,
    chunk_size: int = fixed.CHUNK_SIZE,
    per_batch: int = fixed.CHUNKS_PER_BATCH,
) -> bool:
    """Add one micro-batch to a table with ``pos``, ``chunk_id`` and ``batch_id`` that go on from
    the rows landed before; False, and nothing added, if this batch is there already.

    With ``by``, such as the split, every group counts on its own; groups are few.
    """
    spark = rows.sparkSession
    found = snapshots.latest(spark, table)
    notes = found.notes if found else {}
    if notes.get("batch", -1) >= batch:
        return False
    group = F.coalesce(F.col(by).cast("string"), F.lit("")) if by else F.lit("")
    numbered = with_position(rows.withColumn("__group", group), order_by, "__group")
    following = dict(notes.get("next", {}))
    start = F.lit(0).cast("bigint")
    if following:
        known = F.create_map(*[F.lit(x) for pair in following.items() for x in pair])
        start = F.coalesce(F.try_element_at(known, F.col("__group")).cast("bigint"), start)
    # One row per group.
    for row in numbered.groupBy("__group").agg(F.count("*").alias("n")).collect():
        following[row["__group"]] = following.get(row["__group"], 0) + row["n"]
    placed = numbered.withColumn("pos", start + F.col("pos")).drop("__group")
    laid = layout.pack_batches(layout.assign_chunk(placed, chunk_size), per_batch)
    snapshots.append(laid, table, notes={"batch": batch, "next": following})
    return True


def stream_layout(
    source: DataFrame,
    table: str,
    checkpoint: str,
    order_by: Order,
    by: str | None = None,
    chunk_size: int = fixed.CHUNK_SIZE,
    per_batch: int = fixed.CHUNKS_PER_BATCH,
) -> StreamingQuery:
    """Number arriving samples and lay them out in chunks and batches, in order of arrival and of
    ``order_by`` within a micro-batch; read the result with ``sinks.tables.read_table``.

    A micro-batch that Spark runs again after a failure is recognised by its number.
    """
    return (
        source.writeStream.foreachBatch(
            lambda rows, batch: land(rows, batch, table, order_by, by, chunk_size, per_batch)
        )
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
