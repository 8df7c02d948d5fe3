"""Scans of a chunked sample table.

Chunks are ranges of one sorted Parquet table, so a scan of some chunks is a predicate on
``chunk_id`` that skips row groups. Of a table that ``sinks.tables.write_chunks`` made, the zone
map names the files of the wanted chunks, so the others are neither listed nor opened.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, functions as F

from pixelweave.operators.filters import select_split
from pixelweave.operators.layout import first_gap
from pixelweave.sinks import snapshots, zones

# Files that a scan names; a longer list is left to the predicate on the whole table.
MOST_FILES = 10_000


def read_chunks(df: DataFrame, start: int, end: int, split: str | None = None) -> DataFrame:
    """Rows of the chunks ``[start, end)`` that exist; missing ids are passed over."""
    rows = df if split is None else select_split(df, split)
    return rows.where((F.col("chunk_id") >= start) & (F.col("chunk_id") < end))


def read_chunk_prefix(df: DataFrame, split: str | None = None) -> DataFrame:
    """Rows of chunks 0, 1, 2, ... up to the first missing id; empty without chunk 0."""
    rows = df if split is None else select_split(df, split)
    return rows.where(F.col("chunk_id") < first_gap(rows.select("chunk_id")).scalar())


def read_stored_chunks(
    spark: SparkSession, root: str, start: int, end: int, split: str | None = None, version: int | None = None
) -> DataFrame:
    """``read_chunks`` of a stored table, opening only files that hold one of the chunks."""
    found = snapshots.find(spark, root, version)
    rows = snapshots.read(spark, root, found.version)
    if zones.NOTE in found.notes and len(found.folders) == 1:
        path = snapshots.data_path(root, found.folders[0])
        named = zones.overlapping(zones.load(spark, path), start, end, split).limit(MOST_FILES + 1).collect()
        if len(named) <= MOST_FILES:
            rows = snapshots.read(spark, root, found.version, [row["file"] for row in named])
    return read_chunks(rows, start, end, split)


def stored_first_gap(spark: SparkSession, root: str, split: str | None = None) -> int:
    """The smallest chunk id that a stored table lacks; from the zone map, where there is one."""
    found = snapshots.find(spark, root)
    if zones.NOTE in found.notes and len(found.folders) == 1:
        held = zones.load(spark, snapshots.data_path(root, found.folders[0]))
        return first_gap(zones.chunk_ids(held, split)).first()["first_gap"]
    rows = snapshots.read(spark, root, found.version)
    own = rows if split is None else select_split(rows, split)
    return first_gap(own.select("chunk_id")).first()["first_gap"]


def read_stored_prefix(spark: SparkSession, root: str, split: str | None = None) -> DataFrame:
    """``read_chunk_prefix`` of a stored table, opening only files of the prefix."""
    return read_stored_chunks(spark, root, 0, stored_first_gap(spark, root, split), split)


def read_batches(df: DataFrame, batch_ids: Iterable[int]) -> DataFrame:
    """Rows of the given batches."""
    return df.where(F.col("batch_id").isin(list(batch_ids)))
