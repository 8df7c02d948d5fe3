"""Image files, label files and metadata files.

A path that does not exist is an empty table, as a split without files is not an error.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from pixelweave import fixed, schemas
from pixelweave.functions import labels as L
from pixelweave.functions.arrow import MAX_BLOCK_BYTES
from pixelweave.functions.storage import Storage


def _or_empty(spark: SparkSession, load: Callable[[], DataFrame], schema: T.StructType) -> DataFrame:
    try:
        return load()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def list_images(spark: SparkSession, root: str, split: str) -> DataFrame:
    """Paths and names of the images of one split. File contents are not read."""

    def load() -> DataFrame:
        files = spark.read.format("binaryFile").option("pathGlobFilter", fixed.IMAGE_GLOB)
        return files.load(f"{root}/{split}").select("path", L.basename("path").alias("name"))

    return _or_empty(spark, load, schemas.LISTING)


def read_contents(spark: SparkSession, root: str, split: str) -> DataFrame:
    """Names and encoded bytes of the images of one split, to be packed into a table."""

    def load() -> DataFrame:
        files = spark.read.format("binaryFile").option("pathGlobFilter", fixed.IMAGE_GLOB)
        return files.load(f"{root}/{split}").select(
            "path", L.basename("path").alias("name"), "content"
        )

    schema = T.StructType([*schemas.LISTING.fields, T.StructField("content", T.BinaryType())])
    return _or_empty(spark, load, schema)


def with_contents(df: DataFrame, path: str = "filepath", keep_rejects: bool = False) -> DataFrame:
    """Add the bytes of the file each row names; rows without a readable file are dropped.

    With ``keep_rejects`` they stay, with null bytes, and column ``reject`` names the reason.
    """
    names = [*df.columns, "content", *(["reject"] if keep_rejects else [])]

    def load(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        storage = Storage()
        for batch in batches:
            rows, contents, reasons, size = [], [], [], 0

            def ready() -> pa.RecordBatch:
                kept = batch.take(pa.array(rows, pa.int64()))
                added = [pa.array(contents, pa.binary()), pa.array(reasons, pa.string())]
                return pa.RecordBatch.from_arrays([*kept.columns, *added][: len(names)], names)

            for i, place in enumerate(batch.column(path).to_pylist()):
                content, reason = storage.read(place)
                if content is None and not keep_rejects:
                    continue
                rows.append(i)
                contents.append(content)
                reasons.append(reason)
                size += len(content or b"")
                if size >= MAX_BLOCK_BYTES:
                    yield ready()
                    rows, contents, reasons, size = [], [], [], 0
            if rows:
                yield ready()

    schema = T.StructType([*df.schema.fields, T.StructField("content", T.BinaryType())])
    if keep_rejects:
        schema = schema.add("reject", T.StringType())
    return df.mapInArrow(load, schema)


def decode_images(
    spark: SparkSession, root: str, split: str, drop_invalid: bool = True
) -> DataFrame:
    """Decoded images of one split as ``(name, image)``.

    With ``drop_invalid=False`` an undecodable file stays as an image of height -1.
    """

    def load() -> DataFrame:
        images = (
            spark.read.format("image")
            .option("pathGlobFilter", fixed.IMAGE_GLOB)
            .option("dropInvalid", str(drop_invalid).lower())
            .load(f"{root}/{split}")
        )
        return images.select(L.basename("image.origin").alias("name"), "image")

    schema = T.StructType([T.StructField("name", T.StringType()), *schemas.IMAGE_ROW.fields])
    return _or_empty(spark, load, schema)


def read_labels(spark: SparkSession, path: str) -> DataFrame:
    """Labels of a label file with their position; empty for any unusable file."""

    def load() -> DataFrame:
        text = spark.read.text(path, wholetext=True)
        entries = text.select(F.posexplode(L.parse_label_list("value")).alias("pos", "label"))
        return entries.select(F.col("pos").cast("bigint"), "label")

    return _or_empty(spark, load, schemas.LABEL_ROW)


def read_label_lines(spark: SparkSession, path: str) -> DataFrame:
    """Labels with position and image name from JSON lines, which many tasks read at once."""
    return _or_empty(
        spark, lambda: spark.read.schema(schemas.NAMED_LABEL).json(path), schemas.NAMED_LABEL
    )


def fallback_label(pos: str = "pos", k: int = fixed.FALLBACK_CLASSES):
    """Label made from the position alone."""
    return F.pmod(F.col(pos), F.lit(k)).cast("string")


def with_labels(
    files: DataFrame, labels: DataFrame, k: int = fixed.FALLBACK_CLASSES
) -> DataFrame:
    """Label of every numbered file by position.

    Files past the end of the labels are dropped. Only when there are no labels at all
    does every file get the fallback label.
    """
    none_at_all = labels.limit(1).agg(F.count("*")).scalar() == 0
    made_up = files.where(none_at_all).withColumn("label", fallback_label("pos", k))
    return files.join(labels, "pos", "inner").select(*files.columns, "label").unionByName(made_up)


def read_meta(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """One metadata object per file."""
    return spark.read.schema(schema).json(path, multiLine=True)


def read_label_map(spark: SparkSession, path: str) -> DataFrame:
    """Label map file as ``(label, class_idx)`` rows."""
    text = spark.read.text(path, wholetext=True)
    return text.select(F.explode(L.parse_label_map("value")).alias("label", "class_idx"))
