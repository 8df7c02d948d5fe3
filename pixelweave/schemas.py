"""Declared row schemas. Nothing in the engine relies on schema inference."""

from __future__ import annotations

from pyspark.sql import types as T

DETECTION = T.StructType([T.StructField("label", T.StringType())])

ANNOTATED_SAMPLE = T.StructType(
    [
        T.StructField("sample_id", T.LongType()),
        T.StructField("split", T.StringType()),
        T.StructField("filepath", T.StringType()),
        T.StructField(
            "ground_truth",
            T.StructType([T.StructField("detections", T.ArrayType(DETECTION))]),
        ),
    ]
)

LISTING = T.StructType(
    [T.StructField("path", T.StringType()), T.StructField("name", T.StringType())]
)

# Schema of Spark's binary file source.
FILE_ROW = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("modificationTime", T.TimestampType()),
        T.StructField("length", T.LongType()),
        T.StructField("content", T.BinaryType()),
    ]
)

LABEL_ROW = T.StructType(
    [T.StructField("pos", T.LongType()), T.StructField("label", T.StringType())]
)

IMAGE = T.StructType(
    [
        T.StructField("origin", T.StringType()),
        T.StructField("height", T.IntegerType()),
        T.StructField("width", T.IntegerType()),
        T.StructField("nChannels", T.IntegerType()),
        T.StructField("mode", T.IntegerType()),
        T.StructField("data", T.BinaryType()),
    ]
)

IMAGE_ROW = T.StructType([T.StructField("image", IMAGE)])

PROCESSED_SAMPLE = T.StructType(
    [
        T.StructField("split", T.StringType()),
        T.StructField("chunk_id", T.LongType()),
        T.StructField("pos", T.LongType()),
        T.StructField("label", T.StringType()),
        T.StructField("h", T.IntegerType()),
        T.StructField("w", T.IntegerType()),
        T.StructField("c", T.IntegerType()),
        T.StructField("tensor", T.BinaryType()),
    ]
)

BATCH_INFO = T.StructType(
    [
        T.StructField("batch_dir", T.StringType()),
        T.StructField("total_images", T.LongType()),
        T.StructField("num_batches", T.LongType()),
    ]
)

NAMED_LABEL = T.StructType(
    [
        T.StructField("pos", T.LongType()),
        T.StructField("name", T.StringType()),
        T.StructField("label", T.StringType()),
    ]
)

RUN_CONFIG = T.StructType(
    [
        T.StructField("epochs", T.IntegerType()),
        T.StructField("batch_size", T.IntegerType()),
        T.StructField("learning_rate", T.DoubleType()),
        T.StructField("num_classes", T.IntegerType()),
        T.StructField("num_batches", T.IntegerType()),
        T.StructField("chunks_per_batch", T.IntegerType()),
    ]
)

LABEL_MAP = T.MapType(T.StringType(), T.IntegerType())
