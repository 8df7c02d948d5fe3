"""Queries that decode real image files, which Spark derives from the embeddings."""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from pixelweave import fixed, jobs
from pixelweave.functions import labels as L, tensors as T
from pixelweave.functions.arrow import FLOAT, block_of
from pixelweave.operators import images, layout
from pixelweave.operators.numbering import with_position
from pixelweave.plans.bindings import SHAPE, SQL_TENSORS, exploded, split_of, tensors, vectors
from pixelweave.plans.registry import query
from pixelweave.plans.tensors import _MEAN, _STD, sql_resize
from pixelweave.sinks import tables
from pixelweave.sinks.image_files import write_image_files
from pixelweave.sources import files
from pixelweave.workspace import fresh_path

_SIDE = 4


def png(rgb: np.ndarray) -> bytes:
    """Lossless 8-bit image file of (H, W, C) pixels; 1 channel is grey, 4 has alpha."""
    h, w, channels = rgb.shape
    kind = {1: 0, 3: 2, 4: 6}[channels]

    def part(tag: bytes, body: bytes) -> bytes:
        return struct.pack(">I", len(body)) + tag + body + struct.pack(">I", zlib.crc32(tag + body))

    header = struct.pack(">IIBBBBB", w, h, 8, kind, 0, 0, 0)
    lines = b"".join(b"\0" + line.tobytes() for line in np.ascontiguousarray(rgb, np.uint8))
    body = part(b"IHDR", header) + part(b"IDAT", zlib.compress(lines)) + part(b"IEND", b"")
    return b"\x89PNG\r\n\x1a\n" + body


def quantised(block: np.ndarray) -> np.ndarray:
    """Values of about [-1, 1] as 8-bit pixels."""
    return np.clip(np.floor((block.astype(np.float64) + 1.0) * 127.5), 0, 255).astype(np.uint8)


def png_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every embedding as an encoded image ``(vec_id, split, name, content)``."""

    @F.arrow_udf("binary")
    def encode(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in columns:
            yield pa.array([png(p) for p in quantised(block_of(column, FLOAT, SHAPE))], pa.binary())

    return layout.spread(tensors(spark, sf_dir), "vec_id").select(
        "vec_id",
        F.lit("train").alias("split"),
        F.regexp_replace(L.canonical_name("vec_id"), "jpg$", "png").alias("name"),
        encode("tensor").alias("content"),
    )


_SQL_QUANTISED = f"""
  SELECT vec_id, list_transform(embedding, lambda x:
         least(255, greatest(0, floor((CAST(x AS DOUBLE) + 1) * 127.5::DOUBLE)))) AS px
  FROM {SQL_TENSORS}
"""


@query(f"""
SELECT vec_id, i,
       CAST(CAST((floor(value + 0.5::DOUBLE) / 255 - {_MEAN}[i % 3 + 1]) / {_STD}[i % 3 + 1] AS FLOAT)
            AS DOUBLE) AS value
FROM ({sql_resize(_SQL_QUANTISED, _SIDE, _SIDE)})
""")
def image_decode(spark, sf_dir):
    root = fresh_path(spark, "images")
    written = write_image_files(png_files(spark, sf_dir), root)
    written.agg(F.sum("bytes")).collect()  # one row; runs the write
    decoded = files.decode_images(spark, root, "train")
    ready = images.image_to_tensor(decoded, _SIDE, _SIDE)
    vec_id = F.regexp_extract("name", "([0-9]+)", 1).cast("bigint").alias("vec_id")
    return exploded(ready.select(vec_id, "tensor"), T.from_bytes("tensor", (_SIDE, _SIDE, 3)))


@query("""
SELECT vec_id, printf('coco_%06d.png', vec_id) AS name, CAST(vec_id % 80 AS VARCHAR) AS label,
       CAST(pos AS BIGINT) AS pos, CAST(pos // 50 AS BIGINT) AS chunk_id
FROM (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS pos FROM embeddings)
""")
def image_listing(spark, sf_dir):
    root = fresh_path(spark, "listing")
    written = write_image_files(png_files(spark, sf_dir), root)
    written.agg(F.sum("bytes")).collect()  # one row; runs the write
    listed = with_position(files.list_images(spark, root, "train"), "path")
    no_file = files.read_labels(spark, f"{root}/train/labels.json")
    rows = layout.assign_chunk(files.with_labels(listed, no_file), fixed.CHUNK_SIZE)
    vec_id = F.regexp_extract("name", "([0-9]+)", 1).cast("bigint").alias("vec_id")
    return rows.select(vec_id, "name", "label", "pos", "chunk_id")


@query("""
WITH numbered AS (
  SELECT vec_id, label, CASE WHEN vec_id % 10 <= 7 THEN 'train'
                             WHEN vec_id % 10 = 8 THEN 'validation' ELSE 'test' END AS split
  FROM embeddings
),
named AS (
  SELECT *, printf('coco_%06d.jpg', row_number() OVER (PARTITION BY split ORDER BY vec_id) - 1) AS name
  FROM numbered
)
SELECT split, name, 'class ' || label AS label,
       CAST(row_number() OVER (PARTITION BY split ORDER BY name) - 1 AS BIGINT) AS pos
FROM named WHERE label <> 9
""")
def import_samples(spark, sf_dir):
    # The files of one class are missing, which leaves gaps in the names.
    root = fresh_path(spark, "source")
    rows = png_files(spark, sf_dir).withColumnRenamed("split", "folder")
    present = rows.join(vectors(spark, sf_dir).where(F.col("label") != 9).select("vec_id"), "vec_id")
    written = write_image_files(present.withColumn("split", F.lit("all")), root)
    written.agg(F.sum("bytes")).collect()  # one row; runs the write

    label = F.concat(F.lit(" Class "), F.col("label").cast("string"))
    annotated = vectors(spark, sf_dir).select(
        F.col("vec_id").alias("sample_id"),
        split_of("vec_id").alias("split"),
        F.format_string(f"{root}/all/coco_%06d.png", "vec_id").alias("filepath"),
        F.struct(F.array(F.struct(label.alias("label"))).alias("detections")).alias("ground_truth"),
    )
    source = fresh_path(spark, "annotated")
    annotated.write.parquet(source)
    return jobs.import_samples(spark, source, fresh_path(spark, "raw")).select(
        "split", "name", "label", "pos"
    )


def unpacked(content: bytes) -> np.ndarray:
    """Decoder of the images that ``png`` writes: BGR pixels."""
    at, size, data = 8, None, b""
    while at < len(content):
        n, tag = struct.unpack(">I4s", content[at : at + 8])
        body = content[at + 8 : at + 8 + n]
        if tag == b"IHDR":
            size = struct.unpack(">II", body[:8])
        elif tag == b"IDAT":
            data += body
        at += n + 12
    w, h = size
    lines = np.frombuffer(zlib.decompress(data), np.uint8).reshape(h, -1)
    return lines[:, 1:].reshape(h, w, -1)[..., ::-1]


_SQL_OUTCOME = """CASE vec_id % 5 WHEN 3 THEN 'not found' WHEN 4 THEN 'unreadable' ELSE 'read' END"""


@query(f"""
SELECT {_SQL_OUTCOME} AS outcome, count(*) AS n, count(*) FILTER (vec_id % 5 < 3) AS n_same FROM embeddings GROUP BY 1
""")
def named_files(spark, sf_dir):
    """Files whose names hold a blank or a percent sign, absent files, and folders."""
    root = fresh_path(spark, "named")
    form = F.element_at(F.array(*map(F.lit, ("a b%d", "a%%20b%d", "a+b%%%d"))), (F.col("vec_id") % 3 + 1).cast("int"))
    name = F.concat(F.regexp_replace(form, "%d", ""), F.col("vec_id").cast("string"), F.lit(".png"))
    rows = png_files(spark, sf_dir).withColumn("name", name)
    written = write_image_files(rows.where("vec_id % 5 < 3"), root)
    written.agg(F.sum("bytes")).collect()  # one row; runs the write
    place = F.when(F.col("vec_id") % 5 == 4, F.lit(f"{root}/train")).otherwise(
        F.concat(F.lit(f"{root}/train/"), "name")
    )
    named = rows.select("vec_id", F.crc32("content").alias("crc"), place.alias("filepath"))
    found = files.with_contents(named, keep_rejects=True)
    return found.groupBy(F.coalesce("reject", F.lit("read")).alias("outcome")).agg(
        F.count("*").alias("n"), F.count_if(F.crc32("content") == F.col("crc")).alias("n_same")
    )


@query(f"""
WITH chosen AS (
  SELECT vec_id, label, CASE WHEN vec_id % 10 <= 7 THEN 'train'
                             WHEN vec_id % 10 = 8 THEN 'validation' ELSE 'test' END AS split
  FROM embeddings WHERE label < 5
),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY split ORDER BY vec_id) - 1 AS pos FROM chosen
),
cells AS (
  SELECT vec_id, CAST(CAST((px[i + 1] / 255 - {_MEAN}[i % 3 + 1]) / {_STD}[i % 3 + 1] AS FLOAT) AS DOUBLE) AS x
  FROM ({_SQL_QUANTISED}), range(192) AS r(i)
),
sums AS (SELECT vec_id, sum(x) AS total FROM cells GROUP BY 1)
SELECT split, CAST(pos AS BIGINT) AS pos, CAST(pos // 50 AS BIGINT) AS chunk_id, 'c' || label AS label,
       round(total, 3) + 0.0 AS total
FROM placed JOIN sums USING (vec_id) WHERE split <> 'test' OR pos < 7
""")
def prepare_packed(spark, sf_dir):
    """Raw table, selection, decoding, chunk table, and back."""
    label = F.concat(F.lit("c"), F.col("label").cast("string")).alias("label")
    labelled = png_files(spark, sf_dir).drop("split").join(vectors(spark, sf_dir).select("vec_id", label), "vec_id")
    raw, out = fresh_path(spark, "raw"), fresh_path(spark, "processed")
    tables.write_raw(labelled.withColumn("split", split_of("vec_id")), raw)
    done = jobs.prepare_packed(
        spark, raw, out, unpacked, [f"c{i}" for i in range(5)], {"test": 7}, SHAPE
    )
    total = F.aggregate(
        T.from_bytes("tensor", SHAPE), F.lit(0.0), lambda s, x: s + x.cast("double")
    )
    return done.select("split", "pos", "chunk_id", "label", (F.round(total, 3) + 0.0).alias("total"))
