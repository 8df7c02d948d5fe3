"""How the given tables play the parts of samples, tensors and class lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from pixelweave.functions import tensors as T
from pixelweave.operators import layout
from pixelweave.operators.filters import keep_classes
from pixelweave.operators.numbering import with_position

# "cart" never occurs in the data; "error" occurs and is not listed.
CLASSES = ("purchase", "click", "view", "cart", "signup")
INT_CLASSES = (0, 1, 2, 3, 4)

# The 64 values of an embedding are read as an 8 x 8 image. Its three channels are the values,
# the negated values and the halved values, which differ and are exact in both engines.
SHAPE = (8, 8, 3)
VALUES = 192

SQL_TENSORS = """(
  SELECT vec_id, label,
         flatten(list_transform(embedding, lambda x: [x, -x, CAST(x / 2 AS FLOAT)])) AS embedding
  FROM embeddings
)"""
SQL_LIST = ", ".join(f"'{c}'" for c in CLASSES)
SQL_CLASSES = ", ".join(f"({i}, '{c}')" for i, c in enumerate(CLASSES))
SQL_INDEX = "CASE label " + " ".join(f"WHEN '{c}' THEN {i}" for i, c in enumerate(CLASSES)) + " END"
SQL_SPLIT = (
    "CASE WHEN event_id % 10 <= 7 THEN 'train' "
    "WHEN event_id % 10 = 8 THEN 'validation' ELSE 'test' END"
)
SQL_KEPT = f"SELECT event_id, event_type AS label FROM events WHERE event_type IN ({SQL_LIST})"
SQL_CHUNKS = f"""
  SELECT event_id, label, pos, pos // 50 AS chunk_id
  FROM (SELECT *, row_number() OVER (ORDER BY event_id) - 1 AS pos FROM ({SQL_KEPT}))
"""
SQL_GAPPY = f"SELECT * FROM ({SQL_CHUNKS}) WHERE chunk_id % 7 <> 5"
SQL_BATCHES = """
  SELECT event_id, label, pos, pos // 50 AS chunk_id, pos // 500 AS batch_id
  FROM (SELECT event_id, event_type AS label,
               row_number() OVER (ORDER BY event_id) - 1 AS pos FROM events)
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def split_of(key: str) -> Column:
    digit = F.col(key) % 10
    return F.when(digit <= 7, "train").when(digit == 8, "validation").otherwise("test")


def samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled samples ``(event_id, label)``."""
    return table(spark, sf_dir, "events").select("event_id", F.col("event_type").alias("label"))


def kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Samples of the listed classes; the predicate reaches the scan."""
    return keep_classes(samples(spark, sf_dir), CLASSES)


def chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kept samples in chunks."""
    return layout.assign_chunk(with_position(kept(spark, sf_dir), "event_id"))


def gappy_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunks of which some ids are missing; the first gap is 5."""
    return chunks(spark, sf_dir).where(F.col("chunk_id") % 7 != 5)


def batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All samples, before any class filter, in chunks and batches."""
    numbered = with_position(samples(spark, sf_dir), "event_id")
    return layout.pack_batches(layout.assign_chunk(numbered))


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Small tensors as arrays ``(vec_id, label, pixels)``."""
    half = F.lit(0.5).cast("float")
    channels = F.transform("embedding", lambda x: F.array(x, -x, x * half))
    return table(spark, sf_dir, "embeddings").select(
        "vec_id", "label", F.flatten(channels).alias("pixels")
    )


def tensors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Small tensors as bytes ``(vec_id, label, tensor)``."""
    return vectors(spark, sf_dir).select("vec_id", "label", T.to_bytes("pixels").alias("tensor"))


def exploded(df: DataFrame, array: Column, digits: int | None = None) -> DataFrame:
    """One row ``(vec_id, i, value)`` per array element."""
    rows = df.select("vec_id", F.posexplode(array).alias("i", "value"))
    value = F.col("value").cast("double")
    return rows.select("vec_id", "i", (value if digits is None else F.round(value, digits)).alias("value"))
