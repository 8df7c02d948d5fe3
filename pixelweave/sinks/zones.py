"""Zone map of a chunked table: which chunks each of its files holds.

The map is a small table ``(file, split, first, last, n)`` with one row per run of consecutive
chunk ids in a file. It is built from the chunk column of the written files, lies inside their
folder under a name that scans pass over, and becomes valid in the same commit as the rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import StructType

_FOLDER = "_zones"
NOTE = "zones"


def build(spark: SparkSession, path: str, schema: StructType) -> dict:
    """Write the map of the files below ``path``, by split; the note that names it."""
    own = path.rstrip("/").rsplit("/", 1)[-1]
    file = F.substring_index(F.col("_metadata.file_path"), own + "/", -1)
    # The split comes from the folder names, so only chunk ids are read.
    rows = spark.read.schema(schema).parquet(path).select(
        file.alias("file"), F.col("split").cast("string").alias("split"), F.col("chunk_id").cast("bigint")
    )
    held = rows.where(F.col("chunk_id").isNotNull()).groupBy("file", "split", "chunk_id").agg(F.count("*").alias("n"))
    # A window holds the chunk ids of one file.
    run = F.col("chunk_id") - F.row_number().over(Window.partitionBy("file").orderBy("chunk_id"))
    runs = held.withColumn("run", run).groupBy("file", "split", "run").agg(
        F.min("chunk_id").alias("first"), F.max("chunk_id").alias("last"), F.sum("n").alias("n")
    )
    runs.drop("run").write.parquet(f"{path}/{_FOLDER}")
    return {NOTE: _FOLDER}


def load(spark: SparkSession, path: str) -> DataFrame:
    """The map of the files below ``path``."""
    schema = "file string, split string, first bigint, last bigint, n bigint"
    return spark.read.schema(schema).parquet(f"{path}/{_FOLDER}")


def overlapping(zones: DataFrame, start: int, end: int, split: str | None = None) -> DataFrame:
    """Files with a chunk of ``[start, end)``; the predicates reach the map's own scan."""
    own = zones if split is None else zones.where(F.col("split") == split)
    return own.where((F.col("first") < end) & (F.col("last") >= start)).select("file").distinct()


def chunk_ids(zones: DataFrame, split: str | None = None) -> DataFrame:
    """All chunk ids that occur; no row of the table is read."""
    own = zones if split is None else zones.where(F.col("split") == split)
    return own.select(F.explode(F.sequence("first", "last")).alias("chunk_id"))
