"""Shared working storage for intermediate tables.

Intermediate tables are written to the folder the session names in
``spark.checkpoint.dir``. They cut lineage: an executor lost later costs a re-read of
a file, not a re-run of the sort that produced it.
"""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

from pixelweave.functions.storage import locate

_SETTING = "spark.checkpoint.dir"


_scratch: list[str] = []


def _local_scratch() -> str:
    if not _scratch:
        _scratch.append(tempfile.mkdtemp(prefix="pixelweave-"))
    return _scratch[0]


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach; a private one only for a local master."""
    root = spark.conf.get(_SETTING, None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {_SETTING} to a folder that all executors share")
    return _local_scratch()


def one_row(spark: SparkSession) -> DataFrame:
    """One row ``(id = 0)`` in one partition, to hang literals on."""
    return spark.range(0, 1, 1, numPartitions=1)


_scopes: list[list[str]] = []


@contextlib.contextmanager
def scope() -> Iterator[None]:
    """Delete the working tables made inside the block when it ends.

    Results must be written by then, as a DataFrame built inside still reads these tables.
    Without a scope they stay until the shared folder is cleared.
    """
    made: list[str] = []
    _scopes.append(made)
    try:
        yield
    finally:
        _scopes.remove(made)
        for path in made:
            # A folder that cannot be deleted from here is left to whoever clears the place.
            with contextlib.suppress(OSError):
                filesystem, place = locate(path)
                filesystem.delete_dir(place)


def fresh_path(spark: SparkSession, purpose: str) -> str:
    """A path nobody has used before, under the shared folder."""
    path = f"{shared_dir(spark)}/pixelweave/{purpose}-{uuid.uuid4().hex}"
    if _scopes:
        _scopes[-1].append(path)
    return path


def materialize(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` once as Parquet in shared storage and return the table read back."""
    spark = df.sparkSession
    path = fresh_path(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
