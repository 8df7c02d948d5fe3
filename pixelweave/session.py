"""Session settings that suit wide tensor rows; used by the tests and the benchmark."""

from __future__ import annotations

import contextlib
import os
import tempfile
from collections.abc import Iterator

from pyspark.sql import SparkSession

# A 224x224x3 float tensor is about 600 KB, so the default 4,096-row column batch would
# need 2.5 GB. Both limits keep one batch of full-size tensors near 20-40 MB.
TENSOR_SETTINGS = {
    "spark.sql.parquet.columnarReaderBatchSize": "32",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "64",
}


@contextlib.contextmanager
def tensor_settings(spark: SparkSession) -> Iterator[SparkSession]:
    """The wide-row limits while full-size tensors are read; then the session's own again."""
    before = {key: spark.conf.get(key, None) for key in TENSOR_SETTINGS}
    for key, value in TENSOR_SETTINGS.items():
        spark.conf.set(key, value)
    try:
        yield spark
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def local_session(name: str = "pixelweave", cpus: str | int = "*") -> SparkSession:
    """Local session for tests and benchmarks."""
    slots = (os.cpu_count() or 1) if cpus == "*" else int(cpus)
    builder = (
        SparkSession.builder.master(f"local[{slots}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "8g"))
        .config("spark.sql.shuffle.partitions", str(slots))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.showConsoleProgress", "false")
    )
    spark = builder.getOrCreate()
    if spark.conf.get("spark.checkpoint.dir", None) is None:
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="pixelweave-ckpt-"))
    spark.sparkContext.setLogLevel("ERROR")
    return spark
