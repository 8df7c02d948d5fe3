"""Concatenation of chunk blocks and of splits."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F


def union_chunks(*dfs: DataFrame) -> DataFrame:
    """All rows of all inputs; columns are matched by name."""
    return reduce(DataFrame.unionByName, dfs)


def all_splits(**dfs: DataFrame) -> DataFrame:
    """Several splits as one table; the argument name becomes column ``split``."""
    return union_chunks(*[df.withColumn("split", F.lit(name)) for name, df in dfs.items()])
