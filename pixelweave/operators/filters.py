"""Row filters. Class and split filters are plain predicates, so they reach the scan."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from pixelweave import fixed
from pixelweave.functions.labels import has_prefix
from pixelweave.functions.tensors import payload_fits
from pixelweave.operators.joins import exists_in


def keep_classes(
    df: DataFrame, classes: Sequence = fixed.TARGET_CLASSES, col: str = "label"
) -> DataFrame:
    """Rows whose label is in the class list."""
    return df.where(F.col(col).isin(list(classes)))


def select_split(df: DataFrame, split: str) -> DataFrame:
    """Rows of one split; prunes directories on tables partitioned by split."""
    return df.where(F.col("split") == split)


def drop_missing_source(df: DataFrame, listing: DataFrame, on: str = "path") -> DataFrame:
    """Rows whose source file is in the listing."""
    return exists_in(df, listing, on)


def drop_invalid(df: DataFrame, *required: str) -> DataFrame:
    """Rows in which every required column could be produced."""
    return df.where(_all_present(required))


def reject_reason(**checks: Column) -> Column:
    """Name of the first failed check, or null for a row that is kept."""
    return F.coalesce(*[F.when(~F.coalesce(ok, F.lit(False)), name) for name, ok in checks.items()])


def drop_bad_payload(
    df: DataFrame, h: int, w: int, c: int = 3, col: str = "tensor"
) -> DataFrame:
    """Rows whose payload has the size of one ``h`` x ``w`` x ``c`` tensor."""
    return df.where(payload_fits(col, (h, w, c)))


def name_prefix(df: DataFrame, prefix: str = fixed.BATCH_PREFIX, col: str = "name") -> DataFrame:
    """Rows whose name starts with the prefix."""
    return df.where(has_prefix(col, prefix))


def _all_present(columns: Sequence[str]) -> Column:
    kept = F.lit(True)
    for c in columns:
        kept = kept & F.col(c).isNotNull()
    return kept
