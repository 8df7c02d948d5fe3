"""Counts, shares and evaluation metrics. All aggregate partially before they shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from pixelweave import fixed
from pixelweave.operators.joins import class_list, zero_fill



def class_histogram(
    df: DataFrame, classes: Sequence, zero_filled: bool = False, label: str = "label"
) -> DataFrame:
    """Rows per listed class; absent classes are left out or, on request, counted as 0."""
    counts = (
        df.where(F.col(label).isin(list(classes)))
        .groupBy(label)
        .agg(F.count("*").alias("n"))
    )
    if not zero_filled:
        return counts
    return zero_fill(counts, class_list(df.sparkSession, classes, label), label)


def totals(df: DataFrame, by: str | None = None) -> DataFrame:
    """Row count of the table, or of every value of ``by``."""
    return df.groupBy(*([by] if by else [])).agg(F.count("*").alias("n"))


def ceil_div(n: Column, size: int) -> Column:
    """Integer ``ceil(n / size)``."""
    return F.floor((n + F.lit(size - 1)) / F.lit(size)).cast("bigint")


def chunk_count(df: DataFrame, size: int = fixed.CHUNK_SIZE) -> DataFrame:
    """Number of chunks of the table."""
    return df.agg(ceil_div(F.count("*"), size).alias("chunks"))


def steps_per_epoch(df: DataFrame, batch: int = fixed.MINIBATCH_SIZE) -> DataFrame:
    """Number of training steps of one pass over the table."""
    return df.agg(ceil_div(F.count("*"), batch).alias("steps"))


def batch_count(df: DataFrame) -> DataFrame:
    """Number of batches of the table."""
    return df.agg(F.count_distinct("batch_id").alias("num_batches"))


def batch_sizes(
    df: DataFrame, classes: Sequence | None = None, label: str = "label"
) -> DataFrame:
    """Rows per batch; with a class list only its rows, and 0 for a batch without any."""
    if classes is None:
        return totals(df, "batch_id")
    kept = batch_kept_counts(df, classes, label)
    return kept.select("batch_id", F.col("n_kept").alias("n"))


def block_size(df: DataFrame) -> DataFrame:
    """Rows per chunk."""
    return totals(df, "chunk_id")


def batch_kept_counts(df: DataFrame, classes: Sequence, label: str = "label") -> DataFrame:
    """Rows loaded and rows kept by the class filter, per batch; a batch may keep none."""
    return df.groupBy("batch_id").agg(
        F.count("*").alias("n_loaded"),
        F.count_if(F.col(label).isin(list(classes))).alias("n_kept"),
    )


def num_classes(df: DataFrame, label: str = "label") -> DataFrame:
    """Number of distinct labels."""
    return df.agg(F.count_distinct(label).alias("num_classes"))


def any_rows(df: DataFrame) -> DataFrame:
    """One row: whether the table has any."""
    return df.limit(1).agg((F.count("*") > 0).alias("any_rows"))


def class_share(df: DataFrame, label: str = "label") -> DataFrame:
    """Rows per label and their share of all rows."""
    counts = totals(df, label)
    whole = counts.agg(F.sum("n")).scalar()
    return counts.withColumn("share", F.col("n") / whole)


def class_weights(df: DataFrame, label: str = "label") -> DataFrame:
    """Weight of every class that balances the classes: ``total / (classes * rows)``."""
    counts = totals(df, label)
    whole = counts.agg((F.sum("n") / F.count("*")).alias("mean_rows")).scalar()
    return counts.withColumn("weight", whole / F.col("n"))


def cross_entropy(probs: Column, label: Column, eps: float = fixed.PROBABILITY_FLOOR) -> Column:
    """Loss of one row; the probability is kept inside ``[eps, 1 - eps]``."""
    p_true = F.get(probs, label.cast("int")).cast("double")
    return -F.log(F.least(F.greatest(p_true, F.lit(eps)), F.lit(1.0 - eps)))


def predicted_class(probs: Column) -> Column:
    """Index of the largest probability; the lowest index wins a tie."""
    return (F.array_position(probs, F.array_max(probs)) - 1).cast("int")


def mean_cross_entropy(
    df: DataFrame, probs: str, label: str, eps: float = fixed.PROBABILITY_FLOOR
) -> DataFrame:
    """Mean loss over all rows."""
    return df.agg(F.avg(cross_entropy(F.col(probs), F.col(label), eps)).alias("loss"))


def accuracy(df: DataFrame, probs: str, label: str) -> DataFrame:
    """Share of rows whose predicted class is the label."""
    return df.agg(F.avg(_hit(probs, label)).alias("accuracy"))


def evaluation(
    df: DataFrame, probs: str, label: str, eps: float = fixed.PROBABILITY_FLOOR
) -> DataFrame:
    """Loss and accuracy from one pass over the scores."""
    return df.agg(
        F.avg(cross_entropy(F.col(probs), F.col(label), eps)).alias("loss"),
        F.avg(_hit(probs, label)).alias("accuracy"),
    )


def _hit(probs: str, label: str) -> Column:
    return (predicted_class(F.col(probs)) == F.col(label)).cast("double")


def last_epoch_metric(history: DataFrame, metric: str, epoch: str = "epoch") -> DataFrame:
    """Value of a metric in the last epoch."""
    return history.agg(F.max_by(metric, epoch).alias(metric))


def best_candidate(scores: DataFrame, candidate: str, metric: str) -> DataFrame:
    """Candidate with the best score; the smallest candidate wins a tie."""
    best = F.min_by(F.struct(candidate, metric), F.struct(-F.col(metric), F.col(candidate)))
    return scores.agg(best.alias("best")).select("best.*")
