"""Batch scoring and evaluation."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.ml.functions import array_to_vector, predict_batch_udf, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, functions as F, types as T

from pixelweave import fixed
from pixelweave.operators.aggregates import evaluation


def class_means(
    df: DataFrame, values: str, classes: Sequence, label: str = "label"
) -> np.ndarray:
    """Mean vector per class, in class-list order, as a ``classes`` x ``length`` matrix.

    One mean per listed class reaches the driver; this matrix is the model. A class
    without rows gets zeros.
    """
    vectors = df.where(F.col(label).isin(list(classes))).select(
        label, array_to_vector(F.col(values).cast("array<double>")).alias("v")
    )
    means = {
        row[label]: row["mean"].toArray()
        for row in vectors.groupBy(label).agg(Summarizer.mean(F.col("v")).alias("mean")).collect()
    }
    if not means:
        raise ValueError("no rows of the listed classes")
    empty = np.zeros_like(next(iter(means.values())))
    return np.stack([means.get(c, empty) for c in classes])


def softmax(logits: np.ndarray) -> np.ndarray:
    """Row-wise softmax."""
    shifted = np.exp(logits - logits.max(axis=1, keepdims=True))
    return shifted / shifted.sum(axis=1, keepdims=True)


def rows_per_batch(length: int) -> int:
    """Rows of ``length`` numbers that fill about 4 MB, but at least one minibatch."""
    return max(fixed.MINIBATCH_SIZE, min(4096, (4 << 20) // (8 * length)))


def linear_probabilities(
    values: Column | str, weights: np.ndarray, batch_size: int | None = None
) -> Column:
    """Softmax of the dot product with every weight row, one matrix product per batch.

    ``weights`` is shipped with the task; it has one row per class. The batch size has no
    effect on the result.
    """

    def make_predict():
        matrix = np.ascontiguousarray(weights.T)

        def predict(batch: np.ndarray) -> np.ndarray:
            return softmax(batch.astype(np.float64) @ matrix)

        return predict

    udf = predict_batch_udf(
        make_predict,
        return_type=T.ArrayType(T.DoubleType()),
        batch_size=batch_size or rows_per_batch(weights.shape[1]),
        input_tensor_shapes=[[weights.shape[1]]],
    )
    return udf(F.col(values) if isinstance(values, str) else values)


def score(
    df: DataFrame,
    model: PipelineModel | np.ndarray,
    values: str = "features",
    output: str = "probs",
    batch_size: int | None = None,
) -> DataFrame:
    """Add class probabilities, from a Spark ML model or a weight matrix."""
    if isinstance(model, np.ndarray):
        return df.withColumn(output, linear_probabilities(values, model, batch_size))
    return model.transform(df).withColumn(output, vector_to_array("probability"))


def evaluate(
    df: DataFrame,
    model: PipelineModel | np.ndarray,
    values: str = "features",
    label: str = "label_idx",
    batch_size: int | None = None,
) -> DataFrame:
    """Loss and accuracy of a model on labelled rows; one row."""
    return evaluation(score(df, model, values, "probs", batch_size), "probs", label)
