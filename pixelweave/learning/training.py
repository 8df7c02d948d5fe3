"""Fit, save, load and select multi-class classifiers with Spark ML."""

from __future__ import annotations

import itertools
from collections.abc import Mapping, Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, MultilayerPerceptronClassifier
from pyspark.ml.feature import IndexToString, StringIndexerModel
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, functions as F

from pixelweave import fixed
from pixelweave.learning.scoring import evaluate
from pixelweave.operators.aggregates import class_weights


def label_encoder(
    classes: Sequence[str], label: str = "label", output: str = "label_idx"
) -> StringIndexerModel:
    """Encoder fixed by the class list; an unknown label is an error."""
    return StringIndexerModel.from_labels(
        list(classes), inputCol=label, outputCol=output, handleInvalid="error"
    )


def label_decoder(
    classes: Sequence[str], index: str = "label_idx", output: str = "label"
) -> IndexToString:
    """Inverse of the encoder."""
    return IndexToString(inputCol=index, outputCol=output, labels=list(classes))


def with_features(df: DataFrame, values: str, output: str = "features") -> DataFrame:
    """Numeric array column as an ML vector."""
    return df.withColumn(output, array_to_vector(F.col(values).cast("array<double>")))


def classifier(
    features: str = "features",
    label: str = "label_idx",
    layers: Sequence[int] | None = None,
    epochs: int = fixed.EPOCHS,
    **params,
):
    """Softmax regression, or a perceptron when hidden ``layers`` are given."""
    if layers:
        return MultilayerPerceptronClassifier(
            featuresCol=features, labelCol=label, layers=list(layers), maxIter=epochs, **params
        )
    return LogisticRegression(
        featuresCol=features, labelCol=label, family="multinomial", maxIter=epochs, **params
    )


def fit_classifier(
    df: DataFrame,
    features: str = "features",
    label: str = "label_idx",
    layers: Sequence[int] | None = None,
    epochs: int = fixed.EPOCHS,
    **params,
) -> PipelineModel:
    """Fit on all rows; every epoch is one distributed pass over the table."""
    return Pipeline(stages=[classifier(features, label, layers, epochs, **params)]).fit(df)


def training_history(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Objective per epoch as ``(epoch, loss)``; as many rows as optimiser steps."""
    summary = model.stages[-1].summary
    # A perceptron's summary is a method, a regression's a property.
    found = summary() if callable(summary) else summary
    losses = [float(x) for x in found.objectiveHistory]
    return df.sparkSession.createDataFrame(list(enumerate(losses)), "epoch int, loss double")


def with_class_weights(df: DataFrame, label: str = "label_idx", output: str = "weight") -> DataFrame:
    """Add the weight of every row's class, for ``weightCol`` of a fit."""
    weights = class_weights(df, label).select(label, F.col("weight").alias(output))
    return df.join(weights, label)


def save_model(model: PipelineModel, path: str) -> None:
    """Save, replacing an earlier model."""
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    """Load a saved model."""
    return PipelineModel.load(path)


def grid_search(
    df: DataFrame,
    grid: Mapping[str, Sequence],
    key: str,
    features: str = "features",
    label: str = "label_idx",
    epochs: int = fixed.EPOCHS,
    train_ratio: float = 0.8,
    seed: int = 0,
) -> tuple[DataFrame, PipelineModel]:
    """Validation accuracy of every combination as ``(candidate, params, accuracy)``, and the
    model of the best one (the first of equals), fitted on the training part.

    Rows are split by a hash of their key, so the result does not depend on partitions.
    """
    share = F.pmod(F.xxhash64(F.lit(seed), F.col(key)), F.lit(1_000_000)) < int(train_ratio * 1_000_000)
    fitted, held_out = df.where(share), df.where(~share)
    names = sorted(grid)
    rows, best, best_accuracy = [], None, -1.0
    for i, values in enumerate(itertools.product(*(grid[n] for n in names))):
        params = dict(zip(names, values))
        model = fit_classifier(fitted, features, label, epochs=epochs, **params)
        accuracy = float(evaluate(held_out, model, features, label).first()["accuracy"] or 0.0)
        rows.append((i, ",".join(f"{n}={v}" for n, v in params.items()), accuracy))
        if accuracy > best_accuracy:
            best, best_accuracy = model, accuracy
    scores = df.sparkSession.createDataFrame(rows, "candidate int, params string, accuracy double")
    return scores, best
