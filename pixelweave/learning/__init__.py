"""Classifier training, scoring and selection on Spark ML and Arrow batches."""
