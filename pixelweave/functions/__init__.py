"""Column functions: labels and names (JVM expressions) and tensors (Arrow batches)."""
