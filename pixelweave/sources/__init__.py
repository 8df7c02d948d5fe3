"""Scans: annotated samples, image files, label files, metadata and chunk tables."""
