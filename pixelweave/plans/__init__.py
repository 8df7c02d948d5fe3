"""Registered queries: each binds an operator to the given tables, next to its SQL check."""

from pixelweave.plans import images, labels, layout, learning, streams, tensors  # noqa: F401
from pixelweave.plans.registry import oracle_sql, queries  # noqa: F401
