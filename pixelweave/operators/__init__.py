"""Relational operators: numbering, layout, joins, aggregates and images."""
