"""Operators: ``DataFrame -> DataFrame`` functions, lazy, usable in batch and on streams where noted."""
