"""Operators for training-data pipelines over a ``documents`` table; nothing else in the library uses them."""
