"""Operators of a large-scale training-data pipeline, and their queries.

Nothing outside this package imports it; it may import the library's helpers.
"""
