"""Operators for large-scale training-data pipelines.

Nothing else in the package imports this subpackage; it can be removed as a
whole. ``queries`` holds the registered queries and their SQL.
"""
