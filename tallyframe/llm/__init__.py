"""Operators for training-data pipelines and their queries over the given tables.

Each module holds one operator with its own general interface; ``queries`` holds the thin
queries that apply them to whole tables. Nothing else in the package imports this folder.
"""

from .queries import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
