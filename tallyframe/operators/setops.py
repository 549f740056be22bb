from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame


def union_sources(*dfs: DataFrame) -> DataFrame:
    """UNION ALL by column name."""
    return reduce(lambda a, b: a.unionByName(b), dfs)


def union_aligned(columns: Sequence[str], *dfs: DataFrame) -> DataFrame:
    """UNION ALL of the named columns in one order."""
    return union_sources(*[df.select(*columns) for df in dfs])
