from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.rules import map_value


def rank_sort(df: DataFrame, ranks: Mapping[str, Sequence[str]], then: Sequence[Column]) -> DataFrame:
    """Order by the place of each value in its list (others last), then by ``then``."""
    keys = [
        map_value(F.col(c), {v: i for i, v in enumerate(values)}, len(values))
        for c, values in ranks.items()
    ]
    return df.orderBy(*keys, *then)


def first_by(df: DataFrame, *order: Column) -> DataFrame:
    """The first row; planned as a distributed top-1, not a full sort."""
    return df.orderBy(*order).limit(1)


def sample_n(df: DataFrame, n: int, *order: Column) -> DataFrame:
    """``n`` rows to show. An order is required, so the sample is repeatable."""
    if not order:
        raise ValueError("sample_n needs an order")
    return df.orderBy(*order).limit(n)
