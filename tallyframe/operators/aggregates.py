"""Aggregations. All of them combine on the map side, so hot keys do not pile up rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.money import MONEY, signed


def signed_sum(amount: Column, negative: Column) -> Column:
    return F.sum(signed(amount, negative))


def pivot_sum(
    df: DataFrame, keys: Sequence[str], type_col: str, columns: dict[str, str], amount: str, scale: int = 2
) -> DataFrame:
    """One rounded sum per known type, zero where a type has no rows.

    ``columns`` maps the type value to the output column. The types are known up front,
    so this is a single aggregate: no job to discover the pivot values.
    """
    zero = F.lit(0).cast(MONEY)
    return df.groupBy(*keys).agg(*[
        F.round(F.sum(F.when(F.col(type_col) == t, F.col(amount)).otherwise(zero)), scale).alias(name)
        for t, name in columns.items()
    ])


def violation_summary(df: DataFrame, cls: str, amount: str, severity: str, levels: dict[str, str]) -> DataFrame:
    """Count, sum, mean, max and per-severity counts of violations by class."""
    return df.groupBy(cls).agg(
        F.count(F.lit(1)).alias("total_violations"),
        F.sum(amount).alias("total_violation_amount"),
        F.avg(amount).alias("avg_violation_amount"),
        F.max(amount).alias("max_violation_amount"),
        *[F.count_if(F.col(severity) == level).alias(name) for level, name in levels.items()],
    )


def check_nonzero(df: DataFrame, col: str, **more: Column) -> DataFrame:
    """One row: does ``col`` add up to something, and does any single row differ?

    ``net_differs`` lets opposite differences cancel and is NULL-free (no rows = false);
    ``gross_differs`` does not cancel. ``more`` adds aggregates of the same pass.
    """
    return df.agg(
        F.coalesce(F.sum(col) != 0, F.lit(False)).alias("net_differs"),
        F.coalesce(F.sum(F.abs(F.col(col))) != 0, F.lit(False)).alias("gross_differs"),
        F.count(F.lit(1)).alias("n_rows"),
        *[c.alias(name) for name, c in more.items()],
    )
