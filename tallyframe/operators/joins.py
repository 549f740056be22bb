"""Joins the reports share."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def same_key(keys: Sequence[str], left: str, right: str) -> Column:
    """Key equality of two aliased frames in which NULL matches NULL; still an equi-join."""
    return reduce(lambda a, b: a & b, [F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}")) for k in keys])


def semi(df: DataFrame, key: str, other: DataFrame, other_key: str) -> DataFrame:
    """Rows of ``df`` whose ``key`` is among ``other_key``.

    The other side is made distinct first: copies of a key fold on the map side, and the
    join reuses the partitioning of that aggregate.
    """
    keys = other.select(F.col(other_key).alias("_key")).distinct()
    return df.join(keys, F.col(key) == F.col("_key"), "left_semi")


def left_join(df: DataFrame, other: DataFrame, key: str, other_key: str) -> DataFrame:
    """Left join on differently named keys: one scan of either side.

    Where ``other`` is large, its rows should be few per key: aggregate it first where the report allows.
    Spark splits a hot key of the left side.
    """
    return df.join(other, F.col(key) == F.col(other_key), "left")


def semi_chain(df: DataFrame, key: str, links: Sequence[tuple[DataFrame, str, str | None]]) -> DataFrame:
    """Rows of ``df`` reachable through a chain of tables.

    Each link is ``(table, column matched from the left, column leading on)``. The chain
    is folded from its far end, so each table is cut by the ones behind it before it
    meets the next one.
    """
    reachable: DataFrame | None = None
    next_key: str | None = None
    for table, match, onward in reversed(links):
        if reachable is not None:
            table = semi(table, onward, reachable, next_key)
        reachable, next_key = table.select(match), match
    return semi(df, key, reachable, next_key)


def densify(
    entities: DataFrame, type_col: str, types: Sequence[str], facts: DataFrame,
    keys: Sequence[str], fill: dict[str, Column],
) -> DataFrame:
    """Every entity with every type; values without a fact get their default.

    The fixed type list is unrolled on each entity row, so no cross join is planned.
    """
    skeleton = entities.withColumn(type_col, F.explode(F.array(*[F.lit(t) for t in types])))
    joined = skeleton.join(facts, [*keys, type_col], "left")
    return joined.withColumns({c: F.coalesce(F.col(c), default) for c, default in fill.items()})


def lookup(df: DataFrame, dims: Sequence[tuple[DataFrame, str, str]], how: str = "left") -> DataFrame:
    """Chain of dimension joins: ``(dimension, column here, key there)``."""
    for dim, here, there in dims:
        df = df.join(dim.withColumnRenamed(there, "_key"), F.col(here) == F.col("_key"), how).drop("_key")
    return df
