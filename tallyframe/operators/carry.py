"""The last value before a row, for keys of any size; as-of joins and allocation are built on it.

Rows are range-partitioned by key and order, so a key with half of all rows is many parts. Every part fills its own
rows; what a part begins with comes from the parts before it, one row per part and key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import materialize
from .joins import same_key


def in_parts(df: DataFrame, keys: Sequence[str], order: Sequence[str], parts: int | None = None) -> DataFrame:
    """The rows with ``_part``: ranges of (key, order), written, so that a part stays what it is."""
    ranges = df.repartitionByRange(*([parts] if parts else []), *keys, *order)
    return materialize(ranges.withColumn("_part", F.spark_partition_id()), "parts")


def carry_last(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, name: str, parts: int | None = None
) -> DataFrame:
    """Every row with the last non-NULL ``value`` of its key up to and with the row, as ``name``.

    ``order`` holds columns that give a total order within a key, ascending, NULL first (negate a number to descend).
    NULL keys form one key. A window never holds more of a key than one part.
    """
    placed = in_parts(df, keys, order, parts)
    inside = W.partitionBy(*keys, "_part").orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    filled = placed.withColumn("_own", F.last(value, ignorenulls=True).over(inside))
    ends = placed.groupBy(*keys, "_part").agg(
        F.max(F.when(F.col(value).isNotNull(), F.struct(*order, F.col(value).alias("_value")))).alias("_end"))
    before = W.partitionBy(*keys).orderBy("_part").rowsBetween(W.unboundedPreceding, -1)  # a row per part of a key
    # only a part's first key can go on from the part before: at most one row per part is left
    carried = ends.withColumn("_carried", F.last("_end", ignorenulls=True).over(before)).where(F.col("_carried").isNotNull())
    both = filled.alias("r").join(carried.alias("s"), same_key([*keys, "_part"], "r", "s"), "left")
    return both.select("r.*", F.coalesce("r._own", "s._carried._value").alias(name)).drop("_own", "_part")


def asof_join(
    left: DataFrame, right: DataFrame, keys: Sequence[str], left_time: str, right_time: str, payload: Sequence[str],
    tie: str, parts: int | None = None,
) -> DataFrame:
    """Every row of ``left`` with the ``payload`` of the key's last row of ``right`` at or before it (else NULLs).

    Among rows of ``right`` of one time, the one with the greatest ``tie`` counts. NULL keys match each other; rows of
    ``right`` without a time match nothing, rows of ``left`` without one match nothing. Payload names must not occur in ``left``.
    """
    here = left.select(
        *keys, F.col(left_time).alias("_at"), F.lit(1).alias("_side"), F.lit(None).cast(right.schema[tie].dataType).alias("_tie"),
        F.struct(*left.columns).alias("_row"))
    there = right.where(F.col(right_time).isNotNull()).select(
        *keys, F.col(right_time).alias("_at"), F.lit(0).alias("_side"), F.col(tie).alias("_tie"), F.struct(*payload).alias("_found"))
    rows = there.unionByName(here, allowMissingColumns=True)
    filled = carry_last(rows, keys, ["_at", "_side", "_tie"], "_found", "_last", parts)
    found = F.when(F.col("_at").isNotNull(), F.col("_last"))
    return filled.where("_side = 1").withColumn("_last", found).select("_row.*", *[F.col(f"_last.{c}").alias(c) for c in payload])
