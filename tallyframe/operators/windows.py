"""Versions, first rows, running totals, intervals and islands.

One key may hold a large share of all rows. Top-1 filters keep one row per key and
map task before they shuffle (WindowGroupLimit); totals and running sums are built
from map-side aggregates and joined back, instead of sorting a whole key in one task.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..params import OPEN_END
from .joins import same_key


def first_in(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key in a total order."""
    rank = F.row_number().over(W.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where(F.col("_rank") == 1).drop("_rank")


def latest_version(df: DataFrame, keys: Sequence[str], newest: Sequence[str]) -> DataFrame:
    """The newest version of each key in a change log, NULL order values last."""
    return first_in(df, keys, [F.col(c).desc_nulls_last() for c in newest])


def partition_total(df: DataFrame, keys: Sequence[str], **totals: Column) -> DataFrame:
    """Every row with the totals of its key (NULL keys form one key)."""
    sums = df.groupBy(*keys).agg(*[expr.alias(name) for name, expr in totals.items()])
    return (
        df.alias("r").join(sums.alias("s"), same_key(keys, "r", "s"), "left")
        .select("r.*", *[F.col(f"s.{name}").alias(name) for name in totals])
    )


def day_running_sum(df: DataFrame, keys: Sequence[str], day: str, value: Column, name: str = "running") -> DataFrame:
    """Per key and day: the day's sum and the running sum up to and with that day.

    Equal to an ordered sum with the default RANGE frame over day ties. Rows shrink to one
    per key and day before the ordered window, so a key brings at most its days.
    """
    daily = df.groupBy(*keys, day).agg(F.sum(value).alias("day_sum"))
    upto = W.partitionBy(*keys).orderBy(day).rowsBetween(W.unboundedPreceding, 0)
    return daily.withColumn(name, F.sum("day_sum").over(upto))


def running_sum(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, name: str, block: Column
) -> DataFrame:
    """Row-level running sum in a total order, without sorting a whole key in one task.

    ``block`` must not decrease along ``order`` (such as the hour of a time stamp). Each
    block is summed on the map side, blocks are accumulated per key, and only the rows
    inside a block are ordered.
    """
    df = df.withColumn("_block", block)
    blocks = df.groupBy(*keys, "_block").agg(F.sum(value).alias("_sum"))
    before = W.partitionBy(*keys).orderBy("_block").rowsBetween(W.unboundedPreceding, -1)
    zero = F.lit(0).cast(blocks.schema["_sum"].dataType)
    blocks = blocks.select(*keys, "_block", F.coalesce(F.sum("_sum").over(before), zero).alias("_before"))
    inside = W.partitionBy(*keys, "_block").orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    rows = df.withColumn("_inside", F.sum(value).over(inside))
    return (
        rows.alias("r").join(blocks.alias("s"), same_key([*keys, "_block"], "r", "s"), "left")
        .select("r.*", (F.col("s._before") + F.col("r._inside")).alias(name))
        .drop("_block", "_inside")
    )


def close_intervals(
    df: DataFrame, keys: Sequence[str], start: str, end: str, open_end: date = OPEN_END
) -> DataFrame:
    """End each row the day before the key's next start; the last one stays open.

    Expects one row per key and start day, so a key brings at most its days.
    """
    following = F.lead(start).over(W.partitionBy(*keys).orderBy(start))
    return df.withColumn(end, F.coalesce(F.date_sub(following, 1), F.lit(open_end)))


# -- calendar: one row per day, so an unpartitioned window stays at thousands of rows --

def mark_edges(cal: DataFrame, day: str = "calendar_date", flag: str = "holiday_flag") -> DataFrame:
    """2 on the first working day after a holiday run, 1 on the last one before it."""
    w = W.orderBy(day)
    holiday = F.col(flag).eqNullSafe(True)
    after = F.coalesce(F.lag(holiday).over(w), F.lit(False))
    ahead = F.coalesce(F.lead(holiday).over(w), F.lit(False))
    return cal.withColumn("day_type", F.when(after & ~holiday, 2).when(ahead & ~holiday, 1))


def holiday_islands(cal: DataFrame, day: str = "calendar_date", flag: str = "holiday_flag") -> DataFrame:
    """One row per run of holidays: last working day before it, first one after it.

    Consecutive holidays share ``date - row number``. The calendar has one row per day;
    a run that opens the calendar starts on the calendar's first day.
    """
    off = cal.where(F.col(flag)).select(day)
    run = off.withColumn("_run", F.date_sub(F.col(day), F.row_number().over(W.orderBy(day))))
    first = cal.agg(F.min(day).alias("d"))
    return (
        run.groupBy("_run")
        .agg(
            F.greatest(F.date_sub(F.min(day), 1), first.scalar()).alias("start_date"),
            F.date_add(F.max(day), 1).alias("finish_date"),
        )
        .drop("_run")
    )
