"""Comparison of two large registers that are mostly equal, by a tree of digests.

Keys are hashed into a tree of ranges. Both sides sum the hashes of their rows by range, and only ranges whose
sums differ are looked at again, one level deeper. Equal ranges send nothing but their sums over the network; the
rows of what is left meet in one full join.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .compare import full_compare

#: Ranges of a level split into 2 ** BITS of the next one.
BITS = 12
LEVELS = 5
#: A level is worth its scan while the rows in differing ranges are more than this many times the ranges.
ROWS_PER_RANGE = 4
_SUMS = ["n", "s1", "s2", "s3", "s4"]


def _hash(seed: int, columns: Sequence[str]) -> Column:
    """NULLs count by their place: a hash of values alone would pass over them."""
    return F.xxhash64(F.lit(seed), *[x for c in columns for x in (F.col(f"`{c}`").isNull(), F.col(f"`{c}`"))])


def range_of(keys: Sequence[str], level: int) -> Column:
    """The range of a key on a level: the first bits of its hash."""
    return F.shiftrightunsigned(_hash(0, keys), 64 - BITS * level)


def range_sums(df: DataFrame, keys: Sequence[str], level: int) -> DataFrame:
    """(range, n, s1 .. s4): rows and sums of 32-bit parts of two row hashes, which cannot overflow nor cancel."""
    rest = sorted(c for c in df.columns if c not in keys)
    one, two = _hash(1, [*keys, *rest]), _hash(2, [*keys, *rest])
    low, high = (lambda h: h.bitwiseAND(F.lit(0xFFFFFFFF))), (lambda h: F.shiftrightunsigned(h, 32))
    return df.groupBy(range_of(keys, level).alias("range")).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.sum(part).alias(name) for name, part in zip(_SUMS[1:], (low(one), high(one), low(two), high(two)))])


def open_rows(df: DataFrame, keys: Sequence[str], level: int, ranges: DataFrame | None) -> DataFrame:
    """Rows in the given ranges of a level; the ranges are few, so Spark sends them to the rows, not the other way."""
    if ranges is None:
        return df
    at = range_of(keys, level)
    return df.withColumn("_range", at).join(ranges.select(F.col("range").alias("_range")), "_range", "left_semi").drop("_range")


def differing_ranges(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> tuple[int, DataFrame | None]:
    """The level that was reached and its differing ranges with their rows; None when the sides are equal."""
    ranges, level = None, 0
    while True:
        above = ranges
        left, right = (range_sums(open_rows(x, keys, level, above), keys, level + 1) for x in (a, b))
        same = reduce(lambda x, y: x & y, [F.col(f"a_{c}").eqNullSafe(F.col(f"b_{c}")) for c in _SUMS])
        found = full_compare(left, right, ["range"]).where(~same).select(
            "range", F.greatest(F.coalesce("a_n", F.lit(0)), F.coalesce("b_n", F.lit(0))).alias("n"))
        level, ranges = level + 1, materialize(found, "ranges")
        state = ranges.agg(F.count(F.lit(1)).alias("ranges"), F.sum("n").alias("rows")).first()
        if not state["ranges"]:
            return level, None
        if level == LEVELS or state["rows"] <= ROWS_PER_RANGE * state["ranges"]:
            return level, ranges


def tree_compare(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows of ``full_compare(a, b, keys)`` whose sides differ in presence or in any value (NULL equals NULL).

    Both registers have the same columns and one row per key, NULL keys left out. They are read once per level and
    once for the join; the levels end where differing ranges hold few rows each, so registers without a difference
    are read once and send at most 2 ** BITS sums per task. Rows count as equal when 128 bits of their hashes do.
    """
    a, b = (x.dropna(subset=list(keys)).select(*a.columns) for x in (a, b))
    level, ranges = differing_ranges(a, b, keys)
    left, right = (x.where("false") if ranges is None else open_rows(x, keys, level, ranges) for x in (a, b))
    values = [c for c in a.columns if c not in keys]
    same = reduce(lambda x, y: x & y, [F.col(f"a_{c}").eqNullSafe(F.col(f"b_{c}")) for c in values], F.col("in_a") & F.col("in_b"))
    return full_compare(left, right, keys).where(~same)
