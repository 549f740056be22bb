"""Comparison of two registers.

Registers hold one row per key (aggregate or take the latest version first), so a full
join never multiplies the rows of a key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.rules import classify

Rule = tuple[str, Column]


def full_compare(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Full join: the keys, ``a_*`` and ``b_*`` values and ``in_a`` / ``in_b``."""
    def side(df: DataFrame, name: str) -> DataFrame:
        values = [F.col(c).alias(f"{name}_{c}") for c in df.columns if c not in keys]
        return df.select(*keys, *values, F.lit(True).alias(f"in_{name}"))

    joined = side(a, "a").join(side(b, "b"), list(keys), "full")
    return joined.withColumns({f: F.coalesce(F.col(f), F.lit(False)) for f in ("in_a", "in_b")})


def merge_registers(first: DataFrame, second: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One register from two: the first one's value wins where it is not NULL."""
    both = full_compare(first, second, keys)
    return both.select(*keys, *[
        F.coalesce(f"a_{c}", f"b_{c}").alias(c) for c in first.columns if c not in keys
    ])


def compare_registers(
    a: DataFrame, b: DataFrame, keys: Sequence[str], rules: Sequence[Rule], label: str = "error_name"
) -> DataFrame:
    """Rows that break a rule, with the first rule they break."""
    return (
        full_compare(a, b, keys)
        .withColumn(label, classify(rules))
        .where(F.col(label).isNotNull())
    )


def differs(a: str, b: str, null_safe: bool = False) -> Column:
    """Values differ. By default a NULL side is no difference; ``null_safe`` reports it."""
    return ~F.col(a).eqNullSafe(F.col(b)) if null_safe else F.col(a) != F.col(b)


def missing_in(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``a`` whose key is not in ``b``; copies of a key in ``b`` fold before the join.

    Keys are small when compressed, so by bytes Spark would merge partitions until a task sorts tens of millions of
    them. The join keeps the session's number of partitions, which is not merged.
    """
    parts = int(a.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return a.join(b.select(*keys).repartition(parts, *keys).distinct(), list(keys), "left_anti")


def compare_amounts(
    a: DataFrame, b: DataFrame, keys: Sequence[str], amount: str, only_diff: bool = False
) -> DataFrame:
    """Amounts of two sides per key, summed before they meet; a missing side counts as 0."""
    def total(df: DataFrame) -> DataFrame:
        return df.groupBy(*keys).agg(F.sum(amount).alias("amount"))

    both = full_compare(total(a), total(b), keys)
    zero = F.lit(0)
    out = both.select(
        *keys, "in_a", "in_b",
        F.coalesce(F.col("a_amount"), zero).alias("amount_a"),
        F.coalesce(F.col("b_amount"), zero).alias("amount_b"),
    ).withColumn("diff", F.col("amount_a") - F.col("amount_b"))
    return out.where(F.col("diff") != 0) if only_diff else out


def totals_diff(a: DataFrame, b: DataFrame, measures: Sequence[str]) -> DataFrame:
    """One row: each measure's total on both sides and the difference."""
    def tagged(df: DataFrame, sign: int) -> DataFrame:
        return df.select(F.lit(sign).alias("side"), *measures)

    side = F.col("side")
    both = tagged(a, 1).unionByName(tagged(b, -1))
    totals = both.agg(*[
        F.coalesce(F.sum(F.when(side == sign, F.col(m))), F.lit(0)).alias(f"{m}_{name}")
        for m in measures for sign, name in ((1, "a"), (-1, "b"))
    ])
    return totals.withColumns({f"{m}_diff": F.col(f"{m}_a") - F.col(f"{m}_b") for m in measures})
