"""Balances from a posting journal.

A journal row has the balance before it, its amount and whether it is a debit.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def as_of_snapshot(
    journal: DataFrame, entity: str, order: Sequence[str], payload: Sequence[str], cutoffs: Mapping[str, date]
) -> DataFrame:
    """Last journal row of each entity before each cut-off, as one struct per cut-off.

    All cut-offs come from a single aggregate over one scan. ``order`` is time first, then
    the row id that breaks ties. A cut-off with no earlier row leaves NULL.
    """
    ts = F.col(order[0])
    row = F.struct(*order, *payload)
    rows = journal.where(ts < F.lit(max(cutoffs.values())))
    return rows.groupBy(entity).agg(*[
        F.max(F.when(ts < F.lit(cutoff), row)).alias(name) for name, cutoff in cutoffs.items()
    ])


def closing(in_balance: Column, amount: Column, debit: Column) -> Column:
    """Balance after a row: a debit lowers it, anything else raises it."""
    return in_balance + F.when(debit, -amount).otherwise(amount)


def as_of_balance(
    journal: DataFrame, entity: str, order: Sequence[str], cutoffs: Mapping[str, date]
) -> DataFrame:
    """Closing balance of each entity before each cut-off: ``(entity, cutoff, balance)``."""
    snap = as_of_snapshot(journal, entity, order, ["in_balance", "amount", "is_debit"], cutoffs)
    points = F.explode(F.array(*[
        F.struct(F.lit(name).alias("cutoff"), F.col(name).alias("row")) for name in cutoffs
    ])).alias("p")
    return (
        snap.select(entity, points)
        .where(F.col("p.row").isNotNull())
        .select(
            entity,
            F.col("p.cutoff").alias("cutoff"),
            closing(F.col("p.row.in_balance"), F.col("p.row.amount"), F.col("p.row.is_debit")).alias("balance"),
        )
    )


def turnover_parts(
    journal: DataFrame, keys: Sequence[str], order: Sequence[str], amounts: Mapping[str, tuple[str, str]]
) -> DataFrame:
    """First row, debits (negative) and credits per key, ready to be folded further.

    ``amounts`` maps an output suffix to its (opening balance, amount) columns. One
    aggregate with a map-side part replaces totals over windows plus a first-row filter,
    so it can run on the bare journal before any account is joined.
    """
    first = F.min(F.struct(*order, *[
        F.col(opening).alias(f"in{suffix}") for suffix, (opening, _) in amounts.items()
    ])).alias("first_row")
    zero = F.lit(0)
    sums = []
    for suffix, (_, amount) in amounts.items():
        sums.append(F.sum(F.when(F.col("is_debit"), -F.col(amount)).otherwise(zero)).alias(f"debit{suffix}"))
        sums.append(F.sum(F.when(~F.col("is_debit"), F.col(amount)).otherwise(zero)).alias(f"credit{suffix}"))
    return journal.groupBy(*keys).agg(first, *sums)


def turnover_of(parts: DataFrame, keys: Sequence[str], suffixes: Sequence[str]) -> DataFrame:
    """Opening balance, debit, credit and closing balance per key, folded from parts."""
    sums = [F.sum(f"{side}{s}").alias(f"{side}{s}") for s in suffixes for side in ("debit", "credit")]
    out = parts.groupBy(*keys).agg(F.min("first_row").alias("first_row"), *sums)
    out = out.withColumns({f"in{s}": F.col(f"first_row.in{s}") for s in suffixes})
    return out.withColumns({
        f"out{s}": F.col(f"in{s}") + F.col(f"debit{s}") + F.col(f"credit{s}") for s in suffixes
    }).drop("first_row")
