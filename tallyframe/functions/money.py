"""Exact money and its display."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"


def money(col: Column) -> Column:
    return col.cast(MONEY)


def signed(amount: Column, negative: Column) -> Column:
    """``amount`` with its sign turned where ``negative`` holds (NULL counts as false)."""
    return F.when(negative, -amount).otherwise(amount)


def money_round(col: Column, scale: int = 2) -> Column:
    return F.round(col, scale)


def _date_pattern(mask: str) -> str:
    # display masks write months as "mm", which in a Spark pattern means minutes
    return mask.lower().replace("mm", "MM")


def _decimals(mask: str) -> int:
    return len(mask.rpartition(".")[2]) if "." in mask else 0


def apply_mask(col: Column, kind: str, mask: str | None = None) -> Column:
    """Display text of a report column of kind S (text), D (date) or N (number).

    Number masks are grouped ("#,#0.00") or plain ("%.2f"); plain ones stay exact decimals.
    """
    if kind == "D":
        return F.date_format(col, _date_pattern(mask or "yyyy-mm-dd"))
    if kind == "N" and mask and mask.startswith("%."):
        return col.cast(f"decimal(38,{int(mask[2:-1])})").cast("string")
    if kind == "N" and mask:
        return F.format_number(col, _decimals(mask))
    if kind in ("N", "S"):
        return col.cast("string")
    raise ValueError(f"unknown column kind {kind!r}")
