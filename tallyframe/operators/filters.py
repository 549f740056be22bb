"""Row filters. Bounds are literals on bare columns, so they reach the file scan."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..params import previous_month


def in_prev_month(col: Column, as_of: date) -> Column:
    lo, hi = previous_month(as_of)
    return (col >= F.lit(lo)) & (col < F.lit(hi))


def valid_on(df: DataFrame, as_of: date, frm: str, to: str) -> DataFrame:
    """Rows whose closed interval [frm, to] holds ``as_of``."""
    return df.where((F.col(frm) <= F.lit(as_of)) & (F.col(to) >= F.lit(as_of)))


def select_named(df: DataFrame, names: Iterable[str] | None, col: str = "name") -> DataFrame:
    """Rows whose name was asked for: None keeps all, an empty list keeps none."""
    return df if names is None else df.where(F.col(col).isin(list(names)))


def for_report_dates(df: DataFrame, col: str, dates: Iterable[date]) -> DataFrame:
    """Rows for several report dates in one pass: each row once per date whose previous
    month holds it, with that date as ``as_of``. The dates are a short list; their span is a
    plain filter, so it reaches the scan."""
    dates = list(dates)
    spans = [previous_month(d) for d in dates]
    hits = [F.when(in_prev_month(F.col(col), d), F.lit(d)) for d in dates]
    if spans:
        df = df.where((F.col(col) >= F.lit(min(lo for lo, _ in spans))) & (F.col(col) < F.lit(max(hi for _, hi in spans))))
    else:
        df, hits = df.where("false"), [F.lit(None).cast("date")]
    return df.withColumn("as_of", F.explode(F.array_compact(F.array(*hits))))


def filter_by_window(
    df: DataFrame, col: str, window: DataFrame, start: str, end: str, fallback: date
) -> DataFrame:
    """Rows with ``col`` in the closed interval of the one-row ``window``.

    An empty window leaves the rows of ``fallback``. The bounds are scalar
    subqueries: they run once, and more than one window row is an error.
    """
    lo = F.coalesce(window.select(start).scalar(), F.lit(fallback))
    hi = F.coalesce(window.select(end).scalar(), F.lit(fallback))
    return df.where((F.col(col) >= lo) & (F.col(col) <= hi))
