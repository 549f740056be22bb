"""Output contracts: which columns a report has, their kinds, labels and masks."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import apply_mask

DATE_MASK = "yyyy-mm-dd"
MONEY_MASK = "#,#0.00"
_TYPES = {"S": "string", "D": "date", "N": "decimal(18,2)"}


@dataclass(frozen=True)
class Col:
    name: str
    label: str
    kind: str = "S"
    mask: str | None = None


@dataclass(frozen=True)
class Contract:
    """Columns in order. A stored history also has ``report_dt`` and ``processing_dttm``."""

    name: str
    columns: tuple[Col, ...]


def text(name: str, label: str = "") -> Col:
    return Col(name, label or name)


def day(name: str, label: str = "") -> Col:
    return Col(name, label or name, "D", DATE_MASK)


def amount(name: str, label: str = "") -> Col:
    return Col(name, label or name, "N", MONEY_MASK)


def _of_run(df: DataFrame, report_dt: date | None, processing_dttm: str | None) -> DataFrame:
    if report_dt is not None:
        df = df.where(F.col("report_dt") == F.lit(report_dt.isoformat()))
    if processing_dttm is not None:
        df = df.where(F.col("processing_dttm") == processing_dttm)
    return df


def apply_contract(
    df: DataFrame, contract: Contract, report_dt: date | None = None, processing_dttm: str | None = None
) -> DataFrame:
    """The contract's columns in order and in its types, for one run of a stored history."""
    return _of_run(df, report_dt, processing_dttm).select(*[
        F.col(c.name).cast(_TYPES[c.kind]).alias(c.name) for c in contract.columns
    ])


def display_contract(df: DataFrame, contract: Contract, labels: bool = True) -> DataFrame:
    """The contract's columns as text under their labels, for a file people open."""
    return apply_contract(df, contract).select(*[
        apply_mask(F.col(c.name), c.kind, c.mask).alias(c.label if labels else c.name) for c in contract.columns
    ])


_FITS = {"S": (T.StringType,), "D": (T.DateType, T.TimestampType, T.TimestampNTZType), "N": (T.NumericType,)}


def check_contract(df: DataFrame, contract: Contract) -> list[str]:
    """What keeps a frame from being written under a contract, from its schema alone."""
    have = {f.name: f.dataType for f in df.schema.fields}
    problems = [f"missing column {c.name}" for c in contract.columns if c.name not in have]
    problems += [f"unexpected column {n}" for n in have if n not in {c.name for c in contract.columns}]
    problems += [
        f"column {c.name} is {have[c.name].simpleString()}, expected kind {c.kind}"
        for c in contract.columns if c.name in have and not isinstance(have[c.name], _FITS[c.kind])
    ]
    return problems


def contract_problems(df: DataFrame, contract: Contract) -> DataFrame:
    """Per contract column: rows, empty values and values that do not fit its kind.

    For text that came from files. One aggregate over the data, then one row per column.
    """
    def bad(c: Col) -> Column:
        value = F.col(c.name).cast("string")
        return value.isNotNull() & value.try_cast(_TYPES[c.kind]).isNull()

    n = len(contract.columns)
    counts = df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[F.count_if(F.col(c.name).isNull()).alias(f"null_{i}") for i, c in enumerate(contract.columns)],
        *[F.count_if(bad(c)).alias(f"bad_{i}") for i, c in enumerate(contract.columns)],
    )
    rows = F.array(*[
        F.struct(F.lit(c.name).alias("column_name"), F.lit(c.kind).alias("kind"), F.col("n_rows"),
                 F.col(f"null_{i}").alias("n_null"), F.col(f"bad_{i}").alias("n_unfit"))
        for i, c in zip(range(n), contract.columns)
    ])
    return counts.select(F.inline(rows))
