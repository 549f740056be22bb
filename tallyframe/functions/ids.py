"""Identifiers and flags as the source systems store them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ZERO_FRACTION = ".0000000000"  # fixed value: ids exported as decimal text


def norm_id(col: Column) -> Column:
    """``'123.0000000000'`` or ``123`` to bigint; text that is no number gives NULL."""
    return F.replace(col.cast("string"), F.lit(ZERO_FRACTION), F.lit("")).try_cast("bigint")


def to_flag(col: Column) -> Column:
    """1/0, '1'/'0', 'true'/'false' or boolean to boolean, so one journal has one reading."""
    text = F.lower(F.trim(col.cast("string")))
    return F.when(text.isin("1", "true", "1.0000000000"), True).when(
        text.isin("0", "false", "0.0000000000"), False
    )


def account_class(number: Column, width: int = 5) -> Column:
    """Leading digits of an account number: its second-order balance account."""
    return F.substring(number, 1, width)
