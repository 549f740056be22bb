"""Which results go out, to whom, filled from which row.

All routes are decided by one join with the result instead of queries per route.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DateType, StringType, TimestampNTZType, TimestampType

from ..functions import classify
from ..operators.windows import first_in


def satisfied(condition: Column, kind: DataType | None = None) -> Column:
    """A condition value counts as met unless it is NULL, false, 0, an empty text or missing.

    ``kind`` is the value's type (default: a boolean or a number): a text counts unless empty, a
    date or time whenever it is there.
    """
    if isinstance(kind, StringType):
        met = condition != ""
    elif isinstance(kind, (DateType, TimestampType, TimestampNTZType)):
        met = condition.isNotNull()
    else:
        met = condition.cast("double") != 0
    return F.coalesce(met, F.lit(False))


def fill_rows(result: DataFrame, routes: DataFrame, key: str, order: Sequence[Column]) -> DataFrame:
    """Each route with the first result row of its key; without one all fields are NULL."""
    rows = first_in(result, [key], order).withColumn("found", F.lit(True))
    return routes.join(rows, key, "left").withColumn("found", F.coalesce("found", F.lit(False)))


def route(
    result: DataFrame, routes: DataFrame, key: str, condition: Column, order: Sequence[Column]
) -> DataFrame:
    """All routes with their filler row and ``attach``: is the route's condition met?"""
    return fill_rows(result, routes, key, order).withColumn("attach", F.col("found") & satisfied(condition))


def split_outcome(df: DataFrame, ok: Column, name: str = "outcome") -> DataFrame:
    return df.withColumn(name, F.when(satisfied(ok), "SUCCESS").otherwise("FAILED"))


def outcome(n_attached: Column, indicator: Column) -> Column:
    """Result of a report from whether anything was attached and what that means to it.

    A report that attaches failures has failed when there is an attachment; one that
    attaches successes has failed when there is none.
    """
    some = F.coalesce(n_attached, F.lit(0)) > 0
    return classify([
        ("FAILED", (indicator == "failure") & some), ("SUCCESS", (indicator == "failure") & ~some),
        ("SUCCESS", (indicator == "success") & some), ("FAILED", (indicator == "success") & ~some),
    ])


def digest(df: DataFrame, cls: str, names: Mapping[str, str], keys: Sequence[str] = ()) -> DataFrame:
    """Number of discrepancies per class, one column each, zero where there are none."""
    return df.groupBy(*keys).agg(*[
        F.count_if(F.col(cls) == value).alias(name) for value, name in names.items()
    ])


def act_digest(final: DataFrame) -> DataFrame:
    """How many acts there are, add up and do not."""
    return final.agg(
        F.count(F.lit(1)).alias("cnt"),
        F.coalesce(F.sum(F.col("condition").cast("bigint")), F.lit(0)).alias("success_cnt"),
        F.count_if(F.col("condition") == 0).alias("failure_cnt"),
    )
