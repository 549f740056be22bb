"""First-match classification."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def classify(rules: Sequence[tuple[object, Column]], default: object = None) -> Column:
    """Label of the first rule whose condition holds."""
    (label, cond), *rest = rules
    chain = reduce(lambda acc, r: acc.when(r[1], F.lit(r[0])), rest, F.when(cond, F.lit(label)))
    return chain.otherwise(F.lit(default))


def map_value(col: Column, mapping: Mapping[object, object], default: object = None) -> Column:
    return classify([(value, col == F.lit(key)) for key, value in mapping.items()], default)
