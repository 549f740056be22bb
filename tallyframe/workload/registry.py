from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame

from .tables import Given


@dataclass(frozen=True)
class Query:
    key: str
    build: Callable[[Given], DataFrame]
    sql: str | None

    def run(self, spark, sf_dir: str) -> DataFrame:
        return self.build(Given(spark, sf_dir))


REGISTRY: dict[str, Query] = {}


def query(key: str, sql: str | None):
    """Register a query over the given tables with its check in SQL (None: no SQL form)."""
    def add(build: Callable[[Given], DataFrame]) -> Callable[[Given], DataFrame]:
        if key in REGISTRY:
            raise ValueError(f"query {key!r} is registered twice")
        REGISTRY[key] = Query(key, build, sql)
        return build

    return add
