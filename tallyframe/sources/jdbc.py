"""Extract a query result from a database."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def jdbc_options(
    url: str, query: str, partition: tuple[str, object, object, int] | None = None, **extra: str
) -> dict[str, str]:
    """Reader options. ``partition`` = (column, lowest, highest, number of readers).

    Without it one task reads the whole result; with it the query becomes a subquery
    that each reader restricts to its range, which is what a large extract needs.
    """
    if partition is None:
        return {"url": url, "query": query, **extra}
    column, low, high, n = partition
    return {
        "url": url, "dbtable": f"({query}) src", "partitionColumn": column,
        "lowerBound": str(low), "upperBound": str(high), "numPartitions": str(n),
        "fetchsize": "10000", **extra,
    }


def read_jdbc(
    spark: SparkSession, url: str, query: str,
    partition: tuple[str, object, object, int] | None = None, **extra: str,
) -> DataFrame:
    return spark.read.format("jdbc").options(**jdbc_options(url, query, partition, **extra)).load()
