"""What was delivered before, so that a repeated run delivers nothing twice."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame

from ..operators.compare import missing_in
from ..session import drop_work, materialize, work_dir


def undelivered(items: DataFrame, ledger: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Items not in the ledger, decided before anything is rendered."""
    return missing_in(items, ledger, keys)


def deliver(
    items: DataFrame, ledger_path: str, keys: Sequence[str], write: Callable[[DataFrame], None]
) -> None:
    """Write the items that are not in the ledger, then note them.

    The selection is written down first: files and ledger see the same items even when an
    executor is lost in between. The ledger comes last, so a failed run is repeated.
    """
    spark = items.sparkSession
    schema = items.select(*keys).schema
    known = spark.read.schema(schema).parquet(ledger_path) if _exists(spark, ledger_path) else None
    path = work_dir(spark, "deliver")
    todo = materialize(items if known is None else undelivered(items, known, keys), "deliver", path)
    try:
        write(todo)
        todo.select(*keys).distinct().write.mode("append").parquet(ledger_path)
    finally:
        drop_work(spark, path)


def _exists(spark, path: str) -> bool:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)
