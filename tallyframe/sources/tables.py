"""Named tables, daily snapshots, validity intervals and change logs.

Filters here sit on partition columns, so other days are not even listed.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date, timedelta
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StringType, StructType

from ..operators.windows import latest_version
from ..params import OPEN_END


def load_sources(
    spark: SparkSession, paths: Mapping[str, str], as_of: date | None = None,
    schemas: Mapping[str, StructType] | None = None, register: bool = True,
) -> dict[str, DataFrame]:
    """Read parquet tables by name; ``{today}`` in a path becomes ``as_of``.

    With ``register`` each table is also a temp view, for reports written in SQL.
    A given schema saves the job that reads file footers.
    """
    out = {}
    for name, path in paths.items():
        reader = spark.read.schema(schemas[name]) if schemas and name in schemas else spark.read
        out[name] = reader.parquet(path.format(today=as_of) if as_of else path)
        if register:
            out[name].createOrReplaceTempView(name)
    return out


def read_snapshot(df: DataFrame, as_of: date, col: str = "dt") -> DataFrame:
    """The snapshot of one day."""
    return df.where(F.col(col) == F.lit(as_of))


def read_latest(df: DataFrame, col: str = "dt") -> DataFrame:
    """The newest snapshot of a table that is partitioned by ``col``.

    The newest partition comes from the listing of the files; the filter is then a literal, so
    only that partition is read. Any other frame is asked for its maximum.
    """
    values = sorted(filter(None, (_partition_value(path, col) for path in df.inputFiles())))
    kind = df.schema[col].dataType
    if values and isinstance(kind, (DateType, StringType)):
        return df.where(F.col(col) == F.lit(values[-1]).cast(kind))
    return df.where(F.col(col) == df.agg(F.max(col)).scalar())


def _partition_value(path: str, col: str) -> str | None:
    """The value of a partition column in a file's path; dates and texts sort as they are written."""
    found = [part.partition("=")[2] for part in path.split("/") if part.partition("=")[0] == col]
    return unquote(found[-1]) if found and found[-1] != "__HIVE_DEFAULT_PARTITION__" else None


def scd2_current(df: DataFrame, end_col: str = "valid_to_date", open_end: date = OPEN_END) -> DataFrame:
    """Rows that are still valid."""
    return df.where(F.col(end_col) == F.lit(open_end))


def cdc_window(df: DataFrame, as_of: date, days: int = 30, col: str = "dt") -> DataFrame:
    """Change rows of the last ``days`` days up to and with ``as_of``, as a run on that day saw them."""
    return cdc_since(df, as_of - timedelta(days=days - 1), as_of, col)


def cdc_since(df: DataFrame, first: date, as_of: date, col: str = "dt") -> DataFrame:
    """Change rows from the day ``first`` up to and with ``as_of``."""
    return df.where((F.col(col) >= F.lit(first)) & (F.col(col) <= F.lit(as_of)))


def merge_on_read(base: DataFrame, changes: DataFrame, keys: Sequence[str], newest: Sequence[str]) -> DataFrame:
    """A base table with one row per key, with its change rows folded in: the newest version per key.

    The changes shrink to one row per key first. Base rows of other keys pass by an anti join
    and are never sorted; those of changed keys are compared with the change.
    """
    latest = latest_version(changes, keys, newest)
    changed = latest.select(*keys)
    untouched = base.join(changed, list(keys), "left_anti").select(*base.columns)
    touched = base.join(changed, list(keys), "left_semi").select(*base.columns)
    return untouched.unionByName(latest_version(touched.unionByName(latest), keys, newest))


def values_df(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    return spark.createDataFrame(list(rows), schema)


def read_csv(spark: SparkSession, path: str, header: bool = False) -> DataFrame:
    return spark.read.csv(path, header=header)
