"""The run log with its details parsed once: a VARIANT column instead of JSON text.

Spark stores fields that rows have in common as columns of their own (shredding) and reads back only those
that a query asks for, so later views neither parse text nor read the other fields.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .runlog import LOG_FIELDS


def write_variant_log(events: DataFrame, path: str, etc: str = "etc", name: str = "details") -> DataFrame:
    """Append log rows with ``etc`` as VARIANT ``name``; text that is no JSON becomes NULL. Returns the stored log."""
    parsed = events.withColumn(name, F.try_parse_json(F.col(etc))).drop(etc)
    parsed.write.mode("append").parquet(path)
    return events.sparkSession.read.schema(parsed.schema).parquet(path)


def variant_fields(df: DataFrame, details: str, names: Sequence[str]) -> DataFrame:
    """Fields as text columns without outer blanks, '' when absent or null."""
    return df.withColumns({n: F.coalesce(F.trim(F.try_variant_get(F.col(details), f"$.{n}", "string")), F.lit("")) for n in names})


def explode_variant_array(df: DataFrame, details: str, field: str, name: str) -> DataFrame:
    """One row per item of an array field as text; rows without items stay, with ''."""
    items = F.try_variant_get(F.col(details).outer(), f"$.{field}", "variant")
    found = df.sparkSession.tvf.variant_explode_outer(items).select(F.col("value").alias("_item"))
    rows = df.lateralJoin(found, how="left")
    return rows.withColumn(name, F.coalesce(F.try_variant_get("_item", "$", "string"), F.lit(""))).drop("_item")


def variant_log_view(log: DataFrame, service: str | None = None, details: str = "details") -> DataFrame:
    """``log_view`` of a stored variant log: same rows, with the details' fields in place of the text."""
    if service is not None:
        log = log.where(F.col("service_name") == service)
    rows = variant_fields(log, details, LOG_FIELDS)
    return explode_variant_array(rows, details, "attachment_paths", "filepath").drop(details)
