"""The log of report runs and what can be read from it."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import explode_json_array, json_fields, map_value
from ..operators.setops import union_sources

LOG_SCHEMA = "run_id string, service_name string, job_name string, event_type string, event_ts timestamp, etc string"
LOG_FIELDS = ["result", "ticket_key", "error_msg", "attachment_paths"]


def log_row(
    spark: SparkSession, run_id: str, job: str, event: str, at: datetime, service: str = "REPORTS",
    result: str | None = None, ticket_key: str | None = None, error_msg: str | None = None,
    attachment_paths: list[str] | None = None,
) -> DataFrame:
    """One START, END or ERROR event with its details as JSON; an error has result ERROR."""
    if event not in ("START", "END", "ERROR"):
        raise ValueError(f"unknown event {event!r}")
    details = [("ERROR" if event == "ERROR" else result, ticket_key, error_msg, attachment_paths)]
    row = spark.createDataFrame(
        details, "result string, ticket_key string, error_msg string, attachment_paths array<string>"
    )
    return row.select(
        F.lit(run_id).alias("run_id"), F.lit(service).alias("service_name"), F.lit(job).alias("job_name"),
        F.lit(event).alias("event_type"), F.lit(at).cast("timestamp").alias("event_ts"),
        F.to_json(F.struct(*row.columns)).alias("etc"),
    )


def log_run(path: str, *rows: DataFrame) -> None:
    union_sources(*rows).write.mode("append").parquet(path)


#: Of events at the same time the one that ends a run tells its status.
EVENT_RANK = {"START": 0, "END": 1, "ERROR": 2}


def run_status(events: DataFrame, run: str = "run_id", ts: str = "event_ts", event: str = "event_type") -> DataFrame:
    """Last event of each run and the time of it; at equal times ERROR ranks over END over START."""
    rank = map_value(F.col(event), EVENT_RANK, -1).alias("rank")
    last = F.max(F.struct(F.col(ts).alias("ts"), rank, F.col(event).alias("event"))).alias("_last")
    return events.groupBy(run).agg(last, F.count(F.lit(1)).alias("n_events")).select(
        run, F.col("_last.event").alias("status"), F.col("_last.ts").alias("status_ts"), "n_events"
    )


def log_view(events: DataFrame, service: str | None = None, etc: str = "etc") -> DataFrame:
    """Log rows with their JSON details, one row per attached file, rows without files kept."""
    if service is not None:
        events = events.where(F.col("service_name") == service)
    rows = json_fields(events, etc, LOG_FIELDS)
    paths = F.when(F.col("attachment_paths") != "", F.col("attachment_paths"))
    return explode_json_array(rows, paths, "filepath")


def freshness(sources: Mapping[str, tuple[DataFrame, str]], as_of: date) -> DataFrame:
    """Was each source updated on ``as_of`` or later? One maximum per source, turned to a day once."""
    return union_sources(*[
        df.agg(F.to_date(F.max(ts)).alias("last_day")).select(F.lit(name).alias("source"), "last_day")
        for name, (df, ts) in sources.items()
    ]).withColumn("is_fresh", F.coalesce(F.col("last_day") >= F.lit(as_of), F.lit(False)))
