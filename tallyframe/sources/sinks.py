"""Writing results."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..delivery.contracts import Contract, display_contract


def write_table(df: DataFrame, path: str, files: int | None = None, by: str | None = None) -> None:
    """Overwrite a parquet table, optionally partitioned by a column.

    A fixed number of files suits a small result. Otherwise the rows are rebalanced: AQE
    merges small pieces and splits a partition value that holds most of the rows.
    """
    df = df.repartition(files) if files else df.hint("rebalance", *([by] if by else []))
    writer = df.write.mode("overwrite")
    (writer.partitionBy(by) if by else writer).parquet(path)


def write_report(df: DataFrame, contract: Contract, path: str) -> None:
    """A result as CSV under its display labels and masks, in as many files as it needs."""
    display_contract(df, contract).write.mode("overwrite").csv(path, header=True)


def with_run_columns(df: DataFrame, run_ts: datetime, as_of: date) -> DataFrame:
    return df.withColumns({
        "processing_dttm": F.lit(run_ts.strftime("%Y-%m-%d %H_%M_%S")),
        "report_dt": F.lit(as_of.isoformat()),
    })


def append_history(df: DataFrame, path: str, run_ts: datetime, as_of: date) -> None:
    """Append a result to its history, one partition per report date and run.

    The run is a partition too and is overwritten on its own, so repeating a failed
    append of the same run leaves one copy.
    """
    (
        with_run_columns(df, run_ts, as_of).write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("report_dt", "processing_dttm").parquet(path)
    )
