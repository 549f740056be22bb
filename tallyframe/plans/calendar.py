from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def calendar_of(days: DataFrame, day: str) -> DataFrame:
    """A working-day calendar over the days a table covers; weekends are holidays."""
    span = days.agg(F.min(F.to_date(day)).alias("lo"), F.max(F.to_date(day)).alias("hi"))
    every = span.select(F.explode(F.sequence("lo", "hi")).alias("calendar_date"))
    return every.withColumn("holiday_flag", F.dayofweek("calendar_date").isin(1, 7))


def next_workday(cal: DataFrame, as_of: date) -> DataFrame:
    """The first working day from ``as_of`` on and its day of month (NULL if none)."""
    ahead = cal.where((F.col("calendar_date") >= F.lit(as_of)) & (~F.col("holiday_flag")))
    return ahead.agg(F.min("calendar_date").alias("workday")).withColumn(
        "workday_of_month", F.dayofmonth("workday").cast("bigint")
    )
