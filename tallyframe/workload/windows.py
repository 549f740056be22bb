"""Versions, first rows, totals per key, running sums, islands and intervals."""

from pyspark.sql import functions as F

from ..functions import money
from ..operators.windows import (
    close_intervals, first_in, holiday_islands, latest_version, mark_edges, partition_total, running_sum,
)
from . import sqltables as S
from .registry import query
from .rows import ISLANDS
from .scans import ORDER_INTERVALS, order_days
from .tables import dbl, doubles


@query("win_latest_version", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                               ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC) AS rn FROM lineitem)
WHERE rn = 1""")
def win_latest_version(g):
    return latest_version(g.lineitem, ["l_orderkey", "l_linenumber"], ["l_shipdate", "l_partkey", "l_suppkey"]).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")


@query("win_first_of_day", """
SELECT user_id, day, event_id, value FROM (
  SELECT *, ts::DATE AS day, row_number() OVER (PARTITION BY user_id, ts::DATE ORDER BY ts, event_id) AS rn FROM events)
WHERE rn = 1""")
def win_first_of_day(g):
    days = g.events.withColumn("day", F.to_date("ts"))
    return first_in(days, ["user_id", "day"], [F.col("ts"), F.col("event_id")]).select("user_id", "day", "event_id", "value")


@query("win_partition_sum", f"""
WITH {S.POSTINGS}
SELECT event_id, user_id, day,
  (-1 * sum(CASE WHEN is_debit THEN amount ELSE 0 END) OVER (PARTITION BY user_id, day))::DOUBLE AS debit,
  (sum(CASE WHEN NOT is_debit THEN amount ELSE 0 END) OVER (PARTITION BY user_id, day))::DOUBLE AS credit FROM postings""")
def win_partition_sum(g):
    amount, zero = F.col("amount"), F.lit(0)
    rows = partition_total(
        g.postings, ["user_id", "day"],
        debit=-F.sum(F.when(F.col("is_debit"), amount).otherwise(zero)),
        credit=F.sum(F.when(~F.col("is_debit"), amount).otherwise(zero)))
    return doubles(rows.select("event_id", "user_id", "day", "debit", "credit"), "debit", "credit")


@query("win_running_sum", """
SELECT event_id, user_id, (sum(value::DECIMAL(18,2)) OVER
  (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))::DOUBLE AS running
FROM events""")
def win_running_sum(g):
    rows = g.events.select("event_id", "user_id", "ts", money(F.col("value")).alias("amount"))
    out = running_sum(rows, ["user_id"], ["ts", "event_id"], "amount", "running", F.date_trunc("minute", F.col("ts")))
    return out.select("event_id", "user_id", dbl("running").alias("running"))


@query("win_lag_lead_flags", f"""
WITH {S.CALENDAR}
SELECT c.calendar_date, c.holiday_flag,
       CASE WHEN c.holiday_flag THEN NULL WHEN y.holiday_flag THEN 2 WHEN t.holiday_flag THEN 1 END AS day_type,
       (SELECT count(*) FROM events WHERE ts::DATE = c.calendar_date) AS n
FROM calendar c LEFT JOIN calendar y ON y.calendar_date = c.calendar_date - 1
LEFT JOIN calendar t ON t.calendar_date = c.calendar_date + 1""")
def win_lag_lead_flags(g):
    per_day = g.events.groupBy(F.to_date("ts").alias("calendar_date")).agg(F.count(F.lit(1)).alias("n"))
    return mark_edges(g.calendar).join(per_day, "calendar_date", "left").withColumn("n", F.coalesce("n", F.lit(0)))


@query("win_islands", f"""
WITH {ISLANDS}
SELECT start_date, finish_date, count(event_id) AS n_events FROM islands
LEFT JOIN events ON ts::DATE >= start_date AND ts::DATE < finish_date GROUP BY 1, 2""")
def win_islands(g):
    # every day of an island becomes a row, so events meet islands in an equi-join by day
    days = holiday_islands(g.calendar).withColumn(
        "day", F.explode(F.sequence("start_date", F.date_sub("finish_date", 1))))
    per_day = g.events.groupBy(F.to_date("ts").alias("day")).agg(F.count(F.lit(1)).alias("n"))
    return days.join(per_day, "day", "left").groupBy("start_date", "finish_date").agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_events"))


@query("win_lead_interval", f"WITH {ORDER_INTERVALS} SELECT * FROM intervals")
def win_lead_interval(g):
    return close_intervals(order_days(g), ["o_custkey"], "valid_from", "valid_to")
