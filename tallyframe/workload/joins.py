"""Joins."""

from datetime import date

from pyspark.sql import functions as F

from ..functions import money, norm_id
from ..operators.compare import full_compare, missing_in
from ..operators.filters import filter_by_window
from ..operators.joins import densify, left_join, lookup, semi, semi_chain
from ..operators.ledger import as_of_balance, as_of_snapshot
from ..operators.windows import first_in
from ..plans.payments import posting_window
from ..params import previous_month
from . import sqltables as S
from .registry import query
from .rows import ISLANDS
from .tables import AS_OF, EVENT_DAY, dbl

_N = "count(*) AS n"


def n():
    return F.count(F.lit(1)).alias("n")


@query("join_inner", f"""
SELECT n_name, o_orderstatus, {_N} FROM orders JOIN customer ON o_custkey = c_custkey
JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2""")
def join_inner(g):
    # orders shrink to one row per customer and status before they meet the customers
    per = g.orders.groupBy("o_custkey", "o_orderstatus").agg(n())
    joined = per.join(g.customer, F.col("o_custkey") == F.col("c_custkey")).join(
        g.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return joined.groupBy("n_name", "o_orderstatus").agg(F.sum("n").alias("n"))


@query("join_comma", f"""
SELECT s_name, r_name FROM supplier, nation, region WHERE s_nationkey = n_nationkey AND n_regionkey = r_regionkey""")
def join_comma(g):
    return g.supplier.join(g.nation, F.col("s_nationkey") == F.col("n_nationkey")).join(
        g.region, F.col("n_regionkey") == F.col("r_regionkey")).select("s_name", "r_name")


@query("join_left", """
SELECT o_orderkey, l_linenumber, l_extendedprice FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey""")
def join_left(g):
    lines = g.lineitem.select("l_orderkey", "l_linenumber", "l_extendedprice")
    return left_join(g.orders.select("o_orderkey"), lines, "o_orderkey", "l_orderkey").drop("l_orderkey")


@query("join_left_extra_on", """
SELECT o_orderkey, count(l_orderkey) AS n_open FROM orders
LEFT JOIN lineitem ON o_orderkey = l_orderkey AND l_linestatus <> 'F' AND l_returnflag = 'N' GROUP BY 1""")
def join_left_extra_on(g):
    # a further condition on the right side is a filter there; lines are counted before the join
    open_lines = g.lineitem.where((F.col("l_linestatus") != "F") & (F.col("l_returnflag") == "N"))
    counts = open_lines.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n_open"))
    return g.orders.join(counts, F.col("o_orderkey") == F.col("l_orderkey"), "left").select(
        "o_orderkey", F.coalesce("n_open", F.lit(0)).alias("n_open"))


@query("join_left_to_inner", """
SELECT o_orderkey, l_linenumber, l_quantity FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey
WHERE l_quantity > 40""")
def join_left_to_inner(g):
    lines = g.lineitem.where(F.col("l_quantity") > 40)
    return g.orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey")).select(
        "o_orderkey", "l_linenumber", "l_quantity")


@query("join_full_outer", f"""
WITH {S.REGISTERS}
SELECT number, coalesce(a.opened, b.opened) AS opened, a.amount::DOUBLE AS a_amount, b.amount::DOUBLE AS b_amount,
       a.amount IS NOT NULL AS in_a, b.amount IS NOT NULL AS in_b
FROM register_a a FULL JOIN register_b b USING (number)""")
def join_full_outer(g):
    return full_compare(g.register_a, g.register_b, ["number"]).select(
        "number", F.coalesce("a_opened", "b_opened").alias("opened"), dbl("a_amount").alias("a_amount"),
        dbl("b_amount").alias("b_amount"), "in_a", "in_b")


@query("join_cross_skeleton", """
SELECT s_suppkey, flag, coalesce(amount, 0)::DOUBLE AS amount
FROM supplier CROSS JOIN (VALUES ('A'), ('N'), ('R'), ('X')) AS t(flag)
LEFT JOIN (SELECT l_suppkey, l_returnflag, sum(l_extendedprice::DECIMAL(18,2)) AS amount FROM lineitem
           GROUP BY 1, 2) f ON s_suppkey = l_suppkey AND flag = l_returnflag""")
def join_cross_skeleton(g):
    facts = g.lineitem.groupBy(
        F.col("l_suppkey").alias("s_suppkey"), F.col("l_returnflag").alias("flag")
    ).agg(F.sum(money(F.col("l_extendedprice"))).alias("amount"))
    full = densify(g.supplier.select("s_suppkey"), "flag", ["A", "N", "R", "X"], facts, ["s_suppkey"],
                   {"amount": F.lit(0)})
    return full.select("s_suppkey", "flag", dbl("amount").alias("amount"))


@query("join_composite", """
SELECT a.l_suppkey, a.l_returnflag, a.n, b.n AS n_late FROM
 (SELECT l_suppkey, l_returnflag, count(*) AS n FROM lineitem WHERE l_linestatus = 'F' GROUP BY 1, 2) a
 JOIN (SELECT l_suppkey, l_returnflag, count(*) AS n FROM lineitem WHERE l_linestatus = 'O' GROUP BY 1, 2) b
 ON a.l_suppkey = b.l_suppkey AND a.l_returnflag = b.l_returnflag""")
def join_composite(g):
    def side(status, name):
        return g.lineitem.where(F.col("l_linestatus") == status).groupBy("l_suppkey", "l_returnflag").agg(
            F.count(F.lit(1)).alias(name))
    return side("F", "n").join(side("O", "n_late"), ["l_suppkey", "l_returnflag"])


@query("join_semi_nested", """
SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (
  SELECT c_custkey FROM customer WHERE c_nationkey IN (
    SELECT n_nationkey FROM nation WHERE n_regionkey IN (
      SELECT r_regionkey FROM region WHERE r_name IN ('ASIA', 'EUROPE'))))""")
def join_semi_nested(g):
    regions = g.region.where(F.col("r_name").isin("ASIA", "EUROPE"))
    return semi_chain(g.orders, "o_custkey", [
        (g.customer, "c_custkey", "c_nationkey"), (g.nation, "n_nationkey", "n_regionkey"),
        (regions, "r_regionkey", None)]).select("o_orderkey", "o_custkey")


@query("join_semi_cte", """
WITH big AS (SELECT o_custkey FROM orders GROUP BY o_custkey HAVING sum(o_totalprice::DECIMAL(18,2)) > 2500000)
SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (SELECT o_custkey FROM big)""")
def join_semi_cte(g):
    big = g.orders.groupBy("o_custkey").agg(F.sum(money(F.col("o_totalprice"))).alias("total")).where("total > 2500000")
    return semi(g.customer, "c_custkey", big, "o_custkey").select("c_custkey", "c_name")


@query("join_anti_sides", f"""
WITH {S.REGISTERS}
SELECT number, 'only_a' AS side FROM register_a WHERE number NOT IN (SELECT number FROM register_b)
UNION ALL SELECT number, 'only_b' FROM register_b WHERE number NOT IN (SELECT number FROM register_a)""")
def join_anti_sides(g):
    a, b = g.register_a, g.register_b
    only_a = missing_in(a, b, ["number"]).select("number", F.lit("only_a").alias("side"))
    only_b = missing_in(b, a, ["number"]).select("number", F.lit("only_b").alias("side"))
    return only_a.unionByName(only_b)


@query("join_self_argmax", """
SELECT e.user_id, e.event_id, e.value FROM events e
JOIN (SELECT user_id, max(ts) AS ts FROM events GROUP BY 1) m ON e.user_id = m.user_id AND e.ts = m.ts
WHERE e.event_id = (SELECT max(x.event_id) FROM events x WHERE x.user_id = e.user_id AND x.ts = e.ts)""")
def join_self_argmax(g):
    # one aggregate instead of joining the table back to its own maximum
    newest = first_in(g.events, ["user_id"], [F.col("ts").desc(), F.col("event_id").desc()])
    return newest.select("user_id", "event_id", "value")


@query("join_normalised_key", """
SELECT o_orderkey, c_name FROM orders JOIN customer ON o_custkey = c_custkey""")
def join_normalised_key(g):
    stored = g.orders.select("o_orderkey", F.concat(F.col("o_custkey").cast("string"), F.lit(".0000000000")).alias("cust"))
    return stored.join(g.customer, norm_id(F.col("cust")) == F.col("c_custkey")).select("o_orderkey", "c_name")


@query("join_star_lookup", """
SELECT l_orderkey, l_linenumber, s_name, n_name, r_name, p_brand
FROM lineitem LEFT JOIN supplier ON l_suppkey = s_suppkey LEFT JOIN nation ON s_nationkey = n_nationkey
LEFT JOIN region ON n_regionkey = r_regionkey LEFT JOIN part ON l_partkey = p_partkey""")
def join_star_lookup(g):
    return lookup(g.lineitem, [
        (g.supplier, "l_suppkey", "s_suppkey"), (g.nation, "s_nationkey", "n_nationkey"),
        (g.region, "n_regionkey", "r_regionkey"), (g.part, "l_partkey", "p_partkey"),
    ]).select("l_orderkey", "l_linenumber", "s_name", "n_name", "r_name", "p_brand")


@query("join_day_lookup", f"""
WITH {S.CALENDAR}
SELECT event_id, ts::DATE AS day, CASE WHEN NOT holiday_flag THEN TRUE ELSE FALSE END AS closed_date_flag
FROM events LEFT JOIN calendar ON ts::DATE = calendar_date""")
def join_day_lookup(g):
    days = g.calendar.select("calendar_date", F.when(F.col("holiday_flag"), 1).otherwise(3).alias("status"))
    status = days.groupBy("calendar_date").agg(F.max("status").alias("status"))
    return g.events.select("event_id", F.to_date("ts").alias("day")).join(
        status, F.col("day") == F.col("calendar_date"), "left"
    ).select("event_id", "day", F.coalesce(F.col("status") == 3, F.lit(False)).alias("closed_date_flag"))


@query("join_theta_one_row", f"""
WITH {ISLANDS}
SELECT user_id, {_N}, sum(value::DECIMAL(18,2))::DOUBLE AS amount FROM events, bounds
WHERE ts::DATE BETWEEN lo AND hi GROUP BY 1""")
def join_theta_one_row(g):
    days = g.events.select("user_id", "value", F.to_date("ts").alias("day"))
    rows = filter_by_window(days, "day", posting_window(g.calendar, EVENT_DAY), "start_date", "end_date",
                            fallback=date(2024, 1, 14))
    return rows.groupBy("user_id").agg(n(), dbl(F.sum(money(F.col("value")))).alias("amount"))


@query("asof_snapshot", f"""
SELECT user_id, last_event, last_value FROM (
  SELECT user_id, event_id AS last_event, value AS last_value,
         row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
  FROM events WHERE ts < {S.E}) WHERE rn = 1""")
def asof_snapshot(g):
    snap = as_of_snapshot(g.events, "user_id", ["ts", "event_id"], ["value"], {"last": EVENT_DAY})
    return snap.select("user_id", F.col("last.event_id").alias("last_event"), F.col("last.value").alias("last_value"))


@query("asof_balance", f"""
WITH j AS (
  SELECT o_custkey, o_orderdate, o_orderkey, o_totalprice::DECIMAL(18,2) AS in_balance,
         (o_totalprice * 2)::DECIMAL(18,2) AS amount, o_orderstatus = 'F' AS is_debit FROM orders),
ends AS (SELECT 'start' AS cutoff, {S.LO} AS cut UNION ALL SELECT 'end', {S.HI}),
last AS (
  SELECT *, row_number() OVER (PARTITION BY cutoff, o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
  FROM j JOIN ends ON o_orderdate < cut)
SELECT o_custkey, cutoff, (in_balance + CASE WHEN is_debit THEN -amount ELSE amount END)::DOUBLE AS balance
FROM last WHERE rn = 1""")
def asof_balance(g):
    journal = g.orders.select(
        "o_custkey", "o_orderdate", "o_orderkey", money(F.col("o_totalprice")).alias("in_balance"),
        money(F.col("o_totalprice") * 2).alias("amount"), (F.col("o_orderstatus") == "F").alias("is_debit"))
    lo, hi = previous_month(AS_OF)
    out = as_of_balance(journal, "o_custkey", ["o_orderdate", "o_orderkey"], {"start": lo, "end": hi})
    return out.withColumn("balance", dbl("balance"))
