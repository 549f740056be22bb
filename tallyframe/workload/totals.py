"""Aggregations."""

from pyspark.sql import functions as F

from ..functions import classify, money
from ..operators.aggregates import check_nonzero, pivot_sum, signed_sum, violation_summary
from ..operators.compare import compare_amounts
from ..plans import fixed_values as fv
from . import sqltables as S
from .registry import query
from .tables import dbl, doubles


def _price():
    return money(F.col("l_extendedprice"))


@query("agg_sum", """
SELECT l_suppkey, sum(l_extendedprice::DECIMAL(18,2))::DOUBLE AS amount FROM lineitem GROUP BY 1""")
def agg_sum(g):
    return g.lineitem.groupBy("l_suppkey").agg(dbl(F.sum(_price())).alias("amount"))


@query("agg_signed_sum", """
SELECT l_suppkey, sum(CASE WHEN l_returnflag = 'R' THEN -1 * l_extendedprice::DECIMAL(18,2)
                           ELSE l_extendedprice::DECIMAL(18,2) END)::DOUBLE AS amount FROM lineitem GROUP BY 1""")
def agg_signed_sum(g):
    return g.lineitem.groupBy("l_suppkey").agg(
        dbl(signed_sum(_price(), F.col("l_returnflag") == "R")).alias("amount"))


@query("agg_sum_default0", """
SELECT p_brand, coalesce(sum(CASE WHEN p_size > 49 THEN p_retailprice::DECIMAL(18,2) END), 0)::DOUBLE AS amount
FROM part GROUP BY 1""")
def agg_sum_default0(g):
    large = F.when(F.col("p_size") > 49, money(F.col("p_retailprice")))
    return g.part.groupBy("p_brand").agg(dbl(F.coalesce(F.sum(large), F.lit(0))).alias("amount"))


@query("agg_abs_sum", """
SELECT c_nationkey, abs(sum(c_acctbal::DECIMAL(18,2) - 5000))::DOUBLE AS amount FROM customer GROUP BY 1""")
def agg_abs_sum(g):
    return g.customer.groupBy("c_nationkey").agg(
        dbl(F.abs(F.sum(money(F.col("c_acctbal")) - F.lit(5000)))).alias("amount"))


@query("agg_max_min", """
SELECT o_custkey, max(o_orderdate)::DATE AS last_day, min(o_orderdate)::DATE AS first_day, max(o_orderkey) AS last_key
FROM orders GROUP BY 1""")
def agg_max_min(g):
    return g.orders.groupBy("o_custkey").agg(
        F.to_date(F.max("o_orderdate")).alias("last_day"), F.to_date(F.min("o_orderdate")).alias("first_day"),
        F.max("o_orderkey").alias("last_key"))


@query("agg_count", """
SELECT o_orderpriority, count(*) AS n, count(CASE WHEN o_orderstatus = 'F' THEN 1 END) AS n_filled FROM orders GROUP BY 1
UNION ALL SELECT 'all', count(*), count(CASE WHEN o_orderstatus = 'F' THEN 1 END) FROM orders""")
def agg_count(g):
    counts = [F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("o_orderstatus") == "F", 1)).alias("n_filled")]
    each = g.orders.groupBy("o_orderpriority").agg(*counts)
    return each.unionByName(each.agg(  # the grand total comes from the group counts
        F.lit("all").alias("o_orderpriority"), F.sum("n").alias("n"), F.sum("n_filled").alias("n_filled")))


@query("agg_avg", "SELECT l_returnflag, round(avg(l_quantity), 6) AS mean FROM lineitem GROUP BY 1")
def agg_avg(g):
    return g.lineitem.groupBy("l_returnflag").agg(F.round(F.avg("l_quantity"), 6).alias("mean"))


@query("agg_cond_count", """
SELECT l_suppkey, count(CASE WHEN l_returnflag = 'R' THEN 1 END) AS n_returned,
       count(CASE WHEN l_discount > 0.05 THEN 1 END) AS n_discounted FROM lineitem GROUP BY 1""")
def agg_cond_count(g):
    return g.lineitem.groupBy("l_suppkey").agg(
        F.count_if(F.col("l_returnflag") == "R").alias("n_returned"),
        F.count_if(F.col("l_discount") > 0.05).alias("n_discounted"))


@query("agg_pivot_sum", """
SELECT l_suppkey,
  round(sum(CASE WHEN l_returnflag = 'A' THEN l_extendedprice::DECIMAL(18,2) ELSE 0 END), 2)::DOUBLE AS accepted,
  round(sum(CASE WHEN l_returnflag = 'N' THEN l_extendedprice::DECIMAL(18,2) ELSE 0 END), 2)::DOUBLE AS normal,
  round(sum(CASE WHEN l_returnflag = 'R' THEN l_extendedprice::DECIMAL(18,2) ELSE 0 END), 2)::DOUBLE AS returned
FROM lineitem GROUP BY 1""")
def agg_pivot_sum(g):
    names = {"A": "accepted", "N": "normal", "R": "returned"}
    rows = g.lineitem.withColumn("price", _price())
    return doubles(pivot_sum(rows, ["l_suppkey"], "l_returnflag", names, "price"), *names.values())


@query("agg_group_by_alias", """
SELECT CASE WHEN l_quantity <= 14 THEN 'small' WHEN l_quantity <= 29 THEN 'medium' END AS ttype, count(*) AS n
FROM lineitem GROUP BY ttype""")
def agg_group_by_alias(g):
    ttype = classify([("small", F.col("l_quantity") <= 14), ("medium", F.col("l_quantity") <= 29)])
    return g.lineitem.groupBy(ttype.alias("ttype")).agg(F.count(F.lit(1)).alias("n"))


@query("agg_group_hidden_key", """
SELECT n_name, amount FROM (
  SELECT n_name, s_suppkey, sum(s_acctbal::DECIMAL(18,2))::DOUBLE AS amount
  FROM supplier JOIN nation ON s_nationkey = n_nationkey GROUP BY n_name, s_suppkey)""")
def agg_group_hidden_key(g):
    joined = g.supplier.join(g.nation, F.col("s_nationkey") == F.col("n_nationkey"))
    return joined.groupBy("n_name", "s_suppkey").agg(dbl(F.sum(money(F.col("s_acctbal")))).alias("amount")).drop("s_suppkey")


@query("agg_multi_key", """
SELECT l_suppkey, l_returnflag, l_linestatus, l_linenumber, year(l_shipdate) AS y, count(*) AS n
FROM lineitem GROUP BY 1, 2, 3, 4, 5""")
def agg_multi_key(g):
    return g.lineitem.groupBy(
        "l_suppkey", "l_returnflag", "l_linestatus", "l_linenumber", F.year("l_shipdate").cast("bigint").alias("y")
    ).agg(F.count(F.lit(1)).alias("n"))


@query("agg_having", "SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1 HAVING min(o_totalprice) > 60000")
def agg_having(g):
    per = g.orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"), F.min("o_totalprice").alias("low"))
    return per.where(F.col("low") > 60000).drop("low")


@query("agg_distinct", "SELECT DISTINCT l_suppkey, l_shipdate::DATE AS day FROM lineitem")
def agg_distinct(g):
    return g.lineitem.select("l_suppkey", F.to_date("l_shipdate").alias("day")).distinct()


@query("agg_violation_summary", """
WITH s AS (SELECT c_mktsegment, abs(c_acctbal::DECIMAL(18,2)) AS amount,
  CASE WHEN abs(c_acctbal) >= 9000 THEN 3 WHEN abs(c_acctbal) >= 5000 THEN 2 WHEN abs(c_acctbal) >= 1000 THEN 1 END AS lvl
  FROM customer WHERE c_acctbal < 0 OR c_acctbal > 4000)
SELECT c_mktsegment, count(*) AS total_violations, sum(amount)::DOUBLE AS total_violation_amount,
       round(avg(amount), 6)::DOUBLE AS avg_violation_amount, max(amount)::DOUBLE AS max_violation_amount,
       count(*) FILTER (WHERE lvl = 3) AS critical_count, count(*) FILTER (WHERE lvl = 2) AS high_count,
       count(*) FILTER (WHERE lvl = 1) AS medium_count FROM s GROUP BY 1""")
def agg_violation_summary(g):
    size = F.abs(F.col("c_acctbal"))
    severity = classify([(fv.CRITICAL, size >= 9000), (fv.HIGH, size >= 5000), (fv.MEDIUM, size >= 1000)], fv.LOW)
    rows = g.customer.where((F.col("c_acctbal") < 0) | (F.col("c_acctbal") > 4000)).select(
        "c_mktsegment", F.abs(money(F.col("c_acctbal"))).alias("amount"), severity.alias("severity"))
    levels = {fv.CRITICAL: "critical_count", fv.HIGH: "high_count", fv.MEDIUM: "medium_count"}
    out = violation_summary(rows, "c_mktsegment", "amount", "severity", levels)
    return doubles(out, "total_violation_amount", "max_violation_amount").withColumn(
        "avg_violation_amount", dbl(F.round("avg_violation_amount", 6)))


@query("agg_global_check", f"""
WITH {S.REGISTERS}, d AS (SELECT coalesce(a.amount, 0) - coalesce(b.amount, 0) AS diff
  FROM register_a a FULL JOIN register_b b USING (number))
SELECT sum(diff) <> 0 AS net_differs, sum(abs(diff)) <> 0 AS gross_differs, count(*) AS n_rows FROM d""")
def agg_global_check(g):
    return check_nonzero(compare_amounts(g.register_a, g.register_b, ["number"], "amount"), "diff")
