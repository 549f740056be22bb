"""Projections, filters, sorts, limits and set operations."""

from datetime import date

from pyspark.sql import functions as F

from ..functions import money
from ..operators.filters import filter_by_window, in_prev_month, select_named, valid_on
from ..operators.setops import union_aligned, union_sources
from ..operators.sorting import first_by, rank_sort, sample_n
from ..operators.windows import close_intervals
from ..plans import fixed_values as fv
from ..plans.payments import posting_window
from . import sqltables as S
from .registry import query
from .scans import ORDER_INTERVALS, order_days
from .tables import AS_OF, EVENT_DAY, dbl

@query("proj_alias_labels", """
SELECT o_orderkey AS "Номер заказа", o_totalprice AS "Сумма заказа (руб.)", o_orderstatus AS "Статус, код" FROM orders""")
def proj_alias_labels(g):
    labels = {"o_orderkey": "Номер заказа", "o_totalprice": "Сумма заказа (руб.)", "o_orderstatus": "Статус, код"}
    return g.orders.select(*[F.col(c).alias(label) for c, label in labels.items()])


@query("proj_star_plus", """
SELECT *, (l_extendedprice::DECIMAL(18,2) * l_tax::DECIMAL(18,2))::DOUBLE AS tax_amount FROM lineitem""")
def proj_star_plus(g):
    return g.lineitem.withColumn("tax_amount", dbl(money(F.col("l_extendedprice")) * money(F.col("l_tax"))))


@query("proj_special_names", """
SELECT o_orderkey AS "C_ORDER#1", o_custkey AS "C_ACCOUNT#1#2" FROM orders""")
def proj_special_names(g):
    named = g.orders.select(F.col("o_orderkey").alias("C_ORDER#1"), F.col("o_custkey").alias("C_ACCOUNT#1#2"))
    return named.select("`C_ORDER#1`", "`C_ACCOUNT#1#2`")


@query("filter_halfopen_month", f"""
SELECT o_orderkey, o_orderdate::DATE AS d FROM orders WHERE o_orderdate >= {S.LO} AND o_orderdate < {S.HI}""")
def filter_halfopen_month(g):
    return g.orders.where(in_prev_month(F.col("o_orderdate"), AS_OF)).select(
        "o_orderkey", F.to_date("o_orderdate").alias("d"))


@query("filter_between_dates", """
SELECT l_orderkey, l_linenumber, l_shipdate::DATE AS d FROM lineitem
WHERE l_shipdate::DATE BETWEEN DATE '1998-03-01' AND DATE '1998-05-31'""")
def filter_between_dates(g):
    between = F.col("l_shipdate").between(F.lit(date(1998, 3, 1)), F.lit(date(1998, 5, 31)))
    return g.lineitem.where(between).select("l_orderkey", "l_linenumber", F.to_date("l_shipdate").alias("d"))


@query("filter_before_cutoff", f"SELECT o_custkey, count(*) AS n FROM orders WHERE o_orderdate < {S.D} GROUP BY 1")
def filter_before_cutoff(g):
    return g.orders.where(F.col("o_orderdate") < F.lit(AS_OF)).groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))


@query("filter_interval_contains", f"""
WITH {ORDER_INTERVALS} SELECT * FROM intervals WHERE {S.D} BETWEEN valid_from AND valid_to""")
def filter_interval_contains(g):
    intervals = close_intervals(order_days(g), ["o_custkey"], "valid_from", "valid_to")
    return valid_on(intervals, AS_OF, "valid_from", "valid_to")


@query("filter_in_list", """
SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders
WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_orderstatus NOT IN ('P') GROUP BY 1, 2""")
def filter_in_list(g):
    keep = F.col("o_orderpriority").isin("1-URGENT", "2-HIGH") & ~F.col("o_orderstatus").isin("P")
    return g.orders.where(keep).groupBy("o_orderstatus", "o_orderpriority").agg(F.count(F.lit(1)).alias("n"))


@query("filter_like_prefix", "SELECT p_partkey, p_name FROM part WHERE p_name LIKE 'red%'")
def filter_like_prefix(g):
    return g.part.where(F.col("p_name").startswith("red")).select("p_partkey", "p_name")


@query("filter_like_wildcard", "SELECT p_partkey, p_brand FROM part WHERE p_brand LIKE 'Brand#1_%'")
def filter_like_wildcard(g):
    return g.part.where(F.col("p_brand").like("Brand#1_%")).select("p_partkey", "p_brand")


@query("filter_or_patterns", """
SELECT p_type, count(*) AS n FROM part
WHERE (p_name LIKE 'small%' AND p_size > 20) OR (p_name LIKE '%widget' AND p_type = 'PROMO') GROUP BY 1""")
def filter_or_patterns(g):
    small = F.col("p_name").like("small%") & (F.col("p_size") > 20)
    promo = F.col("p_name").like("%widget") & (F.col("p_type") == "PROMO")
    return g.part.where(small | promo).groupBy("p_type").agg(F.count(F.lit(1)).alias("n"))


_CLOSED = """
WITH a AS (SELECT s_suppkey, CASE WHEN s_acctbal < 7000 THEN NULL WHEN s_acctbal < 8500 THEN DATE '1998-06-20'
                                  ELSE DATE '1998-07-10' END AS closing_date FROM supplier)"""


@query("filter_null_test", f"""{_CLOSED}
SELECT s_suppkey, closing_date FROM a WHERE closing_date IS NULL OR closing_date >= {S.HI}""")
def filter_null_test(g):
    closing = (F.when(F.col("s_acctbal") < 7000, F.lit(None))
               .when(F.col("s_acctbal") < 8500, F.lit(date(1998, 6, 20))).otherwise(F.lit(date(1998, 7, 10))))
    a = g.supplier.select("s_suppkey", closing.cast("date").alias("closing_date"))
    return a.where(F.col("closing_date").isNull() | (F.col("closing_date") >= F.lit(date(1998, 7, 1))))


@query("filter_bool_3vl", """
WITH f AS (SELECT l_suppkey, CASE l_returnflag WHEN 'R' THEN TRUE WHEN 'A' THEN FALSE END AS flag FROM lineitem)
SELECT l_suppkey, count(*) FILTER (WHERE flag IS TRUE) AS n_true, count(*) FILTER (WHERE flag IS FALSE) AS n_false,
       count(*) FILTER (WHERE flag IS NOT TRUE) AS n_not_true FROM f GROUP BY 1""")
def filter_bool_3vl(g):
    flag = F.when(F.col("l_returnflag") == "R", True).when(F.col("l_returnflag") == "A", False)
    return g.lineitem.select("l_suppkey", flag.alias("flag")).groupBy("l_suppkey").agg(
        F.count_if(F.col("flag").eqNullSafe(True)).alias("n_true"),
        F.count_if(F.col("flag").eqNullSafe(False)).alias("n_false"),
        F.count_if(~F.col("flag").eqNullSafe(True)).alias("n_not_true"))


@query("filter_not_equal", "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus <> 'P'")
def filter_not_equal(g):
    return g.orders.where(F.col("o_orderstatus") != "P").select("o_orderkey", "o_orderstatus")


# Calendar in SQL: an island lies between neighbouring working days more than a day apart;
# the calendar's ends close a run that touches them. ``bounds`` are the days to take.
ISLANDS = S.CALENDAR + """,
stops AS (
  SELECT calendar_date AS d, FALSE AS opens FROM calendar WHERE NOT holiday_flag
  UNION SELECT calendar_date, TRUE FROM calendar
        WHERE holiday_flag AND calendar_date = (SELECT min(calendar_date) FROM calendar)
  UNION SELECT max(calendar_date) + 1, FALSE FROM calendar
),
steps AS (SELECT lag(d) OVER (ORDER BY d) AS start_date, d AS finish_date, lag(opens) OVER (ORDER BY d) AS opens FROM stops),
islands AS (SELECT start_date, finish_date FROM steps WHERE finish_date - start_date > 1 OR opens),
bounds AS (
  SELECT coalesce(max(start_date), {e} - 1) AS lo, coalesce(max(finish_date), {e}) - 1 AS hi
  FROM islands WHERE start_date < {e} AND finish_date >= {e}
)""".replace("{e}", S.E)

_IN_WINDOW = f"""
WITH {ISLANDS}
SELECT event_id, user_id, ts::DATE AS day FROM events, bounds WHERE ts::DATE BETWEEN lo AND hi"""


@query("filter_case_scalar", _IN_WINDOW)
def filter_case_scalar(g):
    days = g.events.select("event_id", "user_id", F.to_date("ts").alias("day"))
    window = posting_window(g.calendar, EVENT_DAY)
    return filter_by_window(days, "day", window, "start_date", "end_date", fallback=date(2024, 1, 14))


@query("filter_by_name_list", """
SELECT n_name, count(*) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey
WHERE n_name IN ('NATION_1', 'NATION_7', 'NATION_19', 'no such name') GROUP BY 1""")
def filter_by_name_list(g):
    wanted = select_named(g.nation, ["NATION_1", "NATION_7", "NATION_19", "no such name"], "n_name")
    return g.customer.join(wanted, F.col("c_nationkey") == F.col("n_nationkey")).groupBy("n_name").agg(
        F.count(F.lit(1)).alias("n"))


@query("sort_expr", """
SELECT o_orderkey, (o_totalprice::DECIMAL(18,2) - 250000)::DOUBLE AS diff FROM orders""")
def sort_expr(g):
    diff = money(F.col("o_totalprice")) - F.lit(250000)
    return g.orders.select("o_orderkey", dbl(diff).alias("diff")).orderBy(F.col("diff"), "o_orderkey")


@query("sort_case_rank", """
SELECT c_custkey, c_mktsegment, CASE WHEN abs(c_acctbal) >= 9000 THEN 'КРИТИЧЕСКОЕ' WHEN abs(c_acctbal) >= 5000
       THEN 'ВЫСОКОЕ' WHEN abs(c_acctbal) >= 1000 THEN 'СРЕДНЕЕ' ELSE 'НИЗКОЕ' END AS severity, abs(c_acctbal) AS amount
FROM customer""")
def sort_case_rank(g):
    size = F.abs(F.col("c_acctbal"))
    severity = F.when(size >= 9000, fv.CRITICAL).when(size >= 5000, fv.HIGH).when(size >= 1000, fv.MEDIUM).otherwise(fv.LOW)
    rows = g.customer.select("c_custkey", "c_mktsegment", severity.alias("severity"), size.alias("amount"))
    return rank_sort(rows, {"c_mktsegment": ["MACHINERY", "BUILDING"], "severity": [fv.CRITICAL, fv.HIGH, fv.MEDIUM]},
                     [F.col("amount").desc(), F.col("c_custkey")])


@query("sort_limit1", f"""
SELECT o_orderdate::DATE AS d, o_orderkey FROM orders WHERE o_orderdate >= {S.D} ORDER BY o_orderdate, o_orderkey LIMIT 1""")
def sort_limit1(g):
    later = g.orders.where(F.col("o_orderdate") >= F.lit(AS_OF))
    return first_by(later, F.col("o_orderdate"), F.col("o_orderkey")).select(
        F.to_date("o_orderdate").alias("d"), "o_orderkey")


@query("limit_n", "SELECT event_id, value FROM events ORDER BY value DESC, event_id LIMIT 25")
def limit_n(g):
    return sample_n(g.events, 25, F.col("value").desc(), F.col("event_id")).select("event_id", "value")


@query("union_all_sources", """
SELECT 'customer' AS source, c_nationkey AS nationkey, c_acctbal AS balance FROM customer
UNION ALL SELECT 'supplier', s_nationkey, s_acctbal FROM supplier""")
def union_all_sources(g):
    return union_sources(
        g.customer.select(F.lit("customer").alias("source"), F.col("c_nationkey").alias("nationkey"),
                          F.col("c_acctbal").alias("balance")),
        g.supplier.select(F.col("s_acctbal").alias("balance"), F.lit("supplier").alias("source"),
                          F.col("s_nationkey").alias("nationkey")))


@query("union_distinct", """
SELECT o_custkey AS k FROM orders UNION SELECT user_id FROM events""")
def union_distinct(g):
    return union_sources(
        g.orders.select(F.col("o_custkey").alias("k")),
        g.events.select(F.col("user_id").alias("k"))).distinct()


@query("union_all_explicit", """
SELECT o_custkey AS account, o_orderdate::DATE AS day, o_totalprice AS amount, TRUE AS legacy FROM orders
WHERE o_orderdate < DATE '1998-01-01'
UNION ALL
SELECT l_suppkey, l_shipdate::DATE, l_extendedprice, FALSE FROM lineitem WHERE l_shipdate >= DATE '1998-01-01'""")
def union_all_explicit(g):
    cut = F.lit(date(1998, 1, 1))
    legacy = g.orders.where(F.col("o_orderdate") < cut).select(
        "o_orderkey", F.col("o_custkey").alias("account"), F.to_date("o_orderdate").alias("day"),
        F.col("o_totalprice").alias("amount"), F.lit(True).alias("legacy"))
    new = g.lineitem.where(F.col("l_shipdate") >= cut).select(
        F.lit(False).alias("legacy"), F.col("l_extendedprice").alias("amount"),
        F.to_date("l_shipdate").alias("day"), F.col("l_suppkey").alias("account"))
    return union_aligned(["account", "day", "amount", "legacy"], legacy, new)
