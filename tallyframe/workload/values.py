"""Scalar functions, each over a whole table."""

from datetime import date

from pyspark.sql import functions as F

from ..functions import (
    account_class, apply_mask, classify, explode_json_array, json_field, map_value, money, money_round,
    month_bounds, norm_id, report_dates, safe_name,
)
from .registry import query
from .tables import RUN_TS, dbl


@query("fn_month_bounds", """
SELECT o_orderkey, (date_trunc('month', o_orderdate) - INTERVAL 1 MONTH)::DATE AS lo, date_trunc('month', o_orderdate)::DATE AS hi,
       (date_trunc('month', o_orderdate) - INTERVAL 1 DAY)::DATE AS last_day FROM orders""")
def fn_month_bounds(g):
    lo, hi = month_bounds(F.to_date("o_orderdate"))
    return g.orders.select("o_orderkey", lo.alias("lo"), hi.alias("hi"), F.date_sub(hi, 1).alias("last_day"))


@query("fn_date_arith", """
SELECT l_orderkey, l_linenumber, l_shipdate::DATE - 30 AS back, l_shipdate::DATE + 1 AS ahead,
       (l_shipdate - INTERVAL 1 MONTH)::DATE AS month_back, datediff('day', DATE '1995-01-01', l_shipdate::DATE) AS age
FROM lineitem""")
def fn_date_arith(g):
    d = F.to_date("l_shipdate")
    return g.lineitem.select(
        "l_orderkey", "l_linenumber", F.date_sub(d, 30).alias("back"), F.date_add(d, 1).alias("ahead"),
        F.add_months(d, -1).alias("month_back"), F.datediff(d, F.lit(date(1995, 1, 1))).cast("bigint").alias("age"))


@query("fn_to_date", """
SELECT event_id, ts::DATE AS day, strftime(ts, '%Y-%m-%d')::DATE AS day_of_text FROM events""")
def fn_to_date(g):
    return g.events.select(
        "event_id", F.to_date("ts").alias("day"), F.to_date(F.date_format("ts", "yyyy-MM-dd")).alias("day_of_text"))


@query("fn_extract_day", "SELECT day(o_orderdate)::BIGINT AS day_of_month, count(*) AS n FROM orders GROUP BY 1")
def fn_extract_day(g):
    return g.orders.groupBy(F.dayofmonth("o_orderdate").cast("bigint").alias("day_of_month")).agg(
        F.count(F.lit(1)).alias("n"))


_NUMBER = "(CASE WHEN c_acctbal < 0 THEN '30232' ELSE '40702' END) || '81051' || lpad(c_custkey::VARCHAR, 10, '0')"


def _number():
    head = F.when(F.col("c_acctbal") < 0, "30232").otherwise("40702")
    return F.concat(head, F.lit("81051"), F.lpad(F.col("c_custkey").cast("string"), 10, "0"))


@query("fn_substr", f"""
SELECT substr({_NUMBER}, 1, 5) AS account_class, count(*) AS n FROM customer GROUP BY 1""")
def fn_substr(g):
    return g.customer.groupBy(account_class(_number()).alias("account_class")).agg(F.count(F.lit(1)).alias("n"))


@query("fn_norm_id", """
SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_custkey END AS id, o_orderstatus = 'P' AS is_unfit FROM orders""")
def fn_norm_id(g):
    stored = F.concat(F.col("o_custkey").cast("string"), F.when(F.col("o_orderstatus") == "P", "x").otherwise(".0000000000"))
    ids = g.orders.select("o_orderkey", norm_id(stored).alias("id"))
    return ids.withColumn("is_unfit", F.col("id").isNull())


@query("fn_coalesce", """
SELECT c_custkey, coalesce(CASE WHEN c_acctbal < 0 THEN c_name END, CASE WHEN c_nationkey < 5 THEN c_mktsegment END, '-') AS name
FROM customer""")
def fn_coalesce(g):
    return g.customer.select("c_custkey", F.coalesce(
        F.when(F.col("c_acctbal") < 0, F.col("c_name")), F.when(F.col("c_nationkey") < 5, F.col("c_mktsegment")),
        F.lit("-")).alias("name"))


@query("fn_case_searched", """
SELECT cls, count(*) AS n, sum(l_quantity::DECIMAL(18,2))::DOUBLE AS quantity FROM (
  SELECT l_quantity, CASE WHEN l_returnflag = 'R' AND l_quantity > 25 THEN 'large return' WHEN l_returnflag = 'R' THEN 'return'
    WHEN l_discount > 0.05 THEN 'discount' ELSE 'plain' END AS cls FROM lineitem) GROUP BY 1""")
def fn_case_searched(g):
    returned = F.col("l_returnflag") == "R"
    cls = classify([("large return", returned & (F.col("l_quantity") > 25)), ("return", returned),
                    ("discount", F.col("l_discount") > 0.05)], "plain")
    return g.lineitem.groupBy(cls.alias("cls")).agg(
        F.count(F.lit(1)).alias("n"), dbl(F.sum(money(F.col("l_quantity")))).alias("quantity"))


@query("fn_case_simple", """
SELECT o_orderkey, CASE o_orderstatus WHEN 'O' THEN 'open' WHEN 'F' THEN 'filled' END AS label,
       CASE o_orderpriority WHEN '1-URGENT' THEN 1 WHEN '2-HIGH' THEN 2 ELSE 9 END AS place FROM orders""")
def fn_case_simple(g):
    return g.orders.select(
        "o_orderkey", map_value(F.col("o_orderstatus"), {"O": "open", "F": "filled"}).alias("label"),
        map_value(F.col("o_orderpriority"), {"1-URGENT": 1, "2-HIGH": 2}, 9).alias("place"))


@query("fn_abs_round_neg", """
SELECT l_orderkey, l_linenumber,
  round(abs(-1 * l_extendedprice::DECIMAL(18,2) * l_discount::DECIMAL(18,2)), 2)::DOUBLE AS discount FROM lineitem""")
def fn_abs_round_neg(g):
    discount = -money(F.col("l_extendedprice")) * money(F.col("l_discount"))
    return g.lineitem.select("l_orderkey", "l_linenumber", dbl(money_round(F.abs(discount))).alias("discount"))


_ETC = """
logs AS (SELECT event_id, event_type, ts, regexp_extract(props, '"k": *([0-9]+)', 1)::BIGINT AS k FROM events)"""


@query("fn_json_text", f"""
WITH {_ETC} SELECT event_id, k::VARCHAR AS k, '' AS absent FROM logs""")
def fn_json_text(g):
    return g.events.select("event_id", json_field(F.col("props"), "k").alias("k"), json_field(F.col("props"), "x").alias("absent"))


_PATHS = """CASE WHEN k >= 90 THEN [] WHEN k >= 50 THEN ['out/' || k || '.csv']
            ELSE ['out/' || k || '.csv', 'out/' || event_type || '.xlsx'] END"""


def etc_of(g):
    """Events with details as a JSON text holding no, one or two file paths."""
    return g.events.withColumn("k", F.get_json_object("props", "$.k").cast("int")).withColumn("etc", F.expr("""
        to_json(named_struct(
            'result', if(event_type = 'error', 'ERROR', 'SUCCESS'),
            'ticket_key', if(k < 10, concat('TICKET-', k), NULL),
            'error_msg', if(event_type = 'error', concat('failed at ', k), NULL),
            'attachment_paths', CASE WHEN k >= 90 THEN CAST(array() AS array<string>)
                WHEN k >= 50 THEN array(concat('out/', k, '.csv'))
                ELSE array(concat('out/', k, '.csv'), concat('out/', event_type, '.xlsx')) END))"""))


@query("fn_json_array_explode", f"""
WITH {_ETC}, p AS (SELECT event_id, {_PATHS} AS paths FROM logs)
SELECT event_id, unnest(CASE WHEN len(paths) = 0 THEN [''] ELSE paths END) AS filepath FROM p""")
def fn_json_array_explode(g):
    paths = json_field(F.col("etc"), "attachment_paths")
    return explode_json_array(etc_of(g), paths, "filepath").select("event_id", "filepath")


@query("fn_replace_char", "SELECT page_id, replace(url, '/', '_') AS name FROM pages")
def fn_replace_char(g):
    return g.pages.select("page_id", safe_name(F.col("url")).alias("name"))


_NOM = "['январь','февраль','март','апрель','май','июнь','июль','август','сентябрь','октябрь','ноябрь','декабрь']"
_GEN = "['января','февраля','марта','апреля','мая','июня','июля','августа','сентября','октября','ноября','декабря']"


@query("fn_report_dates", f"""
WITH d AS (SELECT o_orderkey, o_orderdate::DATE AS d, (o_orderdate - INTERVAL 1 MONTH)::DATE AS p FROM orders)
SELECT o_orderkey, strftime(d, '%Y-%m-%d') AS "DT", strftime(d, '%Y/%m/%d') AS "DT_SLASH",
  {_NOM}[month(p)] || ' ' || year(p) AS "PREV_CYR_MONTH", strftime(p, '%Y/%m') AS "PREV_CYR_MONTH_SLASH",
  '"' || day(d) || '" ' || {_GEN}[month(d)] || ' ' || year(d) AS "CYR_DT",
  '"01" ' || {_GEN}[month(d)] || ' ' || year(d) AS "CYR_DT_1ST", '2024-01-15 09_30_00' AS "DTTM" FROM d""")
def fn_report_dates(g):
    texts = report_dates(F.to_date("o_orderdate"), F.lit(RUN_TS))
    return g.orders.select("o_orderkey", *[c.alias(name) for name, c in texts.items()])


@query("fn_number_mask", """
SELECT o_orderkey, format('{:,.2f}', o_totalprice) AS grouped, format('{:.2f}', o_totalprice) AS plain,
       strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders""")
def fn_number_mask(g):
    price = money(F.col("o_totalprice"))
    return g.orders.select(
        "o_orderkey", apply_mask(price, "N", "#,#0.00").alias("grouped"), apply_mask(price, "N", "%.2f").alias("plain"),
        apply_mask(F.to_date("o_orderdate"), "D", "yyyy-mm-dd").alias("day"))
