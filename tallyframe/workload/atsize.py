"""Rows of the reports that need an algorithm of their own at size."""

from datetime import date

from pyspark.sql import functions as F

from ..delivery.claims import ClaimLedger
from ..delivery.variant_log import variant_log_view, write_variant_log
from ..functions import money
from ..operators.allocation import allocate_fifo
from ..operators.carry import asof_join
from ..operators.digest_tree import tree_compare
from ..operators.intervals import containment_join
from ..operators.rule_table import match_rules
from ..plans.turnover_state import TurnoverState
from ..session import work_dir
from ..sources.buckets import BucketedTable
from ..streaming import follow_versions
from .finals import TURNOVER
from .registry import query
from .reports import LOGS, logs
from .tables import CUTOVER, EVENT_DAY, dbl, doubles


@query("rep_register_digest_tree", """
WITH lines AS (
  SELECT l_orderkey AS number, count(*) FILTER (l_returnflag = 'R' AND l_quantity = 50) AS back FROM lineitem GROUP BY 1),
a AS (SELECT o_orderkey AS number, o_orderdate::DATE AS opened, o_orderstatus AS status, o_totalprice::DECIMAL(18,2) AS amount
      FROM orders WHERE NOT (o_orderstatus = 'P' AND o_totalprice < 10000)),
b AS (SELECT o_orderkey AS number, o_orderdate::DATE AS opened, o_orderstatus AS status,
             CASE WHEN back < 2 THEN o_totalprice::DECIMAL(18,2) + back END AS amount
      FROM orders JOIN lines ON number = o_orderkey)
SELECT coalesce(a.number, b.number) AS number, a.number IS NOT NULL AS in_a, b.number IS NOT NULL AS in_b, a.opened AS a_opened,
       b.opened AS b_opened, a.status AS a_status, b.status AS b_status, a.amount::DOUBLE AS a_amount, b.amount::DOUBLE AS b_amount
FROM a FULL JOIN b ON a.number = b.number
WHERE a.number IS NULL OR b.number IS NULL OR a.opened IS DISTINCT FROM b.opened OR a.status IS DISTINCT FROM b.status
   OR a.amount IS DISTINCT FROM b.amount""")
def rep_register_digest_tree(g):
    """Orders against a copy that lacks orders without lines and has other amounts where lines came back."""
    amount = money(F.col("o_totalprice"))
    orders = g.orders.select(
        F.col("o_orderkey").alias("number"), F.to_date("o_orderdate").alias("opened"), F.col("o_orderstatus").alias("status"),
        amount.alias("amount"))
    returned = (F.col("l_returnflag") == "R") & (F.col("l_quantity") == 50)
    lines = g.lineitem.groupBy(F.col("l_orderkey").alias("number")).agg(F.count_if(returned).alias("back"))
    copy = orders.join(lines, "number").select(
        "number", "opened", "status", money(F.when(F.col("back") < 2, F.col("amount") + F.col("back"))).alias("amount"))
    found = tree_compare(orders.where("NOT (status = 'P' AND amount < 10000)"), copy, ["number"])
    return doubles(found, "a_amount", "b_amount")


@query("rep_fifo_allocation", """
WITH pay AS (
  SELECT o_custkey AS account, o_orderkey AS id, o_totalprice::DECIMAL(18,2) AS amount,
         sum(amount) OVER (PARTITION BY account ORDER BY o_orderdate, id) AS upto FROM orders),
lines AS (
  SELECT l_orderkey, l_orderkey * 10 + l_linenumber AS id, min(l_shipdate) AS shipped, sum(l_extendedprice::DECIMAL(18,2)) AS amount
  FROM lineitem GROUP BY l_orderkey, l_linenumber),
doc AS (
  SELECT o_custkey AS account, id, amount, sum(amount) OVER (PARTITION BY account ORDER BY shipped, id) AS upto
  FROM lines JOIN orders ON l_orderkey = o_orderkey),
parts AS (
  SELECT p.account, p.id AS payment, d.id AS document, least(p.upto, d.upto) - greatest(p.upto - p.amount, d.upto - d.amount) AS part
  FROM pay p JOIN doc d ON p.account = d.account AND p.upto - p.amount < d.upto AND d.upto - d.amount < p.upto)
SELECT account, payment, document, part::DOUBLE AS allocated FROM parts
UNION ALL
SELECT account, id, NULL, (amount - coalesce((SELECT sum(part) FROM parts WHERE payment = pay.id), 0))::DOUBLE FROM pay
WHERE amount > coalesce((SELECT sum(part) FROM parts WHERE payment = pay.id), 0)
UNION ALL
SELECT account, NULL, id, (amount - coalesce((SELECT sum(part) FROM parts WHERE document = doc.id), 0))::DOUBLE FROM doc
WHERE amount > coalesce((SELECT sum(part) FROM parts WHERE document = doc.id), 0)""")
def rep_fifo_allocation(g):
    """Orders as payments of customers, their lines as documents."""
    payments = g.orders.select(
        F.col("o_custkey").alias("account"), F.col("o_orderdate").alias("at"), F.col("o_orderkey").alias("id"),
        money(F.col("o_totalprice")).alias("amount"))
    lines = g.lineitem.groupBy("l_orderkey", "l_linenumber").agg(
        F.min("l_shipdate").alias("at"), money(F.sum(money(F.col("l_extendedprice")))).alias("amount"))
    documents = lines.join(g.orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_custkey").alias("account"), "at", (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"), "amount")
    return doubles(allocate_fifo(payments, documents, ["account"], ["at", "id"], "id"), "allocated")


@query("join_interval_containment", """
WITH windows AS (
  SELECT c_custkey, DATE '1995-01-01' + (c_custkey * 37 % 2400)::INT AS opens,
         CASE WHEN c_mktsegment = 'BUILDING' AND c_acctbal < -900 THEN NULL
              WHEN c_acctbal < 0 THEN DATE '1995-01-01' + (c_custkey * 37 % 2400)::INT + 90
              ELSE DATE '1995-01-01' + (c_custkey * 37 % 2400)::INT + floor(c_acctbal / 2500)::INT END AS closes FROM customer)
SELECT c_custkey, opens, closes, count(*) AS n, sum(o_totalprice::DECIMAL(18,2))::DOUBLE AS amount
FROM windows JOIN orders ON o_orderdate::DATE >= opens AND (closes IS NULL OR o_orderdate::DATE <= closes) GROUP BY ALL""")
def join_interval_containment(g):
    """All orders within a window of days of each customer: some of a few days, some of months, some open."""
    days = F.when(F.col("c_acctbal") < 0, 90).otherwise(F.floor(F.col("c_acctbal") / 2500).cast("int"))
    windows = g.customer.withColumn("opens", F.expr("date_add(DATE'1995-01-01', CAST(c_custkey * 37 % 2400 AS int))")).select(
        "c_custkey", "opens",
        F.when(~((F.col("c_mktsegment") == "BUILDING") & (F.col("c_acctbal") < -900)), F.date_add("opens", days)).alias("closes"))
    # a row per day meets the windows: pairs grow with the customers, not with customers times orders
    days_of_orders = g.orders.groupBy(F.to_date("o_orderdate").alias("day")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(money(F.col("o_totalprice"))).alias("amount"))
    met = containment_join(days_of_orders, windows, "day", "opens", "closes")
    return met.groupBy("c_custkey", "opens", "closes").agg(F.sum("n").alias("n"), dbl(F.sum("amount")).alias("amount"))


@query("asof_join_streams", """
WITH buys AS (
  SELECT user_id, ts, max(event_id) AS bought, arg_max(value, event_id) AS bought_value FROM events WHERE event_type = 'purchase' GROUP BY 1, 2)
SELECT e.event_id, e.user_id, e.event_type, bought, bought_value
FROM (FROM events WHERE event_type <> 'purchase') e ASOF LEFT JOIN buys b ON e.user_id = b.user_id AND e.ts >= b.ts""")
def asof_join_streams(g):
    """Every other event of a user with the user's last purchase before it."""
    others = g.events.where("event_type <> 'purchase'").select("event_id", "user_id", "event_type", "ts")
    buys = g.events.where("event_type = 'purchase'").select(
        "user_id", "ts", F.col("event_id").alias("bought"), F.col("value").alias("bought_value"))
    return asof_join(others, buys, ["user_id"], "ts", "ts", ["bought", "bought_value"], "bought").drop("ts")


_MOVES = ["in_amount", "out_amount", "debit_amount", "credit_amount"]


def late_changes(g):
    """The journal's changes, a third of them known a day later and a third two days later."""
    changes = g.turnover_tables["journal_changes"]
    return {**g.turnover_tables, "journal_changes": changes.withColumn("dt", F.expr("date_add(dt, CAST(doc_id % 1000 % 3 AS int))"))}


@query("q_turnover_steps", f"""
WITH {TURNOVER.replace("day AS dt", "day + (k % 3)::INT AS dt")}
SELECT balance_date, account_id, second_order_account_number, account_number,
       {", ".join(f"{c}::DOUBLE AS {c}" for c in _MOVES)} FROM turnover""")
def q_turnover_steps(g):
    """The day's turnover from a state that went there in steps, with late changes."""
    tables = late_changes(g)
    state = TurnoverState(g.spark, work_dir(g.spark, "turnover"), CUTOVER)
    for day in (CUTOVER, date(2024, 1, 11), date(2024, 1, 14), EVENT_DAY):
        state.advance(tables, day)
    return doubles(state.turnover(tables), *_MOVES)


_VERSION = ["l_orderkey", "l_linenumber"]
_LINES = [*_VERSION, "l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice"]
_LATEST_LINES = f"""
SELECT {", ".join(_LINES)} FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC) = 1"""
_NEWEST = ["l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice"]


@query("win_latest_stream", _LATEST_LINES)
def win_latest_stream(g):
    """The newest version of every line from a stream of files, in several batches."""
    folder = work_dir(g.spark, "stream")
    g.lineitem.select(*_LINES).repartition(6).write.parquet(f"{folder}/changes")
    stream = g.spark.readStream.schema(g.lineitem.select(*_LINES).schema).option("maxFilesPerTrigger", 2).parquet(f"{folder}/changes")
    table = BucketedTable(g.spark, f"{folder}/table", _VERSION, _NEWEST, buckets=8)
    follow_versions(stream, table, f"{folder}/checkpoint", compact_every=2, availableNow=True).awaitTermination()
    return table.merged()


@query("scan_merge_bucketed", _LATEST_LINES)
def scan_merge_bucketed(g):
    """A bucketed base of the lines up to a day, and the later lines as changes: one batch compacted, one merged on reading."""
    lines = g.lineitem.select(*_LINES)
    table = BucketedTable(g.spark, work_dir(g.spark, "buckets"), _VERSION, _NEWEST, buckets=8)
    shipped = F.to_date("l_shipdate")
    table.create(lines.where(shipped < F.lit(date(1998, 1, 1))))
    table.add_batch(lines.where((shipped >= F.lit(date(1998, 1, 1))) & (shipped < F.lit(date(2000, 1, 1)))), 0)
    table.compact()
    table.add_batch(lines.where(shipped >= F.lit(date(2000, 1, 1))), 1)
    return table.merged()


@query("rep_log_view_variant", f"""
WITH {LOGS}
SELECT event_id, result, ticket_key, error_msg, unnest(CASE WHEN len(paths) = 0 THEN [''] ELSE paths END) AS filepath
FROM detailed""")
def rep_log_view_variant(g):
    """The log view from details that were parsed once and stored as VARIANT."""
    log = write_variant_log(logs(g), work_dir(g.spark, "variant-log"))
    return variant_log_view(log, "REPORTS").select("event_id", "result", "ticket_key", "error_msg", "filepath")


_RULES = """
rules AS (
  SELECT DISTINCT substr(p_name, 1, 3 + p_partkey % 6) || '%' AS pattern, min(p_partkey) OVER (PARTITION BY pattern) AS rank,
         'rule ' || rank AS label FROM part
  UNION ALL SELECT '%widget', 1000000, 'a widget' UNION ALL SELECT 's_all%', 2, 'small')"""


def part_rules(g):
    """Beginnings of part names, shorter and longer ones, as rules; the first part that has one gives its rank."""
    pattern = F.concat(F.substring(F.col("p_name"), F.lit(1), (3 + F.col("p_partkey") % 6).cast("int")), F.lit("%"))
    own = g.part.groupBy(pattern.alias("pattern")).agg(F.min("p_partkey").alias("rank"))
    own = own.withColumn("label", F.concat(F.lit("rule "), F.col("rank").cast("string")))
    more = g.spark.createDataFrame([("%widget", 1000000, "a widget"), ("s_all%", 2, "small")], own.schema)
    return own.unionByName(more)


@query("fn_rule_table", f"""
WITH {_RULES}, matches AS (
  SELECT DISTINCT p_name, pattern, rank, label, length(regexp_extract(pattern, '^[^%_]*')) AS size
  FROM (SELECT DISTINCT p_name FROM part) JOIN rules ON p_name LIKE pattern),
first AS (SELECT * FROM matches QUALIFY row_number() OVER (PARTITION BY p_name ORDER BY rank, size DESC, pattern) = 1),
longest AS (SELECT * FROM matches QUALIFY row_number() OVER (PARTITION BY p_name ORDER BY size DESC, pattern) = 1)
SELECT p_partkey, p_name, first.label AS first_label, longest.label AS longest_label
FROM part LEFT JOIN first USING (p_name) LEFT JOIN longest USING (p_name)""")
def fn_rule_table(g):
    """Every part with the first and with the longest rule that its name matches."""
    rules = part_rules(g)
    first = match_rules(g.part.select("p_partkey", "p_name"), "p_name", rules, "pattern", "label", "rank", name="first_label")
    return match_rules(first, "p_name", rules, "pattern", "label", name="longest_label")


@query("rep_delivery_claims", """
SELECT o_custkey, count(*) AS n_items, count(DISTINCT o_orderkey) AS n_orders FROM orders GROUP BY 1""")
def rep_delivery_claims(g):
    """Orders delivered by two runs that overlap: each goes out once."""
    folder = work_dir(g.spark, "claims")
    ledger = ClaimLedger(g.spark, f"{folder}/ledger", ["o_orderkey"])
    orders = g.orders.select("o_orderkey", "o_custkey", "o_orderstatus").dropDuplicates(["o_orderkey"])

    def send(items, claim):
        items.write.mode("overwrite").parquet(f"{folder}/sent/claim={claim}")

    ledger.deliver(orders.where("o_orderstatus <> 'P'"), send)
    ledger.deliver(orders.where("o_orderstatus <> 'F'"), send)
    ledger.deliver(orders, send)
    sent = g.spark.read.schema(orders.schema).parquet(f"{folder}/sent")
    return sent.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n_items"), F.countDistinct("o_orderkey").alias("n_orders"))
