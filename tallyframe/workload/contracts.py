"""Output contracts and the reports known by their columns only."""

from datetime import date

from pyspark.sql import functions as F

from ..delivery.catalogue import CONTRACTS
from ..delivery.contracts import Col, Contract, apply_contract, contract_problems
from ..functions import money
from ..plans.schema_only import (
    acquiring_totals, auto_funding, card_transactions, credit_transactions, document_messages, fake_clears,
    merchants_monthly, transaction_duplicates,
)
from ..sources.sinks import with_run_columns
from .finals import PAYMENTS, payments
from . import sqltables as S
from .registry import query
from .reports import STATUSES, statuses
from .tables import EVENT_DAY, RUN_TS, dbl, doubles

_PRICE = "l_extendedprice::DECIMAL(18,2)"


@query("contract_apply", f"""
WITH {PAYMENTS}
SELECT agreement_number, client_name, agreement_type, account_number, out_balance_amount::DOUBLE AS out_balance_amount,
       payment_documents_amount::DOUBLE AS payment_documents_amount,
       (payment_documents_amount - out_balance_amount)::DOUBLE AS diff_amount FROM payments""")
def contract_apply(g):
    result = payments(g, ordered=False)
    history = with_run_columns(result, RUN_TS, EVENT_DAY).unionByName(
        with_run_columns(result.where("diff_amount <> 0"), RUN_TS, date(2024, 1, 14)))
    out = apply_contract(history, CONTRACTS["merchants_payments"], EVENT_DAY, "2024-01-15 09_30_00")
    return out.select(*[dbl(c).alias(c) if c.endswith("_amount") else c for c in out.columns])


@query("contract_check", """
SELECT 'number' AS column_name, 'S' AS kind, count(*) AS n_rows, count(CASE WHEN o_orderkey IS NULL THEN 1 END) AS n_null, 0 AS n_unfit
FROM orders
UNION ALL SELECT 'opened', 'D', count(*), 0, count(CASE WHEN o_orderpriority = '5-LOW' THEN 1 END) FROM orders
UNION ALL SELECT 'amount', 'N', count(*), count(CASE WHEN o_orderstatus = 'P' THEN 1 END),
                 count(CASE WHEN o_orderstatus = 'F' AND o_custkey > 100 THEN 1 END) FROM orders""")
def contract_check(g):
    contract = Contract("orders", (Col("number", "Номер"), Col("opened", "Дата", "D"), Col("amount", "Сумма", "N")))
    amount = F.when(F.col("o_orderstatus") == "O", F.col("o_totalprice").cast("string")).when(
        F.col("o_orderstatus") == "F", F.when(F.col("o_custkey") > 100, "12,50").otherwise("12.50"))
    opened = F.when(F.col("o_orderpriority") == "5-LOW", "soon").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    texts = g.orders.select(
        F.col("o_orderkey").cast("string").alias("number"), opened.alias("opened"), amount.alias("amount"))
    return contract_problems(texts, contract)


@query("c_account_status", f"WITH {STATUSES} SELECT * FROM compared WHERE error_name IS NOT NULL")
def c_account_status(g):
    return statuses(g)


@query("c_totals_diff", f"""
WITH a AS (SELECT sum(CASE WHEN o_orderstatus <> 'P' THEN o_totalprice::DECIMAL(18,2) END) AS p,
                  sum(CASE WHEN o_orderstatus = 'P' THEN o_totalprice::DECIMAL(18,2) END) AS r FROM orders),
b AS (SELECT sum(CASE WHEN l_returnflag <> 'R' THEN {_PRICE} END) AS p, sum(CASE WHEN l_returnflag = 'R' THEN {_PRICE} END) AS r
      FROM lineitem)
SELECT a.p::DOUBLE AS payments_a, b.p::DOUBLE AS payments_b, (a.p - b.p)::DOUBLE AS payments_diff,
       a.r::DOUBLE AS refunds_a, b.r::DOUBLE AS refunds_b, (a.r - b.r)::DOUBLE AS refunds_diff FROM a, b""")
def c_totals_diff(g):
    def split(rows, is_refund, amount):
        return rows.select(
            F.when(~is_refund, money(F.col(amount))).alias("payments"), F.when(is_refund, money(F.col(amount))).alias("refunds"))
    out = acquiring_totals(
        split(g.orders, F.col("o_orderstatus") == "P", "o_totalprice"),
        split(g.lineitem, F.col("l_returnflag") == "R", "l_extendedprice"))
    return doubles(out, *out.columns)


@query("c_date_pair_compare", f"""
WITH {S.REGISTERS}, sides AS (
  SELECT number, 'B' || number % 7 AS buid, opened, closed, 1 AS side FROM register_a
  UNION ALL SELECT number, 'B' || number % 7, opened, closed, 2 FROM register_b),
x AS (SELECT number::VARCHAR AS number, buid, max(opened) FILTER (side = 1) AS a_start_date, max(opened) FILTER (side = 2) AS b_start_date,
             max(closed) FILTER (side = 1) AS a_end_date, max(closed) FILTER (side = 2) AS b_end_date,
             count(DISTINCT side) AS n FROM sides GROUP BY sides.number, buid)
SELECT * EXCLUDE (n) FROM x
WHERE n = 1 OR a_start_date IS DISTINCT FROM b_start_date OR a_end_date IS DISTINCT FROM b_end_date""")
def c_date_pair_compare(g):
    def side(register):
        return register.select(
            F.col("number").cast("string").alias("number"), F.concat(F.lit("B"), (F.col("number") % 7).cast("string")).alias("buid"),
            F.col("opened").alias("start_date"), F.col("closed").alias("end_date"))
    return auto_funding(side(g.register_a), side(g.register_b))


@query("c_amount_compare", f"""
WITH a AS (SELECT o_orderstatus AS ttype, o_custkey AS c, sum(o_totalprice::DECIMAL(18,2)) AS x FROM orders GROUP BY 1, 2),
b AS (SELECT o_orderstatus AS ttype, o_custkey AS c, sum({_PRICE}) AS x
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2)
SELECT coalesce(a.ttype, b.ttype) AS ttype, 'AGR/' || coalesce(a.c, b.c) AS agr_number, coalesce(a.x, 0)::DOUBLE AS amount_a,
       c_name AS acc, coalesce(b.x, 0)::DOUBLE AS amount_b, (coalesce(a.x, 0) - coalesce(b.x, 0))::DOUBLE AS diff
FROM a FULL JOIN b ON a.ttype = b.ttype AND a.c = b.c LEFT JOIN customer ON c_custkey = coalesce(a.c, b.c)
WHERE coalesce(a.x, 0) <> coalesce(b.x, 0)""")
def c_amount_compare(g):
    keys = [F.col("o_orderstatus").alias("ttype"), g.agr_number("o_custkey").alias("agr_number")]
    lines = g.lineitem.groupBy("l_orderkey").agg(F.sum(money(F.col("l_extendedprice"))).alias("amount"))
    a = g.orders.select(*keys, money(F.col("o_totalprice")).alias("amount"))
    b = g.orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey")).select(*keys, "amount")
    accounts = g.customer.select(g.agr_number("c_custkey").alias("agr_number"), F.col("c_name").alias("acc"))
    return doubles(merchants_monthly(a, b, accounts), "amount_a", "amount_b", "diff")


# lines as transactions, orders as the documents of their customer: an order without a line is a document
# without a transaction; discounts and taxes make the sums differ
_TXNS = f"""
txns AS (
  SELECT l_shipdate::DATE AS day, 'D' || o_custkey AS debit_account_number, 'C' || o_orderstatus AS credit_account_number,
         l_linestatus AS orig_system, l_returnflag AS ttype, CASE WHEN l_quantity > 25 THEN 'out' ELSE 'in' END AS direction,
         CASE WHEN l_tax > 0.04 THEN 'far' ELSE 'near' END AS t_direction, {_PRICE} AS amount, 'AGR/' || l_suppkey AS agr_number,
         'R' || l_orderkey AS rrn, 'P' || l_partkey AS acq_ref_number, 'L' || l_linenumber AS trace_ref_number
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
),
docs AS (
  SELECT 'D' || o_custkey AS debit_account_number, 'C' || o_orderstatus AS credit_account_number, 'R' || o_orderkey AS rrn,
         o_totalprice::DECIMAL(18,2) AS amount FROM orders
),
refs AS (
  SELECT debit_account_number, credit_account_number, rrn, coalesce(sum(ta), 0) AS ra, coalesce(sum(da), 0) AS rb,
         count(ta) AS nt, count(da) AS nd
  FROM (SELECT debit_account_number, credit_account_number, rrn, amount AS ta, NULL AS da FROM txns
        UNION ALL SELECT *  EXCLUDE (amount), NULL, amount FROM docs) GROUP BY 1, 2, 3
),
wrong AS (
  SELECT *, sum(ra) OVER pair AS ga, sum(rb) OVER pair AS gb, CASE WHEN nd > 0 THEN sum(rb) OVER (PARTITION BY rrn) END AS named,
         CASE WHEN nt = 0 THEN 'no_transaction' WHEN nd = 0 THEN 'no_document' ELSE 'amount_differs' END AS error_name
  FROM refs WINDOW pair AS (PARTITION BY debit_account_number, credit_account_number) QUALIFY ra <> rb
)"""


def _lines_and_orders(g, day):
    def pair(customer, status):
        return [F.concat(F.lit("D"), F.col(customer).cast("string")).alias("debit_account_number"),
                F.concat(F.lit("C"), F.col(status)).alias("credit_account_number")]

    def tag(letter, column):
        return F.concat(F.lit(letter), F.col(column).cast("string"))
    txns = g.lineitem.join(g.orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.to_date("l_shipdate").alias(day), *pair("o_custkey", "o_orderstatus"), F.col("l_linestatus").alias("orig_system"),
        F.col("l_returnflag").alias("ttype"), F.when(F.col("l_quantity") > 25, "out").otherwise("in").alias("direction"),
        F.when(F.col("l_tax") > 0.04, "far").otherwise("near").alias("t_direction"),
        money(F.col("l_extendedprice")).alias("amount"), g.agr_number("l_suppkey").alias("agr_number"),
        tag("R", "l_orderkey").alias("rrn"), tag("P", "l_partkey").alias("acq_ref_number"), tag("L", "l_linenumber").alias("trace_ref_number"))
    documents = g.orders.select(*pair("o_custkey", "o_orderstatus"), tag("R", "o_orderkey").alias("rrn"), money(F.col("o_totalprice")).alias("amount"))
    return txns, documents


_PAIRS = "w.debit_account_number, w.credit_account_number"
_MATCH = "t.debit_account_number = w.debit_account_number AND t.credit_account_number = w.credit_account_number AND t.rrn = w.rrn"
_SUMS = ["amount", "sum_settl_amount", "sum_c_sum"]


@query("c_txn_vs_document", f"""
WITH {_TXNS}
SELECT {S.E} AS report_date, 'card_transactions' AS report_name, w.error_name, t.day AS banking_date, {_PAIRS}, t.orig_system,
       t.ttype, t.direction, t.t_direction, t.amount::DOUBLE AS amount, ga::DOUBLE AS sum_settl_amount, gb::DOUBLE AS sum_c_sum,
       ra::DOUBLE AS sum_amount_rrn, named::DOUBLE AS sum_nazn_rrn, rb::DOUBLE AS sum_sum_rrn, t.agr_number, w.rrn,
       t.acq_ref_number, t.trace_ref_number
FROM wrong w LEFT JOIN txns t ON {_MATCH}""")
def c_txn_vs_document(g):
    out = card_transactions(*_lines_and_orders(g, "banking_date"), EVENT_DAY)
    return doubles(out, *_SUMS, "sum_amount_rrn", "sum_nazn_rrn", "sum_sum_rrn")


@query("c_credit_vs_document", f"""
WITH {_TXNS}
SELECT {S.E} AS report_date, 'credit_transactions' AS report_name, w.error_name, t.day AS txn_date, {_PAIRS}, t.ttype, t.direction,
       t.t_direction, t.amount::DOUBLE AS amount, ga::DOUBLE AS sum_settl_amount, gb::DOUBLE AS sum_c_sum,
       ra::DOUBLE AS sum_settl_amount_rrn, named::DOUBLE AS sum_sum_nazn_rrn, rb::DOUBLE AS sum_sum_rrn, t.agr_number, w.rrn,
       t.acq_ref_number, t.trace_ref_number
FROM wrong w LEFT JOIN txns t ON {_MATCH}""")
def c_credit_vs_document(g):
    out = credit_transactions(*_lines_and_orders(g, "txn_date"), EVENT_DAY)
    return doubles(out, *_SUMS, "sum_settl_amount_rrn", "sum_sum_nazn_rrn", "sum_sum_rrn")


@query("c_fake_clear", """
SELECT 'no_authorisation' AS error_name, o_orderdate::DATE AS banking_date, 'T' || o_orderkey AS trace_ref_number,
       'R' || o_orderkey AS ret_ref_number, o_orderpriority AS ttype, o_totalprice AS amount
FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)""")
def c_fake_clear(g):
    def references(key):
        text = F.col(key).cast("string")
        return [F.concat(F.lit("T"), text).alias("trace_ref_number"), F.concat(F.lit("R"), text).alias("ret_ref_number")]
    clears = g.orders.select(
        F.to_date("o_orderdate").alias("banking_date"), *references("o_orderkey"), F.col("o_orderpriority").alias("ttype"),
        F.col("o_totalprice").alias("amount"))
    return fake_clears(clears, g.lineitem.select(*references("l_orderkey")))


@query("c_duplicates", """
WITH t AS (
  SELECT o_orderkey AS id, o_orderdate::DATE AS banking_date, o_orderstatus AS ttype,
         'R' || o_custkey AS ret_ref_number, 'T' || o_orderpriority AS trace_ref_number, 'A' || o_orderstatus AS acq_ref_number,
         floor(o_totalprice / 100000)::DOUBLE AS amount, 'Заказ ' || o_orderkey AS purpose FROM orders)
SELECT 'transaction_duplicates' AS report_name, * EXCLUDE (id), min(id) OVER same || '' AS root_txn_id FROM t
WINDOW same AS (PARTITION BY ret_ref_number, trace_ref_number, acq_ref_number, amount) QUALIFY count(*) OVER same > 1""")
def c_duplicates(g):
    def tag(letter, column):
        return F.concat(F.lit(letter), F.col(column).cast("string"))
    txns = g.orders.select(
        F.col("o_orderkey").alias("txn_id"), F.to_date("o_orderdate").alias("banking_date"), F.col("o_orderstatus").alias("ttype"),
        tag("R", "o_custkey").alias("ret_ref_number"), tag("T", "o_orderpriority").alias("trace_ref_number"),
        tag("A", "o_orderstatus").alias("acq_ref_number"), F.floor(F.col("o_totalprice") / 100000).cast("double").alias("amount"),
        F.concat(F.lit("Заказ "), F.col("o_orderkey").cast("string")).alias("purpose"))
    return transaction_duplicates(txns)


@query("c_doc_vs_message", f"""
WITH {S.REGISTERS}, x AS (
  SELECT {S.E} AS check_date, coalesce(a.opened, b.opened) AS document_date, 'N' || coalesce(a.number, b.number) AS document_num,
         coalesce(a.amount, b.amount)::DOUBLE AS document_sum, coalesce(a.status, b.status) AS payer_account,
         coalesce('A' || a.number % 9, 'B' || b.number % 9) AS recipient_account,
         coalesce('line ' || a.number, 'event ' || b.number) AS payment_purpose, 'M' || b.number AS message_id,
         CASE WHEN b.number IS NULL THEN 'no_message' WHEN a.number IS NULL THEN 'no_document' WHEN a.amount <> b.amount THEN 'sum_differs'
              WHEN a.status <> b.status THEN 'account_differs' WHEN a.opened <> b.opened THEN 'date_differs' END AS diff_type
  FROM register_a a FULL JOIN register_b b ON a.number = b.number)
SELECT * FROM x WHERE diff_type IS NOT NULL""")
def c_doc_vs_message(g):
    def side(register, letter, word, *more):
        number = F.col("number").cast("string")
        return register.select(
            F.concat(F.lit("N"), number).alias("document_num"), F.col("opened").alias("document_date"),
            F.col("amount").alias("document_sum"), F.col("status").alias("payer_account"),
            F.concat(F.lit(letter), (F.col("number") % 9).cast("string")).alias("recipient_account"),
            F.concat(F.lit(word), number).alias("payment_purpose"), *more)
    messages = side(g.register_b, "B", "event ", F.concat(F.lit("M"), F.col("number").cast("string")).alias("message_id"))
    return doubles(document_messages(side(g.register_a, "A", "line "), messages, EVENT_DAY), "document_sum")
