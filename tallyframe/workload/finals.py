"""The complete report queries."""

from datetime import date

from pyspark.sql import functions as F

from ..plans import (
    act_data, act_details, act_final, agreements_check, payments_check, red_balance, red_summary, turnover,
    violations,
)
from ..plans import fixed_values as fv
from . import sqltables as S
from .registry import query
from .rows import ISLANDS
from .tables import AS_OF, CUTOVER, EVENT_DAY, dbl, doubles

FAMILIES = ["base", "settl", "cards"]
AMOUNTS = [*fv.ACT_COLUMNS.values(), "check_amount"]


def facts(g, family):
    return act_data(g.act_tables(family), AS_OF, family)


def final(g):
    lines = facts(g, "base").unionByName(facts(g, "settl")).unionByName(facts(g, "cards"))
    return act_final(lines, [g.agreements(f) for f in FAMILIES], g.merchants, AS_OF)


def _register_family(family, key):
    @query(key, f"WITH {S.act_facts(family)} SELECT ttype, agr_number, amount::DOUBLE AS txn_amount FROM act_{family}")
    def act_data_of(g):
        return doubles(facts(g, family), "txn_amount")


_register_family("base", "q_act_data")
_register_family("settl", "q_act_data_settl")
_register_family("cards", "q_act_data_cards")

_AMOUNTS_SQL = ", ".join(f"{c}::DOUBLE AS {c}" for c in AMOUNTS)


@query("q_act_final", f"""
WITH {S.ACT_FINAL}
SELECT agr_number, agr_date, director, merchant, director_short, has_data, {_AMOUNTS_SQL},
       CASE WHEN check_amount = 0 THEN 1 ELSE 0 END AS condition FROM act_final""")
def q_act_final(g):
    return doubles(final(g), *AMOUNTS)


_DETAILS_SQL = ", ".join(
    f'{c}{"::DOUBLE" if c in AMOUNTS else ""} AS "{label}"' for c, label in fv.ACT_LABELS.items()
).replace("condition AS", "CASE WHEN check_amount = 0 THEN 1 ELSE 0 END AS")


@query("q_act_details", f"WITH {S.ACT_FINAL} SELECT {_DETAILS_SQL} FROM act_final")
def q_act_details(g):
    return act_details(doubles(final(g), *AMOUNTS))


@query("union_all_branches", f"""
WITH {S.act_facts("base")} SELECT ttype, count(*) AS n, sum(amount)::DOUBLE AS amount FROM act_base GROUP BY 1""")
def union_all_branches(g):
    return facts(g, "base").groupBy("ttype").agg(
        F.count(F.lit(1)).alias("n"), dbl(F.sum("txn_amount")).alias("amount"))


# turnover in SQL: the last day with movement up to the report day, else the former balance
_TURNOVER = S.JOURNAL_CHANGES + """,
journal_since AS (
  SELECT * FROM journal_changes WHERE dt BETWEEN {k} AND {e}
  QUALIFY row_number() OVER (PARTITION BY doc_id, collection_id ORDER BY txn_ts DESC, txn_id DESC) = 1
),
days AS (
  SELECT a.account_id, a.account_number, j.posted_at::DATE AS day, first(j.in_rub ORDER BY j.posted_at, j.id) AS opening,
         coalesce(-sum(j.amount_rub) FILTER (WHERE j.is_debit), 0) AS debit,
         coalesce(sum(j.amount_rub) FILTER (WHERE NOT j.is_debit), 0) AS credit
  FROM journal_since j JOIN ledger_account a USING (collection_id)
  WHERE j.posted_at::DATE BETWEEN {k} AND {e} GROUP BY 1, 2, 3
),
last_days AS (SELECT * FROM days QUALIFY row_number() OVER (PARTITION BY account_id ORDER BY day DESC) = 1),
turnover AS (
  SELECT {e} AS balance_date, account_id, account_number[1:5] AS second_order_account_number, account_number,
         opening + CASE WHEN day < {e} THEN debit + credit ELSE 0 END AS in_amount, opening + debit + credit AS out_amount,
         CASE WHEN day < {e} THEN 0 ELSE debit END AS debit_amount, CASE WHEN day < {e} THEN 0 ELSE credit END AS credit_amount
  FROM last_days
  UNION ALL
  SELECT {e}, account_id, account_number[1:5], account_number, c_acctbal::DECIMAL(18,2), c_acctbal::DECIMAL(18,2), 0, 0
  FROM customer JOIN ledger_account ON account_id = c_custkey
  WHERE account_id NOT IN (SELECT account_id FROM last_days)
)"""


def turnover_sql(day: str) -> str:
    return _TURNOVER.replace("{e}", day).replace("{k}", S.K)


TURNOVER = turnover_sql(S.E)

_MOVES = ["in_amount", "out_amount", "debit_amount", "credit_amount"]
_MOVES_SQL = ", ".join(f"{c}::DOUBLE AS {c}" for c in _MOVES)


def balances(g):
    return turnover(g.turnover_tables, EVENT_DAY, CUTOVER)


@query("q_turnover", f"""
WITH {TURNOVER}
SELECT balance_date, account_id, second_order_account_number, account_number, {_MOVES_SQL} FROM turnover""")
def q_turnover(g):
    return doubles(balances(g), *_MOVES)


# the given balances stay below 10,000, so severities start lower here
SEVERITY_FROM = {fv.CRITICAL: 9000, fv.HIGH: 5000, fv.MEDIUM: 1000}

# the rules as small tables: which direction is wrong for a class, and what a size means
VIOLATIONS = TURNOVER + "," + S.ACCOUNT_TYPES + """,
wrong(code, direction, violation_type, violation_description, section_name) AS (VALUES
  ('А', -1, 'RED_BALANCE_ACTIVE', 'Недопустимое кредитовое сальдо на активном счете', 'АКТИВНЫЕ СЧЕТА'),
  ('П', 1, 'RED_BALANCE_PASSIVE', 'Недопустимое дебетовое сальдо на пассивном счете', 'ПАССИВНЫЕ СЧЕТА'),
  ('АП', -1, 'NON_ZERO_ACTIVE_PASSIVE', 'Остаток должен быть нулевым', 'АКТИВНО-ПАССИВНЫЕ СЧЕТА'),
  ('АП', 1, 'NON_ZERO_ACTIVE_PASSIVE', 'Остаток должен быть нулевым', 'АКТИВНО-ПАССИВНЫЕ СЧЕТА')),
sizes(mixed, lo, hi, severity_level) AS (VALUES
  (FALSE, 9000, 1000000000, 'КРИТИЧЕСКОЕ'), (FALSE, 5000, 9000, 'ВЫСОКОЕ'), (FALSE, 1000, 5000, 'СРЕДНЕЕ'),
  (FALSE, 0, 1000, 'НИЗКОЕ'), (TRUE, 0, 1000000000, 'СРЕДНЕЕ')),
violations AS (
  SELECT t.*, w.*, abs(t.out_amount) AS abs_amount, z.severity_level
  FROM turnover t JOIN ledger_account a USING (account_id) JOIN account_type y ON y.type_id = a.type_id
  JOIN wrong w ON w.code = y.type_code AND w.direction = sign(t.out_amount)
  JOIN sizes z ON z.mixed = (w.code = 'АП') AND abs(t.out_amount) >= z.lo AND abs(t.out_amount) < z.hi
)"""


@query("q_red_balance", f"""
WITH {VIOLATIONS}
SELECT section_name, balance_date, second_order_account_number, account_number, code AS acc_type_code,
       violation_description, severity_level, out_amount::DOUBLE AS out_amount, abs_amount::DOUBLE AS abs_amount,
       debit_amount::DOUBLE AS debit_amount, credit_amount::DOUBLE AS credit_amount, violation_type FROM violations""")
def q_red_balance(g):
    out = red_balance(balances(g), g.ledger_accounts, g.account_types, g.account_users, SEVERITY_FROM)
    return out.select(*[dbl(c).alias(c) if c.endswith("_amount") else c for c in out.columns])


@query("q_red_summary", f"""
WITH {VIOLATIONS}
SELECT code AS acc_type_code,
       CASE code WHEN 'А' THEN 'Активные' WHEN 'П' THEN 'Пассивные' WHEN 'АП' THEN 'Активно-пассивные' END AS account_type_name,
       count(*) AS total_violations, sum(abs_amount)::DOUBLE AS total_violation_amount,
       round(avg(abs_amount), 6)::DOUBLE AS avg_violation_amount, max(abs_amount)::DOUBLE AS max_violation_amount,
       count(*) FILTER (severity_level = 'КРИТИЧЕСКОЕ') AS critical_count,
       count(*) FILTER (severity_level = 'ВЫСОКОЕ') AS high_count,
       count(*) FILTER (severity_level = 'СРЕДНЕЕ') AS medium_count
FROM violations GROUP BY code""")
def q_red_summary(g):
    found = violations(balances(g), g.ledger_accounts, g.account_types, g.account_users, SEVERITY_FROM)
    return doubles(red_summary(found), "total_violation_amount", "max_violation_amount").withColumn(
        "avg_violation_amount", dbl(F.round("avg_violation_amount", 6)))


PAYMENTS = S.JOURNAL_CHANGES + "," + ISLANDS + """,
owed AS (
  SELECT collection_id AS account_id, first(in_rub ORDER BY posted_at, id)
         + sum(CASE WHEN is_debit THEN -amount_rub ELSE amount_rub END) AS amount
  FROM journal_latest, bounds WHERE posted_at::DATE BETWEEN lo AND hi GROUP BY 1
),
documents_latest AS (
  SELECT * FROM postings WHERE event_type = 'purchase' AND day > {e} - 30 AND day <= {e}
  QUALIFY row_number() OVER (PARTITION BY user_id, k ORDER BY ts DESC, event_id DESC) = 1
),
paid AS (
  SELECT user_id, sum(amount) AS amount FROM documents_latest
  WHERE day = {e} AND k <> 7 AND (k < 40 OR (k >= 50 AND k < 90)) GROUP BY 1
),
payments AS (
  SELECT 'CON/' || c_custkey AS agreement_number, c_name AS client_name,
         n_name AS agreement_type, a.account_number, coalesce(w.amount, 0) AS out_balance_amount,
         coalesce(p.amount, 0) AS payment_documents_amount
  FROM customer JOIN ledger_account a ON a.account_id = c_custkey LEFT JOIN nation ON n_nationkey = c_nationkey
  LEFT JOIN owed w ON w.account_id = c_custkey LEFT JOIN paid p ON p.user_id = c_custkey
  WHERE starts_with(a.account_number, '30232')
)""".replace("{e}", S.E)


def payments(g, ordered=True):
    return payments_check(g.payment_tables, EVENT_DAY, ordered=ordered)


@query("q_payments", f"""
WITH {PAYMENTS}
SELECT agreement_number, client_name, agreement_type, account_number, out_balance_amount::DOUBLE AS out_balance_amount,
       payment_documents_amount::DOUBLE AS payment_documents_amount,
       (payment_documents_amount - out_balance_amount)::DOUBLE AS diff_amount FROM payments""")
def q_payments(g):
    out = payments(g)
    return out.select(*[dbl(c).alias(c) if c.endswith("_amount") else c for c in out.columns])


_AGREEMENTS_DAY = EVENT_DAY


@query("q_agreements", f"""
WITH {S.REGISTERS}, yp AS (SELECT 'ag' || number AS num, opened, closed FROM register_a),
ip AS (SELECT * FROM (SELECT (CASE WHEN p_size % 2 = 0 THEN 'zz' ELSE 'ag' END) || p_partkey AS num,
                   DATE '2024-01-01' + p_size % 30 AS opened, DATE '2024-01-01' + p_size % 30 + 90 AS closed
            FROM part) WHERE num LIKE 'ag%'),
a AS (SELECT coalesce(yp.num, ip.num) AS num, coalesce(yp.opened, ip.opened) AS opened, coalesce(yp.closed, ip.closed) AS closed
      FROM yp FULL JOIN ip ON yp.num = ip.num),
b AS (SELECT 'ag' || number AS num, opened, closed FROM register_b),
x AS (SELECT coalesce(a.num, b.num) AS agr_number, a.num IS NOT NULL AS in_a, b.num IS NOT NULL AS in_b,
             a.opened AS a_open_date, b.opened AS b_open_date, a.closed AS a_close_date, b.closed AS b_close_date
      FROM a FULL JOIN b ON a.num = b.num
      WHERE DATE '{_AGREEMENTS_DAY}' IN (coalesce(a.opened, DATE '1900-01-01'), coalesce(b.opened, DATE '1900-01-01')))
SELECT 'missing_in_b' AS error_name, x.* EXCLUDE (in_a, in_b) FROM x WHERE NOT in_b
UNION ALL SELECT 'missing_in_a', x.* EXCLUDE (in_a, in_b) FROM x WHERE NOT in_a
UNION ALL SELECT 'open_date_differs', x.* EXCLUDE (in_a, in_b) FROM x WHERE in_a AND in_b AND a_open_date <> b_open_date
UNION ALL SELECT 'close_date_differs', x.* EXCLUDE (in_a, in_b) FROM x
WHERE in_a AND in_b AND a_open_date = b_open_date AND a_close_date <> b_close_date""")
def q_agreements(g):
    def named(register, opened, closed):
        return register.select(
            F.concat(F.lit("ag"), F.col("number").cast("string")).alias("agr_number"), F.col("opened").alias(opened),
            F.col("closed").alias(closed))
    size = F.col("p_size") % 30
    internal = g.part.select(
        F.concat(F.when(F.col("p_size") % 2 == 0, "zz").otherwise("ag"), F.col("p_partkey").cast("string")).alias("agr_number"),
        F.date_add(F.lit(date(2024, 1, 1)), size).alias("open_date"), F.date_add(F.lit(date(2024, 1, 1)), size + 90).alias("close_date"))
    return agreements_check(
        named(g.register_a, "open_date", "close_date"), internal, named(g.register_b, "signature_date", "closing_date"), _AGREEMENTS_DAY)
