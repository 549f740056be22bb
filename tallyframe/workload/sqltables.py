"""The derived tables as SQL, written apart from the DataFrames they check."""

from datetime import date

from .tables import AS_OF, CUTOVER, EVENT_DAY

D = f"DATE '{AS_OF}'"
E = f"DATE '{EVENT_DAY}'"
K = f"DATE '{CUTOVER}'"
LO, HI = "DATE '1998-06-01'", "DATE '1998-07-01'"
OPEN = f"DATE '{date(2100, 12, 31)}'"

POSTINGS = """
postings AS (
  SELECT event_id, ts, user_id, event_type, ts::DATE AS day, value::DECIMAL(18,2) AS amount,
         event_type IN ('error', 'signup') AS is_debit,
         regexp_extract(props, '"k": *([0-9]+)', 1)::BIGINT AS k
  FROM events
)"""

JOURNAL = POSTINGS + """,
journal AS (
  SELECT p.*, (coalesce((
      sum(CASE WHEN is_debit THEN -amount ELSE amount END) OVER
        (PARTITION BY user_id ORDER BY day RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
      - sum(CASE WHEN is_debit THEN -amount ELSE amount END) OVER (PARTITION BY user_id, day)
    ), 0))::DECIMAL(18,2) AS in_balance
  FROM postings p
)"""

CALENDAR = """
calendar AS (
  SELECT d::DATE AS calendar_date, isodow(d) >= 6 AS holiday_flag
  FROM (SELECT unnest(generate_series(min(ts)::DATE, max(ts)::DATE, INTERVAL 1 DAY)) AS d FROM events)
)"""

JOURNAL_CHANGES = JOURNAL + """,
journal_changes AS (
  SELECT event_id AS id, user_id AS collection_id, (day - DATE '2000-01-01') * 1000 + k AS doc_id, ts AS posted_at, is_debit,
         in_balance AS in_rub, amount AS amount_rub, ts AS txn_ts, event_id AS txn_id, day AS dt
  FROM journal
),
journal_latest AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY doc_id, collection_id ORDER BY txn_ts DESC, txn_id DESC) AS rn
    FROM journal_changes WHERE dt > {e} - 30 AND dt <= {e}
  ) WHERE rn = 1
),
ledger_account AS (
  SELECT c_custkey AS account_id, c_custkey AS collection_id, c_mktsegment AS type_id, c_nationkey AS user_id,
         (CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY', 'HOUSEHOLD') THEN '30232' ELSE '30233' END)
         || '81051' || lpad(c_custkey::VARCHAR, 10, '0') AS account_number
  FROM customer
)""".replace("{e}", E)

ACCOUNT_TYPES = """
account_type AS (
  SELECT DISTINCT c_mktsegment AS type_id,
         CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN 'А'
              WHEN c_mktsegment IN ('AUTOMOBILE', 'FURNITURE') THEN 'П' ELSE 'АП' END AS type_code
  FROM customer
)"""

REGISTERS = """
lines_of AS (
  SELECT l_orderkey AS number, DATE '2024-01-01' + ((min(l_shipdate)::DATE - DATE '1995-01-01') % 30)::INT AS opened,
         count(*) AS n, sum(l_extendedprice::DECIMAL(18,2)) AS amount FROM lineitem GROUP BY 1
),
register_a AS (
  SELECT number, opened, CASE WHEN n > 3 THEN opened + 30 END AS closed, CASE WHEN n > 2 THEN 'active' ELSE 'idle' END AS status, amount
  FROM lines_of
),
register_b AS (
  SELECT event_id AS number, ts::DATE AS opened,
         CASE WHEN event_type IN ('error', 'view') THEN ts::DATE + 29 + (trunc(value)::INT % 2) END AS closed,
         CASE WHEN event_type IN ('purchase', 'click', 'view') THEN 'active' ELSE 'idle' END AS status, value::DECIMAL(18,2) AS amount
  FROM events
)"""

MERCHANTS = """
merchants AS (
  SELECT 'AGR/' || s_suppkey AS agr_number, DATE '1997-01-01' + s_nationkey AS agr_date,
         'Director of ' || s_name AS director, s_name AS merchant, 'D. ' || s_name AS director_short
  FROM supplier
)"""

# The act lines kind by kind: each reads and joins its tables on its own.
_ACT_TABLES = """
txn AS (
  SELECT l_orderkey * 10 + l_linenumber AS id, l_quantity::BIGINT AS txn_type_id, l_suppkey AS orig_id,
         l_linenumber AS rcvr_id, l_linestatus AS txn_class, l_returnflag AS direction,
         l_extendedprice::DECIMAL(18,2) AS amount
  FROM lineitem
),
txn_type AS (
  SELECT id, CASE WHEN id <= 14 THEN 'purchase' WHEN id <= 22 THEN 'c2b' WHEN id <= 29 THEN 'refund'
                  WHEN id <= 33 THEN 'b2c' WHEN id <= 35 THEN 'purchaseReimb' WHEN id <= 37 THEN 'negativeReimb'
                  WHEN id <= 40 THEN 'C2BDISPUTE_DEBIT' WHEN id <= 43 THEN 'C2BDISPUTE_CREDIT'
                  WHEN id <= 45 THEN 'adjDebit' WHEN id <= 47 THEN 'adjCredit' ELSE 'other' END AS code
  FROM (SELECT DISTINCT l_quantity::BIGINT AS id FROM lineitem)
),
fee_txn AS (
  SELECT o_orderkey * 10 + 1 AS txn_id, CASE WHEN o_orderstatus = 'P' THEN 'R' ELSE 'D' END AS direction,
         round(o_totalprice::DECIMAL(18,2) * 0.01::DECIMAL(3,2), 2)::DECIMAL(18,2) AS fee
  FROM orders
),
invoiced AS (
  SELECT DISTINCT txn_id FROM (SELECT l_orderkey * 10 + l_linenumber AS txn_id, l_orderkey AS invoice_id FROM lineitem)
  WHERE invoice_id IN (SELECT o_orderkey FROM orders WHERE o_orderdate::DATE BETWEEN {lo} AND {hi} - 1)
),
account AS (
  SELECT '3023' || kind || '81051' || lpad(s_suppkey::VARCHAR, 10, '0') AS account_number,
         s_suppkey AS agreement_id, CASE WHEN s_acctbal < 1500 THEN 'R' ELSE 'A' END AS audit_state,
         s_suppkey * 10 + kind AS collection_id
  FROM supplier CROSS JOIN (VALUES (2), (3)) AS k(kind)
),
document AS (
  SELECT l_shipdate AS posted_at, l_extendedprice::DECIMAL(18,2) AS amount,
         (CASE WHEN l_linenumber IN (4, 5) THEN '4070281051' ELSE '3023281051' END)
           || lpad(l_suppkey::VARCHAR, 10, '0') AS debit_number,
         (CASE WHEN l_linenumber IN (4, 5) THEN '3023381051' ELSE '4070281051' END)
           || lpad(l_suppkey::VARCHAR, 10, '0') AS credit_number,
         CASE l_linenumber WHEN 1 THEN 'Переводы физических лиц согласно Реестру 1'
              WHEN 2 THEN 'Переводы физических лиц с использованием СБП согласно  Реестру 2'
              WHEN 3 THEN 'Возмещение ден.средств по операциям эквайринга по Реестру 3'
              WHEN 4 THEN 'Исполнение нетто-требований' WHEN 5 THEN 'Исполнение нетто-требований'
              ELSE 'Прочее' END AS purpose,
         CASE WHEN l_returnflag = 'N' THEN 'NEW' ELSE 'PROV' END AS state
  FROM lineitem
),
act_journal AS (
  SELECT l_suppkey * 10 + CASE WHEN l_linestatus = 'F' THEN 2 ELSE 3 END AS collection_id,
         l_shipdate AS posted_at, l_orderkey * 10 + l_linenumber AS id, l_extendedprice::DECIMAL(18,2) AS in_balance,
         (l_quantity * 100)::DECIMAL(18,2) AS amount, l_returnflag = 'A' AS is_debit
  FROM lineitem
)""".replace("{lo}", LO).replace("{hi}", HI)

_REGIONS = {"base": "0, 1, 2", "settl": "2, 3", "cards": "4"}


def agreements(family: str) -> str:
    return f"""
agreement_{family} AS (
  SELECT s_suppkey AS id, 'AGR/' || s_suppkey AS agr_number,
         CASE WHEN s_acctbal < 500 THEN 'B' ELSE 'A' END AS agreement_class,
         CASE WHEN s_acctbal < 7000 THEN NULL WHEN s_acctbal < 8500 THEN DATE '1998-06-20'
              ELSE DATE '1998-07-10' END AS closing_date
  FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE n_regionkey IN ({_REGIONS[family]})
)"""


def _balance(family: str, name: str, cutoff: str, live: str) -> str:
    return f"""
  SELECT CASE a.account_number[1:5] WHEN '30232' THEN 'debt_bank_{name}' WHEN '30233' THEN 'debt_client_{name}' END AS ttype,
         g.agr_number, abs(sum(CASE WHEN j.is_debit THEN j.in_balance - j.amount ELSE j.in_balance + j.amount END)) AS amount
  FROM (SELECT * FROM act_journal WHERE posted_at < {cutoff}
        QUALIFY row_number() OVER (PARTITION BY collection_id ORDER BY posted_at DESC, id DESC) = 1) j
  JOIN account a ON a.collection_id = j.collection_id {live}
  JOIN agreement_{family} g ON a.agreement_id = g.id
  GROUP BY a.account_number, g.agr_number"""


def act_branches(family: str) -> list[str]:
    base = family == "base"
    live = "" if base else "AND a.audit_state <> 'R'"
    debit, credit = ("C2BDISPUTE_DEBIT", "C2BDISPUTE_CREDIT") if base else ("adjDebit", "adjCredit")
    purposes = ["Переводы физических лиц согласно Реестру", "Переводы физических лиц с использованием СБП согласно  Реестру"]
    if not base:
        purposes.append("Возмещение ден.средств по операциям эквайринга по Реестру")
    wanted = " OR ".join(f"starts_with(d.purpose, '{p}')" for p in purposes)
    txns = f"""FROM txn t JOIN txn_type y ON t.txn_type_id = y.id JOIN invoiced i ON i.txn_id = t.id
  JOIN agreement_{family} g ON g.id ="""
    of_month = f"d.state = 'PROV' AND d.posted_at >= {LO} AND d.posted_at < {HI}"
    return [
        f"""
  SELECT c.ttype, g.agr_number, coalesce(sum(t.amount * CASE t.direction WHEN 'R' THEN -1 ELSE 1 END), 0) AS amount
  {txns} t.orig_id
  JOIN (VALUES ('purchase', 'debits'), ('c2b', 'debits'), ('refund', 'credits'), ('b2c', 'credits')) c(code, ttype)
    ON c.code = y.code
  WHERE t.txn_class = 'F' GROUP BY 1, 2""",
        f"""
  SELECT 'fee' AS ttype, g.agr_number, sum(f.fee * CASE f.direction WHEN 'R' THEN -1 ELSE 1 END) AS amount
  {txns} t.orig_id LEFT JOIN fee_txn f ON f.txn_id = t.id
  WHERE t.txn_class = 'F' AND y.code NOT LIKE '%Reimb' GROUP BY 2""",
        f"""
  SELECT c.ttype, g.agr_number, sum(t.amount) AS amount
  {txns} t.rcvr_id JOIN (VALUES ('{debit}', 'disp'), ('{credit}', 'disp_cr')) c(code, ttype) ON c.code = y.code
  WHERE t.txn_class = 'F' GROUP BY 1, 2""",
        f"""
  SELECT 'reimb' AS ttype, g.agr_number, sum(d.amount) AS amount
  FROM document d JOIN account a ON a.account_number = d.debit_number {live}
  JOIN agreement_{family} g ON a.agreement_id = g.id
  WHERE {of_month} AND d.debit_number LIKE '30232810_1%' AND ({wanted}) GROUP BY 2""",
        f"""
  SELECT 'fixloan' AS ttype, g.agr_number, sum(d.amount) AS amount
  FROM document d JOIN account a ON a.account_number = d.credit_number {live}
  JOIN agreement_{family} g ON a.agreement_id = g.id
  WHERE {of_month} AND starts_with(d.debit_number, '4070') AND starts_with(d.credit_number, '30233')
    AND starts_with(d.purpose, 'Исполнение нетто-требований') GROUP BY 2""",
        _balance(family, "end", HI, live),
        _balance(family, "start", LO, live),
    ]


def act_facts(*families: str) -> str:
    """CTEs of the act lines: ``act_<family>(ttype, agr_number, amount)``."""
    parts = [_ACT_TABLES]
    for family in families:
        parts.append(agreements(family))
        lines = "\n  UNION ALL".join(act_branches(family))
        parts.append(
            f"\nact_{family} AS (SELECT ttype, agr_number, amount FROM ({lines}\n) "
            "WHERE ttype IS NOT NULL AND agr_number IS NOT NULL)"
        )
    return ",".join(parts)


_ACT_LINES = {
    "debt_bank_start": "start_debt_bank_amount", "debt_client_start": "start_debt_client_amount",
    "debits": "purchases_amount", "credits": "refunds_amount", "disp": "dispute_debit_amount",
    "disp_cr": "dispute_credit_amount", "fee": "fee_amount", "reimb": "transfer_amount", "fixloan": "fix_loan_amount",
    "debt_client_end": "end_debt_client_amount", "debt_bank_end": "end_debt_bank_amount",
}
ACT_FINAL = MERCHANTS + "," + act_facts("base", "settl", "cards") + """,
agrs AS (
  SELECT agr_number FROM (
    SELECT * FROM agreement_base UNION SELECT * FROM agreement_settl UNION SELECT * FROM agreement_cards)
  WHERE agreement_class = 'A' AND coalesce(closing_date, {hi}) >= {hi} GROUP BY 1
),
lines AS (
  SELECT * FROM (SELECT * FROM act_base UNION ALL SELECT * FROM act_settl UNION ALL SELECT * FROM act_cards)
  WHERE agr_number IN (SELECT agr_number FROM agrs)
),
summed AS (
  SELECT m.agr_number, m.agr_date, m.director, m.merchant, m.director_short, count(l.ttype) > 0 AS has_data, {sums}
  FROM merchants m LEFT JOIN lines l USING (agr_number) GROUP BY ALL
),
act_final AS (
  SELECT *, (start_debt_bank_amount + purchases_amount + dispute_credit_amount + fix_loan_amount + end_debt_client_amount)
    - (end_debt_bank_amount + refunds_amount + dispute_debit_amount + fee_amount + transfer_amount
       + start_debt_client_amount) AS check_amount
  FROM summed
)""".replace("{hi}", HI).replace("{sums}", ", ".join(
    f"coalesce(sum(l.amount) FILTER (l.ttype = '{t}'), 0) AS {c}" for t, c in _ACT_LINES.items()
))
