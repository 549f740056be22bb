"""Delivery of reports: gates, routes, texts, ledgers, messages, tickets and logs."""

from datetime import date

from pyspark.sql import functions as F

from ..delivery import (
    act_digest, digest, fill_rows, freshness, log_run, log_view, outbox, outcome, route, run_status, satisfied,
    split_outcome, undelivered, upsert_actions,
)
from ..delivery.runlog import LOG_FIELDS
from ..delivery.routed import EMAIL_FILE, EMAIL_TEXT, TICKET_FILE, RoutedReport
from ..functions import apply_mask, json_fields, map_value, money, render, report_dates
from ..operators.compare import compare_registers, differs
from ..operators.filters import in_prev_month
from ..operators.setops import union_sources
from ..params import RunParams
from ..plans.calendar import next_workday
from ..plans.schema_only import ACCOUNT_CLASSES, account_statuses
from ..plans.turnover import turnover_for_dates
from ..session import work_dir
from . import sqltables as S
from .finals import final, turnover_sql
from .registry import query
from .tables import AS_OF, CUTOVER, EVENT_DAY, RUN_TS, doubles
from .values import etc_of

# -- a month's result per agreement, and the routes its files take ----------------------

RESULT = f"""
result AS (
  SELECT 'AGR/' || l_suppkey AS agr_number,
         sum(CASE WHEN l_returnflag = 'R' THEN 0 ELSE l_extendedprice::DECIMAL(18,2) END) AS purchases,
         sum(CASE WHEN l_returnflag = 'R' THEN l_extendedprice::DECIMAL(18,2) ELSE 0 END) AS refunds
  FROM lineitem WHERE l_shipdate >= {S.LO} AND l_shipdate < {S.HI} GROUP BY 1
),
acts AS (SELECT *, CASE WHEN purchases >= refunds THEN 1 ELSE 0 END AS condition FROM result)"""


def month_lines(g):
    """The lines of the month."""
    return g.lineitem.where(in_prev_month(F.col("l_shipdate"), AS_OF)).withColumns({
        "agr_number": g.agr_number("l_suppkey"), "price": money(F.col("l_extendedprice"))})


def acts(g):
    returned = F.col("l_returnflag") == "R"
    zero = F.lit(0)
    sums = month_lines(g).groupBy("agr_number").agg(
        F.sum(F.when(returned, zero).otherwise(F.col("price"))).alias("purchases"),
        F.sum(F.when(returned, F.col("price")).otherwise(zero)).alias("refunds"))
    return sums.withColumn("condition", F.when(F.col("purchases") >= F.col("refunds"), 1).otherwise(0))


ROUTES = """
routes AS (
  SELECT 'AGR/' || s_suppkey AS agr_number, s_name AS merchant, n_name AS recipient,
         CASE WHEN n_regionkey < 2 THEN 'Acquiring' ELSE 'Transfers' END AS template,
         CASE WHEN n_regionkey < 3 THEN 'success' WHEN n_regionkey = 3 THEN 'failure' ELSE 'none' END AS indicator
  FROM supplier JOIN nation ON s_nationkey = n_nationkey
)"""


def routes(g):
    region = F.col("n_regionkey")
    return g.supplier.join(g.nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
        g.agr_number("s_suppkey").alias("agr_number"), F.col("s_name").alias("merchant"),
        F.col("n_name").alias("recipient"),
        F.when(region < 2, "Acquiring").otherwise("Transfers").alias("template"),
        F.when(region < 3, "success").when(region == 3, "failure").otherwise("none").alias("indicator"))


_ORDER = "agr_number"


def routed(g):
    return route(acts(g), routes(g), "agr_number", F.col("condition"), [F.col(_ORDER)])


@query("rep_bind_dates", f"""
SELECT o_custkey, count(*) AS n, {S.D} AS as_of FROM orders
WHERE o_orderdate >= {S.LO} AND o_orderdate < {S.HI} GROUP BY o_custkey""")
def rep_bind_dates(g):
    g.orders.createOrReplaceTempView("bound_orders")
    return g.spark.sql("""
        SELECT o_custkey, count(*) AS n, :as_of AS as_of FROM bound_orders
        WHERE o_orderdate >= :month_lo AND o_orderdate < :month_hi GROUP BY o_custkey""",
        args={k: v for k, v in RunParams(AS_OF, RUN_TS).sql_args().items() if k != "run_ts"})


@query("rep_gate", f"""
WITH {RESULT}, {ROUTES}
SELECT agr_number, coalesce(condition, 0) <> 0 AS attach FROM routes LEFT JOIN acts USING (agr_number)""")
def rep_gate(g):
    return routes(g).join(acts(g), "agr_number", "left").select(
        "agr_number", satisfied(F.col("condition")).alias("attach"))


@query("rep_fill_row", f"""
WITH {ROUTES}, lines AS (
  SELECT 'AGR/' || l_suppkey AS agr_number, l_orderkey, l_linenumber, l_extendedprice, row_number() OVER
    (PARTITION BY l_suppkey ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey) AS rn
  FROM lineitem WHERE l_shipdate >= {S.LO} AND l_shipdate < {S.HI})
SELECT agr_number, merchant, l_orderkey, l_linenumber, l_extendedprice, rn IS NOT NULL AS found
FROM routes LEFT JOIN (SELECT * FROM lines WHERE rn = 1) USING (agr_number)""")
def rep_fill_row(g):
    order = [F.col(c) for c in ("l_shipdate", "l_orderkey", "l_linenumber", "l_partkey")]
    return fill_rows(month_lines(g), routes(g), "agr_number", order).select(
        "agr_number", "merchant", "l_orderkey", "l_linenumber", "l_extendedprice", "found")


@query("rep_render_text", f"""
WITH {RESULT}, {ROUTES}
SELECT agr_number, 'Акт ' || agr_number || ' (' || merchant || '): оплаты ' || format('{{:.2f}}', purchases::DOUBLE)
  || ', возвраты ' || format('{{:.2f}}', refunds::DOUBLE) || ' за 1998-07-15' AS body
FROM acts JOIN routes USING (agr_number)""")
def rep_render_text(g):
    fields = {
        "agr_number": F.col("agr_number"), "merchant": F.col("merchant"),
        "purchases": apply_mask(F.col("purchases"), "N", "%.2f"), "refunds": apply_mask(F.col("refunds"), "N", "%.2f"),
        **report_dates(F.lit(AS_OF), F.lit(RUN_TS)),
    }
    text = "Акт {agr_number} ({merchant}): оплаты {purchases}, возвраты {refunds} за {DT}"
    return acts(g).join(routes(g), "agr_number").select("agr_number", render(text, fields).alias("body"))


FILE = "{PREV_CYR_MONTH_SLASH}/сверка-{agr_number}.csv"
_FILE_SQL = "'1998/06/сверка-' || replace(agr_number, '/', '_') || '.csv'"


def file_name():
    dates = report_dates(F.lit(AS_OF), F.lit(RUN_TS))
    # the folder keeps its slash, inserted values lose theirs
    folder = {"PREV_CYR_MONTH_SLASH": dates["PREV_CYR_MONTH_SLASH"]}
    head, _, tail = FILE.rpartition("/")
    name = render(tail, {"agr_number": F.col("agr_number"), **dates}, slash="_")
    return F.concat(render(head, folder), F.lit("/"), name)


@query("rep_render_filename", f"""
WITH {ROUTES} SELECT agr_number, {_FILE_SQL} AS file_name FROM routes""")
def rep_render_filename(g):
    return routes(g).select("agr_number", file_name().alias("file_name"))


@query("rep_route", f"""
WITH {RESULT}, {ROUTES}
SELECT agr_number, merchant, recipient, template, indicator, purchases::DOUBLE AS purchases, refunds::DOUBLE AS refunds,
       condition, condition IS NOT NULL AS found, coalesce(condition, 0) <> 0 AS attach
FROM routes LEFT JOIN acts USING (agr_number)""")
def rep_route(g):
    return doubles(routed(g), "purchases", "refunds")


@query("rep_split_outcome", f"""
WITH {RESULT}, {ROUTES}
SELECT agr_number, CASE WHEN condition = 1 THEN 'SUCCESS' ELSE 'FAILED' END AS outcome,
       CASE WHEN condition = 1 THEN 'SUCCESS' ELSE 'FAILED' END || '/' || replace(agr_number, '/', '_') AS path FROM acts""")
def rep_split_outcome(g):
    split = split_outcome(acts(g), F.col("condition")).select("agr_number", "outcome")
    return split.withColumn("path", F.concat_ws("/", "outcome", F.replace("agr_number", F.lit("/"), F.lit("_"))))


@query("rep_delivery_ledger", f"""
WITH {RESULT}, {ROUTES}
SELECT agr_number, recipient FROM routes JOIN acts USING (agr_number)
WHERE condition = 1 AND agr_number NOT IN (
  SELECT 'AGR/' || s_suppkey FROM supplier WHERE s_acctbal > 4000)""")
def rep_delivery_ledger(g):
    items = routed(g).where("attach").select("agr_number", "recipient")
    delivered = g.supplier.where(F.col("s_acctbal") > 4000).select(g.agr_number("s_suppkey").alias("agr_number"))
    return undelivered(items, delivered, ["agr_number"])


@query("rep_outcome", f"""
WITH {RESULT}, {ROUTES}, counted AS (
  SELECT recipient, indicator, count(*) FILTER (WHERE coalesce(condition, 0) <> 0) AS n_attached
  FROM routes LEFT JOIN acts USING (agr_number) GROUP BY 1, 2)
SELECT *, CASE WHEN indicator = 'failure' AND n_attached > 0 THEN 'FAILED' WHEN indicator = 'failure' THEN 'SUCCESS'
               WHEN indicator = 'success' AND n_attached > 0 THEN 'SUCCESS' WHEN indicator = 'success' THEN 'FAILED' END
          AS result FROM counted""")
def rep_outcome(g):
    counted = routed(g).groupBy("recipient", "indicator").agg(F.count_if("attach").alias("n_attached"))
    return counted.withColumn("result", outcome(F.col("n_attached"), F.col("indicator")))


@query("rep_outbox", f"""
WITH {ROUTES}
SELECT recipient, 'message' AS part, NULL AS file, 'Файлы по договорам' AS content, count(*) AS n_files FROM routes GROUP BY 1
UNION ALL SELECT recipient, 'file', {_FILE_SQL}, 'Договор ' || agr_number, NULL FROM routes""")
def rep_outbox(g):
    items = routes(g).select("recipient", file_name().alias("file"),
                             F.concat(F.lit("Договор "), F.col("agr_number")).alias("text"))
    return outbox(items, "recipient", "file", "text", F.lit("Файлы по договорам"))


@query("rep_routed_run", f"""
WITH {RESULT}, {ROUTES}, taken AS (SELECT * FROM routes JOIN acts USING (agr_number) WHERE condition = 1),
mails AS (SELECT * FROM taken WHERE indicator <> 'none')
SELECT 'outbox' AS kind, recipient, 'message' AS part, NULL AS file, 'Акты за июнь 1998' AS content,
       count(*) FILTER (indicator = 'success') AS n FROM mails GROUP BY recipient
UNION ALL SELECT 'outbox', recipient, 'file', CASE WHEN indicator = 'success' THEN 'сверка-' || replace(agr_number, '/', '_') || '.csv' END,
       CASE WHEN indicator = 'failure' THEN 'Договор ' || agr_number END, NULL FROM mails
UNION ALL SELECT 'ticket', recipient, 'create', NULL, template, count(*) FROM taken WHERE indicator = 'none' GROUP BY recipient, template
UNION ALL SELECT 'ledger', recipient, NULL, agr_number, indicator, 1 FROM taken
UNION ALL SELECT 'lines', NULL, NULL, 'сверка-' || replace(agr_number, '/', '_') || '.csv', NULL, 1 FROM taken WHERE indicator <> 'failure'""")
def rep_routed_run(g):
    """What two runs for one date leave: the second delivers nothing again."""
    kinds = {"success": EMAIL_FILE, "failure": EMAIL_TEXT, "none": TICKET_FILE}
    folder = work_dir(g.spark, "routed")
    report = RoutedReport(
        "acts", lambda tables, params: acts(g), folder=folder, key="agr_number", order=[_ORDER], indicator="success",
        routes=lambda spark: routes(g).withColumns({
            "attach_kind": map_value(F.col("indicator"), kinds), "queue": F.col("template")}),
        file_name="сверка-{agr_number}.csv", text="Договор {agr_number}", body="Акты за июнь 1998")
    for hour in (9, 10):
        report.run(g.spark, RunParams(AS_OF, RUN_TS.replace(hour=hour)))
    read = g.spark.read.parquet
    none = F.lit(None).cast("string")
    mails = read(f"{folder}/outbox").select(F.lit("outbox").alias("kind"), "recipient", "part", "file", "content", F.col("n_files").alias("n"))
    tickets = read(f"{folder}/tickets").select(
        F.lit("ticket").alias("kind"), F.col("summary").alias("recipient"), F.col("action").alias("part"), none.alias("file"),
        F.col("queue").alias("content"), F.col("n_files").alias("n"))
    one = F.lit(1).cast("bigint").alias("n")
    names = {v: k for k, v in kinds.items()}
    ledger = read(f"{folder}/ledger").select(
        F.lit("ledger").alias("kind"), "recipient", none.alias("part"), F.col("agr_number").alias("file"),
        map_value(F.col("attach_kind"), names).alias("content"), one)
    files = g.spark.read.option("recursiveFileLookup", True).option("header", True).schema("a string").csv(f"{folder}/files")
    lines = files.select(
        F.lit("lines").alias("kind"), none.alias("recipient"), none.alias("part"),
        F.regexp_extract(F.url_decode(F.input_file_name()), "file=([^/]*)", 1).alias("file"), none.alias("content"), one)
    return union_sources(mails, tickets, ledger, lines)


@query("rep_ticket_upsert", f"""
WITH {RESULT}, {ROUTES}, t AS (
  SELECT template AS queue, 'Акты ' || recipient AS summary, count(*) AS n_acts
  FROM routes JOIN acts USING (agr_number) GROUP BY 1, 2),
known AS (SELECT 'Transfers' AS queue, 'Акты ' || n_name AS summary, 'T-' || min(n_nationkey) AS ticket_key
          FROM nation WHERE n_regionkey IN (0, 2, 4) GROUP BY 1, 2)
SELECT t.queue, t.summary, n_acts, ticket_key, CASE WHEN ticket_key IS NULL THEN 'create' ELSE 'comment' END AS action,
       CASE WHEN ticket_key IS NULL THEN {S.D} + 5 END AS deadline
FROM t LEFT JOIN known ON t.queue = known.queue AND t.summary = known.summary""")
def rep_ticket_upsert(g):
    tickets = routed(g).where("found").groupBy(
        F.col("template").alias("queue"), F.concat(F.lit("Акты "), F.col("recipient")).alias("summary")
    ).agg(F.count(F.lit(1)).alias("n_acts"))
    known = g.nation.where(F.col("n_regionkey").isin(0, 2, 4)).select(
        F.lit("Transfers").alias("queue"), F.concat(F.lit("Акты "), F.col("n_name")).alias("summary"),
        F.concat(F.lit("T-"), F.col("n_nationkey").cast("string")).alias("ticket_key"))
    return upsert_actions(tickets, known, AS_OF)


# -- the log: events as runs of a user, with JSON details --------------------------------

LOGS = """
logs AS (
  SELECT event_id, user_id, ts, regexp_extract(props, '"k": *([0-9]+)', 1)::BIGINT AS k, event_type AS kind,
         CASE event_type WHEN 'error' THEN 'ERROR' WHEN 'signup' THEN 'START' ELSE 'END' END AS event_type
  FROM events),
detailed AS (
  SELECT *, CASE WHEN kind = 'error' THEN 'ERROR' ELSE 'SUCCESS' END AS result,
         CASE WHEN k < 10 THEN 'TICKET-' || k ELSE '' END AS ticket_key,
         CASE WHEN kind = 'error' THEN 'failed at ' || k ELSE '' END AS error_msg,
         CASE WHEN k >= 90 THEN [] WHEN k >= 50 THEN ['out/' || k || '.csv']
              ELSE ['out/' || k || '.csv', 'out/' || kind || '.xlsx'] END AS paths
  FROM logs)"""


def logs(g):
    kind = F.col("event_type")
    event = F.when(kind == "error", "ERROR").when(kind == "signup", "START").otherwise("END")
    return etc_of(g).select(
        "event_id", F.concat(F.lit("run-"), F.col("user_id").cast("string")).alias("run_id"),
        F.lit("REPORTS").alias("service_name"), kind.alias("job_name"), event.alias("event_type"),
        F.col("ts").alias("event_ts"), "etc")


@query("rep_run_log", f"""
WITH {LOGS}
SELECT event_type, kind AS job_name, result, count(*) AS n, count(CASE WHEN ticket_key <> '' THEN 1 END) AS n_tickets,
       count(CASE WHEN error_msg <> '' THEN 1 END) AS n_errors FROM detailed GROUP BY 1, 2, 3""")
def rep_run_log(g):
    path = work_dir(g.spark, "log")
    rows = logs(g)
    before = F.col("event_ts") < F.lit(EVENT_DAY)
    log_run(path, rows.where(before))
    log_run(path, rows.where(~before))
    stored = g.spark.read.schema(rows.schema).parquet(path)
    details = json_fields(stored, "etc", LOG_FIELDS)
    return details.groupBy("event_type", "job_name", "result").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("ticket_key") != "").alias("n_tickets"),
        F.count_if(F.col("error_msg") != "").alias("n_errors"))


@query("rep_run_status", f"""
WITH {LOGS}, last AS (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC,
           CASE event_type WHEN 'ERROR' THEN 1 WHEN 'END' THEN 2 ELSE 3 END) AS rn,
         count(*) OVER (PARTITION BY user_id) AS n_events FROM logs)
SELECT 'run-' || user_id AS run_id, event_type AS status, ts AS status_ts, n_events FROM last WHERE rn = 1""")
def rep_run_status(g):
    return run_status(logs(g))


@query("rep_log_view", f"""
WITH {LOGS}
SELECT event_id, result, ticket_key, error_msg, unnest(CASE WHEN len(paths) = 0 THEN [''] ELSE paths END) AS filepath
FROM detailed""")
def rep_log_view(g):
    return log_view(logs(g), "REPORTS").select("event_id", "result", "ticket_key", "error_msg", "filepath")


# -- digests ------------------------------------------------------------------------------

STATUSES = S.REGISTERS + """,
compared AS (
  SELECT a.number::VARCHAR AS a_account, b.number::VARCHAR AS b_account, a.opened AS a_date_open, b.opened AS b_date_open,
         a.closed AS a_date_close, b.closed AS b_date_close, a.status AS a_status, b.status AS b_status,
         CASE WHEN a.number IS NULL THEN 'missing_in_a' WHEN b.number IS NULL THEN 'missing_in_b'
              WHEN a.opened <> b.opened THEN 'open_date_differs' WHEN a.closed <> b.closed THEN 'close_date_differs'
              WHEN a.status <> b.status THEN 'status_differs' END AS error_name
  FROM register_a a FULL JOIN register_b b ON a.number = b.number)"""


def statuses(g):
    def side(register):
        return register.select(F.col("number").cast("string").alias("account"), F.col("opened").alias("date_open"),
                               F.col("closed").alias("date_close"), "status")
    return account_statuses(side(g.register_a), side(g.register_b))


@query("rep_digest", f"""
WITH {STATUSES}
SELECT {", ".join(f"count(CASE WHEN error_name = '{c}' THEN 1 END) AS {n}" for c, n in ACCOUNT_CLASSES.items())}
FROM compared""")
def rep_digest(g):
    return digest(statuses(g), "error_name", ACCOUNT_CLASSES)


@query("rep_act_digest", f"""
WITH {S.ACT_FINAL}
SELECT count(*) AS cnt, count(CASE WHEN check_amount = 0 THEN 1 END) AS success_cnt,
       count(CASE WHEN check_amount <> 0 THEN 1 END) AS failure_cnt FROM act_final""")
def rep_act_digest(g):
    return act_digest(final(g))


# -- dates and sources ----------------------------------------------------------------------

_BACK = [date(2024, 1, d) for d in (10, 13, 15)]
_MOVES_SQL = ", ".join(f"{c}::DOUBLE AS {c}" for c in ("in_amount", "out_amount", "debit_amount", "credit_amount"))


@query("rep_backfill", " UNION ALL ".join(
    f"SELECT * FROM (WITH {turnover_sql(f"DATE '{d}'")} SELECT balance_date, account_id, second_order_account_number, "
    f"account_number, {_MOVES_SQL} FROM turnover)" for d in _BACK))
def rep_backfill(g):
    """The turnover report for three days in one pass."""
    return doubles(turnover_for_dates(g.turnover_tables, _BACK, CUTOVER), "in_amount", "out_amount", "debit_amount", "credit_amount")


@query("rep_next_workday", f"""
WITH {S.CALENDAR}
SELECT min(calendar_date) AS workday, day(min(calendar_date))::BIGINT AS workday_of_month FROM calendar
WHERE calendar_date >= {S.E} - 2 AND NOT holiday_flag""")
def rep_next_workday(g):
    return next_workday(g.calendar, date(2024, 1, 13))


@query("rep_freshness", f"""
SELECT source, last_day, last_day >= {S.E} AS is_fresh FROM (
  SELECT 'orders' AS source, max(o_orderdate)::DATE AS last_day FROM orders
  UNION ALL SELECT 'lines', max(l_shipdate)::DATE FROM lineitem
  UNION ALL SELECT 'events', max(ts)::DATE FROM events)""")
def rep_freshness(g):
    return freshness({
        "orders": (g.orders, "o_orderdate"), "lines": (g.lineitem, "l_shipdate"), "events": (g.events, "ts"),
    }, EVENT_DAY)


@query("rep_register_compare", f"""
WITH {S.REGISTERS}, x AS (
  SELECT coalesce(a.number, b.number) AS number, a.opened AS a_opened, b.opened AS b_opened, a.amount::DOUBLE AS a_amount,
         b.amount::DOUBLE AS b_amount,
         CASE WHEN b.number IS NULL THEN 'missing_in_b' WHEN a.number IS NULL THEN 'missing_in_a'
              WHEN a.opened <> b.opened THEN 'open_date_differs'
              WHEN a.amount <> b.amount THEN 'amount_differs' END AS error_name
  FROM register_a a FULL JOIN register_b b ON a.number = b.number)
SELECT * FROM x WHERE error_name IS NOT NULL""")
def rep_register_compare(g):
    both = F.col("in_a") & F.col("in_b")
    rules = [
        ("missing_in_b", ~F.col("in_b")), ("missing_in_a", ~F.col("in_a")),
        ("open_date_differs", both & differs("a_opened", "b_opened")),
        ("amount_differs", both & differs("a_amount", "b_amount")),
    ]
    found = compare_registers(*(r.select("number", "opened", "amount") for r in (g.register_a, g.register_b)), ["number"], rules)
    return doubles(found.drop("in_a", "in_b"), "a_amount", "b_amount")
