"""The given tables, with declared schemas, and banking tables derived from them.

Each derivation exists twice: as a DataFrame here and as SQL in ``sqltables``. Amounts
are exact decimals from the start; results show them as doubles.
"""

from __future__ import annotations

from datetime import date, datetime
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import money
from ..operators.windows import day_running_sum
from ..plans import fixed_values as fv
from ..plans.calendar import calendar_of

AS_OF = date(1998, 7, 15)  # report date on orders and lineitem
EVENT_DAY = date(2024, 1, 15)  # report date on events
CUTOVER = date(2024, 1, 8)  # journal replaces the former balances
RUN_TS = datetime(2024, 1, 15, 9, 30, 0)

#: A day of January 2024 for each ship date.
REGISTER_DAY = "date_add(DATE'2024-01-01', datediff(first, DATE'1995-01-01') % 30)"
# payment purposes as the plans know them, without their wildcard
_PURPOSES = [p.rstrip("%").rstrip() for p in (*fv.TRANSFER_PURPOSES, fv.REIMBURSEMENT_PURPOSE, fv.FIXLOAN_PURPOSE)]

SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                "l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "pages": "page_id bigint, url string, html string",
    "benchmark": "item_id bigint, text string",
    "labels": "doc_id bigint, quality int, toxic int",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}


def dbl(col: Column | str) -> Column:
    return (F.col(col) if isinstance(col, str) else col).cast("double")


def doubles(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: dbl(c) for c in cols})


class Given:
    """The given tables as attributes (``g.orders``), plus the tables derived from them."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def path(self, name: str) -> str:
        return f"{self.sf_dir}/{name}.parquet"

    def __getattr__(self, name: str) -> DataFrame:
        if name not in SCHEMAS:
            raise AttributeError(name)
        table = self.spark.read.schema(SCHEMAS[name]).parquet(self.path(name))
        setattr(self, name, table)
        return table

    # -- events as a journal of account postings -----------------------------------

    @cached_property
    def journal(self) -> DataFrame:
        """Events as postings. ``in_balance`` is the account's balance before the day."""
        signed = F.expr("if(is_debit, -amount, amount)")
        daily = day_running_sum(self.postings, ["user_id"], "day", signed).selectExpr(
            "user_id", "day", "CAST(running - day_sum AS decimal(18,2)) AS in_balance"
        )
        return self.postings.join(daily, ["user_id", "day"])

    @cached_property
    def postings(self) -> DataFrame:
        return self.events.selectExpr(
            "event_id", "ts", "user_id", "event_type", "to_date(ts) AS day", "CAST(value AS decimal(18,2)) AS amount",
            "event_type IN ('error', 'signup') AS is_debit",
            "CAST(get_json_object(props, '$.k') AS bigint) AS k",
        )

    @cached_property
    def calendar(self) -> DataFrame:
        """Working days over the days of the events: one aggregate, a few rows."""
        return calendar_of(self.events, "ts")

    # -- suppliers as merchants with agreements and accounts, lines as transactions ---

    def act_tables(self, family: str) -> dict[str, DataFrame]:
        return {**self._act_tables, "agreement": self.agreements(family)}

    @cached_property
    def _act_tables(self) -> dict[str, DataFrame]:
        line_id = "l_orderkey * 10 + l_linenumber"
        number = "lpad(CAST(l_suppkey AS string), 10, '0')"
        price = "CAST(l_extendedprice AS decimal(18,2))"
        li, orders = self.lineitem, self.orders
        return {
            "txn": li.selectExpr(
                f"{line_id} AS id", "CAST(l_quantity AS bigint) AS txn_type_id", "l_suppkey AS orig_agreement_id",
                "CAST(l_linenumber AS bigint) AS rcvr_agreement_id", "l_linestatus AS txn_class",
                "l_returnflag AS txn_direction", f"{price} AS txn_amount",
            ),
            "txn_type": self._txn_types(),
            "fee_txn": orders.selectExpr(
                "o_orderkey * 10 + 1 AS txn_id", "if(o_orderstatus = 'P', 'R', 'D') AS txn_direction",
                "CAST(round(CAST(o_totalprice AS decimal(18,2)) * 0.01BD, 2) AS decimal(18,2)) AS fee_amount",
            ),
            "invoice": orders.selectExpr("o_orderkey AS id", "o_orderdate AS opening_date"),
            "invoice_item": li.selectExpr(f"{line_id} AS id", "l_orderkey AS invoice_id"),
            "invoice_entry": li.selectExpr(f"{line_id} AS txn_id", f"{line_id} AS invoice_item_id"),
            "account": self._accounts.select("account_number", "agreement_id", "audit_state"),
            "document": li.selectExpr(
                "l_shipdate AS posted_at",
                f"concat(if(l_linenumber IN (4, 5), '4070281051', '3023281051'), {number}) AS debit_number",
                f"concat(if(l_linenumber IN (4, 5), '3023381051', '4070281051'), {number}) AS credit_number",
                f"""CASE WHEN l_linenumber = 1 THEN '{_PURPOSES[0]} 1' WHEN l_linenumber = 2 THEN '{_PURPOSES[1]} 2'
                         WHEN l_linenumber = 3 THEN '{_PURPOSES[2]} 3' WHEN l_linenumber IN (4, 5) THEN '{_PURPOSES[3]}'
                         ELSE 'Прочее' END AS purpose""",
                "if(l_returnflag = 'N', 'NEW', 'PROV') AS state", f"{price} AS amount",
            ),
            "journal": li.selectExpr(
                "l_suppkey * 10 + if(l_linestatus = 'F', 2, 3) AS collection_id", "l_shipdate AS posted_at",
                f"{line_id} AS id", f"{price} AS in_balance", "CAST(l_quantity * 100 AS decimal(18,2)) AS amount",
                "l_returnflag = 'A' AS is_debit",
            ),
            "ledger_account": self._accounts.select("collection_id", "account_number"),
        }

    def _txn_types(self) -> DataFrame:
        """One type per quantity that occurs; quantities are whole numbers from 1 to 50."""
        return self.lineitem.selectExpr("CAST(l_quantity AS bigint) AS id").distinct().selectExpr("id", """
            CASE WHEN id <= 14 THEN 'purchase' WHEN id <= 22 THEN 'c2b' WHEN id <= 29 THEN 'refund'
                 WHEN id <= 33 THEN 'b2c' WHEN id <= 35 THEN 'purchaseReimb' WHEN id <= 37 THEN 'negativeReimb'
                 WHEN id <= 40 THEN 'C2BDISPUTE_DEBIT' WHEN id <= 43 THEN 'C2BDISPUTE_CREDIT'
                 WHEN id <= 45 THEN 'adjDebit' WHEN id <= 47 THEN 'adjCredit' ELSE 'other' END AS code""")

    def agreements(self, family: str) -> DataFrame:
        """Supplier agreements per source family; region 2 is in two of them."""
        regions = {"base": "0, 1, 2", "settl": "2, 3", "cards": "4"}[family]
        nations = self.nation.where(f"n_regionkey IN ({regions})").selectExpr("n_nationkey AS s_nationkey")
        return self.supplier.join(nations, "s_nationkey").selectExpr(
            "s_suppkey AS id", "concat('AGR/', s_suppkey) AS agr_number",
            "if(s_acctbal < 500, 'B', 'A') AS agreement_class",
            """CASE WHEN s_acctbal < 7000 THEN CAST(NULL AS date) WHEN s_acctbal < 8500 THEN DATE'1998-06-20'
                    ELSE DATE'1998-07-10' END AS closing_date""",
        )

    @staticmethod
    def agr_number(col: str) -> Column:
        return F.expr(f"concat('AGR/', {col})")

    @cached_property
    def _accounts(self) -> DataFrame:
        return self.supplier.selectExpr("s_suppkey", "s_acctbal", "explode(array(2, 3)) AS kind").selectExpr(
            "concat('3023', kind, '81051', lpad(CAST(s_suppkey AS string), 10, '0')) AS account_number",
            "s_suppkey AS agreement_id", "if(s_acctbal < 1500, 'R', 'A') AS audit_state",
            "s_suppkey * 10 + kind AS collection_id",
        )

    @cached_property
    def merchants(self) -> DataFrame:
        return self.supplier.selectExpr(
            "concat('AGR/', s_suppkey) AS agr_number", "date_add(DATE'1997-01-01', s_nationkey) AS agr_date",
            "concat('Director of ', s_name) AS director", "s_name AS merchant",
            "concat('D. ', s_name) AS director_short",
        )

    # -- users as accounts: change log of the journal, former balances, classes ------

    @cached_property
    def turnover_tables(self) -> dict[str, DataFrame]:
        """Change log of the journal: a later event with the same user and ``k`` on a day
        is a newer version of the posting."""
        changes = self.journal.selectExpr(
            "event_id AS id", "user_id AS collection_id", "datediff(day, DATE'2000-01-01') * 1000 + k AS doc_id", "ts AS posted_at",
            "ts AS stamped_at", "is_debit", "in_balance AS in_balance_rub", "amount AS amount_rub",
            "CAST(in_balance * 2 AS decimal(18,2)) AS in_balance", "CAST(amount * 2 AS decimal(18,2)) AS amount",
            "ts AS txn_ts", "event_id AS txn_id", "day AS dt",
        )
        zero, balance = "CAST(0 AS decimal(18,2))", "CAST(c_acctbal AS decimal(18,2))"
        legacy = self.customer.selectExpr(
            "c_custkey AS account_id", "DATE'2023-12-31' AS effective_from", "DATE'2100-12-31' AS effective_to",
            "DATE'2100-12-31' AS valid_to_date", f"{balance} AS in_amount", f"{zero} AS debit_amount",
            f"{zero} AS credit_amount", f"{balance} AS out_amount", f"{balance} AS in_currency_amount",
            f"{zero} AS debit_currency_amount", f"{zero} AS credit_currency_amount",
            f"{balance} AS out_currency_amount", "true AS closed_date_flag",
        )
        op_days = self.calendar.selectExpr("calendar_date AS op_day", "if(holiday_flag, 1, 3) AS day_status")
        return {
            "journal_changes": changes, "legacy_balance": legacy, "op_day": op_days,
            "ledger_account": self.ledger_accounts,
        }

    @cached_property
    def ledger_accounts(self) -> DataFrame:
        """Customers as ledger accounts: class by segment, responsible user by nation."""
        return self.customer.selectExpr(
            "c_custkey AS account_id", "c_custkey AS collection_id",
            """concat(if(c_mktsegment IN ('BUILDING', 'MACHINERY', 'HOUSEHOLD'), '30232', '30233'), '81051',
                      lpad(CAST(c_custkey AS string), 10, '0')) AS account_number""",
            "c_mktsegment AS type_id", "c_nationkey AS user_id",
        )

    @cached_property
    def account_types(self) -> DataFrame:
        """Segments as classes: two active, two passive, one mixed."""
        return self.customer.selectExpr("c_mktsegment AS type_id").distinct().selectExpr("type_id", """
            CASE WHEN type_id IN ('BUILDING', 'MACHINERY') THEN 'А'
                 WHEN type_id IN ('AUTOMOBILE', 'FURNITURE') THEN 'П' ELSE 'АП' END AS type_code""")

    @cached_property
    def account_users(self) -> DataFrame:
        return self.nation.select(F.col("n_nationkey").alias("user_id"), F.col("n_name").alias("user_name"))

    @cached_property
    def payment_tables(self) -> dict[str, DataFrame]:
        """Customers as merchants; purchases of a day as payment documents, other events as journal."""
        documents = self.postings.where("event_type = 'purchase'").selectExpr(
            "user_id * 1000 + k AS id", "ts AS document_date",
            "concat('3023281051', lpad(CAST(user_id AS string), 10, '0')) AS debit_number",
            "if(k < 50, '40702810510000000001', '30102810510000000001') AS credit_number",
            "CASE WHEN k < 40 THEN '11451550' WHEN k < 90 THEN '1916953' ELSE '0' END AS kind",
            "if(k = 7, 'DELETED', 'PROV') AS state", "amount", "user_id AS debit_account_id",
            "ts AS txn_ts", "event_id AS txn_id", "day AS dt",
        )
        customer = self.customer
        return {
            "journal_changes": self.turnover_tables["journal_changes"], "document_changes": documents,
            "calendar": self.calendar,
            "ledger_account": self.ledger_accounts.select("account_id", "collection_id", "account_number"),
            "merchant_contract": customer.selectExpr(
                "concat('CON/', c_custkey) AS agreement_number", "c_custkey AS account_link",
                "c_custkey AS client_id", "c_nationkey AS agreement_type_id",
            ),
            "contract_account": customer.selectExpr("c_custkey AS account_link", "c_custkey AS account_id"),
            "client": customer.selectExpr("c_custkey AS client_id", "c_name AS client_name"),
            "agreement_type": self.nation.selectExpr("n_nationkey AS agreement_type_id", "n_name AS agreement_type"),
        }

    # -- orders with their lines, and events, as two registers -------------------------
    # some orders have no line and some numbers no event, so either register lacks numbers of the other

    @cached_property
    def register_a(self) -> DataFrame:
        """One row per order with lines; its days lie in the month of the events."""
        return self.lineitem.groupBy(F.col("l_orderkey").alias("number")).agg(
            F.min("l_shipdate").alias("first"), F.sum(money(F.col("l_extendedprice"))).alias("total"),
            F.count(F.lit(1)).alias("n"),
        ).selectExpr(
            "number", f"{REGISTER_DAY} AS opened", f"if(n > 3, date_add({REGISTER_DAY}, 30), CAST(NULL AS date)) AS closed",
            "if(n > 2, 'active', 'idle') AS status", "CAST(total AS decimal(18,2)) AS amount",
        )

    @cached_property
    def register_b(self) -> DataFrame:
        """One row per event."""
        return self.events.selectExpr(
            "event_id AS number", "to_date(ts) AS opened",
            "if(event_type IN ('error', 'view'), date_add(to_date(ts), 29 + CAST(value AS int) % 2), CAST(NULL AS date)) AS closed",
            "if(event_type IN ('purchase', 'click', 'view'), 'active', 'idle') AS status", "CAST(value AS decimal(18,2)) AS amount",
        )
