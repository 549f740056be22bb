"""Balances owed to merchants against the payment documents of the day."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date, timedelta
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.filters import filter_by_window
from ..operators.ledger import turnover_of, turnover_parts
from ..operators.windows import holiday_islands, latest_version
from ..sources.tables import cdc_window
from . import fixed_values as fv

Tables = Mapping[str, DataFrame]


def posting_window(calendar: DataFrame, as_of: date) -> DataFrame:
    """The days whose postings are paid on ``as_of`` if it follows a holiday run: from the
    last working day before the run to its last holiday. No row on other days."""
    day = F.lit(as_of)
    return holiday_islands(calendar).where(
        (F.date_add("start_date", 1) <= day) & (F.col("finish_date") >= day)
    ).select("start_date", F.date_sub("finish_date", 1).alias("end_date"))


def account_balances(t: Tables, as_of: date, days: int = 30) -> DataFrame:
    """Closing balance of each debt account over the posting window."""
    journal = latest_version(
        cdc_window(t["journal_changes"], as_of, days), ["doc_id", "collection_id"], ["txn_ts", "txn_id"]
    ).withColumn("day", F.to_date("posted_at"))
    postings = filter_by_window(
        journal, "day", posting_window(t["calendar"], as_of), "start_date", "end_date",
        fallback=as_of - timedelta(days=1),
    )
    accounts = t["ledger_account"].where(F.col("account_number").startswith(fv.BANK_DEBT_PREFIX)).select(
        F.col("collection_id").alias("acc_collection"), F.col("account_id").alias("balance_account_id")
    )
    parts = turnover_parts(
        postings, ["collection_id"], ["posted_at", "id"], {"_amount": ("in_balance_rub", "amount_rub")}
    )
    owned = parts.join(accounts, F.col("collection_id") == F.col("acc_collection"))
    return turnover_of(owned, ["balance_account_id"], ["_amount"]).select("balance_account_id", "out_amount")


def payment_totals(t: Tables, as_of: date, days: int = 30) -> DataFrame:
    """Payment documents of the day per agreement, summed per account before the joins."""
    documents = latest_version(cdc_window(t["document_changes"], as_of, days), ["id"], ["txn_ts", "txn_id"])
    kinds = reduce(lambda a, b: a | b, [
        F.col("credit_number").like(pattern) & (F.col("kind") == kind)
        for pattern, kind in fv.PAYMENT_KINDS.items()
    ])
    paid = (
        documents.where(
            (F.col("document_date") >= F.lit(as_of))
            & (F.col("document_date") < F.lit(as_of + timedelta(days=1)))
            & F.col("debit_number").startswith(fv.BANK_DEBT_PREFIX)
            & kinds
            & ~F.col("state").isin(fv.EXCLUDED_STATES)
        )
        .groupBy("debit_account_id").agg(F.sum("amount").alias("amount"))
    )
    return (
        t["merchant_contract"].join(t["contract_account"], "account_link")
        .join(paid, F.col("account_id") == F.col("debit_account_id"))
        .groupBy(F.col("agreement_number").alias("paid_agreement"))
        .agg(F.coalesce(F.sum("amount"), F.lit(0)).alias("payment_documents_amount"))
    )


def payments_check(t: Tables, as_of: date, days: int = 30, ordered: bool = True) -> DataFrame:
    accounts = t["ledger_account"].where(F.col("account_number").startswith(fv.BANK_DEBT_PREFIX)).select(
        "account_id", "account_number"
    )
    out = F.coalesce(F.col("out_amount"), F.lit(0))
    paid = F.coalesce(F.col("payment_documents_amount"), F.lit(0))
    result = (
        t["merchant_contract"]
        .join(t["contract_account"], "account_link")
        .join(accounts, "account_id")
        .join(t["client"], "client_id", "left")
        .join(t["agreement_type"], "agreement_type_id", "left")
        .join(account_balances(t, as_of, days), F.col("account_id") == F.col("balance_account_id"), "left")
        .join(payment_totals(t, as_of, days), F.col("agreement_number") == F.col("paid_agreement"), "left")
        .select(
            "agreement_number", "client_name", "agreement_type", "account_number",
            out.alias("out_balance_amount"), paid.alias("payment_documents_amount"),
            (paid - out).alias("diff_amount"),
        )
    )
    # many differences are equal (zero): the further keys spread them over the sort
    return result.orderBy("diff_amount", "agreement_number", "account_number") if ordered else result
