"""Reports of which only the output columns are known.

The rules below are our reading of those columns and of the discrepancy classes that
message bodies count; they are no record of what some other system computes.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import classify
from ..operators.compare import compare_amounts, compare_registers, differs, full_compare, missing_in, totals_diff
from ..operators.joins import same_key

ACCOUNT_CLASSES = {
    "missing_in_a": "cnt_missing_in_a", "missing_in_b": "cnt_missing_in_b",
    "open_date_differs": "cnt_open_date_differs", "close_date_differs": "cnt_close_date_differs",
    "status_differs": "cnt_status_differs",
}


def account_statuses(a: DataFrame, b: DataFrame, null_safe: bool = False) -> DataFrame:
    """Accounts ``(account, date_open, date_close, status)`` that differ, by first class."""
    both = F.col("in_a") & F.col("in_b")
    rules = [
        ("missing_in_a", ~F.col("in_a")),
        ("missing_in_b", ~F.col("in_b")),
        ("open_date_differs", both & differs("a_date_open", "b_date_open", null_safe)),
        ("close_date_differs", both & differs("a_date_close", "b_date_close", null_safe)),
        ("status_differs", both & differs("a_status", "b_status", null_safe)),
    ]
    found = compare_registers(a, b, ["account"], rules)
    return found.select(
        F.when(F.col("in_a"), F.col("account")).alias("a_account"),
        F.when(F.col("in_b"), F.col("account")).alias("b_account"),
        "a_date_open", "b_date_open", "a_date_close", "b_date_close", "a_status", "b_status", "error_name",
    )


def acquiring_totals(a: DataFrame, b: DataFrame) -> DataFrame:
    """Total payments and refunds of both sides and their differences."""
    out = totals_diff(a, b, ["payments", "refunds"])
    return out.select("payments_a", "refunds_a", "payments_b", "refunds_b", "refunds_diff", "payments_diff")


def auto_funding(a: DataFrame, b: DataFrame) -> DataFrame:
    """Orders ``(number, buid, start_date, end_date)`` whose dates differ or that one side lacks."""
    cond = (
        ~F.col("in_a") | ~F.col("in_b")
        | differs("a_start_date", "b_start_date", True) | differs("a_end_date", "b_end_date", True)
    )
    return full_compare(a, b, ["number", "buid"]).where(cond).select(
        "number", "buid", "a_start_date", "b_start_date", "a_end_date", "b_end_date"
    )


def merchants_monthly(facts_a: DataFrame, facts_b: DataFrame, accounts: DataFrame) -> DataFrame:
    """Act lines of both sides by type and agreement; only differing ones are shown.

    ``accounts`` (agr_number, acc) names the account of an agreement, one row each.
    """
    lines = compare_amounts(facts_a, facts_b, ["ttype", "agr_number"], "amount", only_diff=True)
    return lines.join(accounts, "agr_number", "left").select("ttype", "agr_number", "amount_a", "acc", "amount_b", "diff")


PAIR = ["debit_account_number", "credit_account_number"]


def txn_vs_document(txns: DataFrame, documents: DataFrame) -> DataFrame:
    """Transactions against documents of the same account pair and reference number (``rrn``).

    A transaction is shown when its reference adds up to another amount in the documents, a document
    when its reference has no transaction. Sums: ``group_a`` and ``group_b`` of the account pair,
    ``ref_a`` and ``ref_b`` of the pair and reference, ``named_ref`` of all documents that name the
    reference. All sums shrink on the map side before they meet.
    """
    lines = compare_amounts(txns, documents, [*PAIR, "rrn"], "amount").withColumnsRenamed({"amount_a": "ref_a", "amount_b": "ref_b"})
    group = lines.groupBy(*PAIR).agg(F.sum("ref_a").alias("group_a"), F.sum("ref_b").alias("group_b"))
    named = documents.groupBy("rrn").agg(F.sum("amount").alias("named_ref"))
    wrong = lines.where(F.col("diff") != 0).join(group, PAIR).join(named, "rrn", "left").withColumn(
        "error_name", classify([("no_transaction", ~F.col("in_a")), ("no_document", ~F.col("in_b"))], "amount_differs"))
    return wrong.drop("in_a", "in_b", "diff").join(txns, [*PAIR, "rrn"], "left")


def _report(rows: DataFrame, name: str, as_of: date, columns: dict[str, str]) -> DataFrame:
    return rows.select(
        F.lit(as_of).alias("report_date"), F.lit(name).alias("report_name"),
        *[F.col(source).alias(ours) for ours, source in columns.items()])


_TXN = ["ttype", "direction", "t_direction", "amount"]
_REFERENCES = ["agr_number", "rrn", "acq_ref_number", "trace_ref_number"]


def card_transactions(txns: DataFrame, documents: DataFrame, as_of: date, name: str = "card_transactions") -> DataFrame:
    """Card transactions that their payment documents do not cover, and documents without one."""
    sums = {"sum_settl_amount": "group_a", "sum_c_sum": "group_b", "sum_amount_rrn": "ref_a", "sum_nazn_rrn": "named_ref",
            "sum_sum_rrn": "ref_b"}
    plain = ["error_name", "banking_date", *PAIR, "orig_system", *_TXN]
    return _report(txn_vs_document(txns, documents), name, as_of,
                   {**{c: c for c in plain}, **sums, **{c: c for c in _REFERENCES}})


def credit_transactions(txns: DataFrame, documents: DataFrame, as_of: date, name: str = "credit_transactions") -> DataFrame:
    """The same for credit transactions, whose day is ``txn_date``."""
    sums = {"sum_settl_amount": "group_a", "sum_c_sum": "group_b", "sum_settl_amount_rrn": "ref_a",
            "sum_sum_nazn_rrn": "named_ref", "sum_sum_rrn": "ref_b"}
    plain = ["error_name", "txn_date", *PAIR, *_TXN]
    return _report(txn_vs_document(txns, documents), name, as_of,
                   {**{c: c for c in plain}, **sums, **{c: c for c in _REFERENCES}})


def fake_clears(clears: DataFrame, authorisations: DataFrame) -> DataFrame:
    """Clearings (banking_date, trace_ref_number, ret_ref_number, ttype, amount) that no authorisation of
    the same reference numbers stands behind."""
    return missing_in(clears, authorisations, ["trace_ref_number", "ret_ref_number"]).select(
        F.lit("no_authorisation").alias("error_name"), "banking_date", "trace_ref_number", "ret_ref_number", "ttype", "amount")


def transaction_duplicates(txns: DataFrame, name: str = "transaction_duplicates") -> DataFrame:
    """Transactions whose reference numbers and amount occur again; the root is the copy with the least id.

    Copies are counted on the map side and joined back, so a reference with many copies is no hot group.
    """
    keys = ["ret_ref_number", "trace_ref_number", "acq_ref_number", "amount"]
    groups = txns.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.min("txn_id").alias("root")).where("n > 1")
    return txns.alias("r").join(groups.alias("c"), same_key(keys, "r", "c")).select(
        F.lit(name).alias("report_name"), "r.banking_date", "r.ttype", "r.amount", "r.ret_ref_number", "r.trace_ref_number",
        "r.acq_ref_number", "r.purpose", F.col("c.root").cast("string").alias("root_txn_id"))


def document_messages(documents: DataFrame, messages: DataFrame, as_of: date) -> DataFrame:
    """Payment documents against messages by number: missing on a side, or sum, account or day differs.

    The document's values are shown, the message's where there is no document.
    """
    both = F.col("in_a") & F.col("in_b")
    rules = [
        ("no_message", ~F.col("in_b")),
        ("no_document", ~F.col("in_a")),
        ("sum_differs", both & differs("a_document_sum", "b_document_sum", True)),
        ("account_differs", both & differs("a_payer_account", "b_payer_account", True)),
        ("date_differs", both & differs("a_document_date", "b_document_date", True)),
    ]
    found = compare_registers(documents, messages, ["document_num"], rules, label="diff_type")
    shown = ["document_date", "document_sum", "payer_account", "recipient_account", "payment_purpose"]
    values = {c: F.coalesce(f"a_{c}", f"b_{c}").alias(c) for c in shown}
    return found.select(
        F.lit(as_of).alias("check_date"), values["document_date"], "document_num", values["document_sum"],
        values["payer_account"], values["recipient_account"], values["payment_purpose"],
        F.col("b_message_id").alias("message_id"), "diff_type")
