"""Monthly acts: what each agreement bought, returned, paid and owed, and whether it adds up.

Tables are passed as a dict; see README for the columns of each.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import classify, money, signed
from ..operators.aggregates import pivot_sum, signed_sum
from ..operators.filters import in_prev_month
from ..operators.joins import semi_chain
from ..operators.ledger import as_of_balance
from ..operators.setops import union_sources
from ..params import previous_month
from . import fixed_values as fv

Tables = Mapping[str, DataFrame]


@dataclass(frozen=True)
class ActFamily:
    """How one source family differs from the others."""

    dispute_debit: str
    dispute_credit: str
    reimb_purposes: tuple[str, ...]
    skip_retired_accounts: bool


_WITH_REIMBURSEMENT = (*fv.TRANSFER_PURPOSES, fv.REIMBURSEMENT_PURPOSE)
ACT_FAMILIES = {
    "base": ActFamily(*fv.DISPUTE_CODES, tuple(fv.TRANSFER_PURPOSES), False),
    "settl": ActFamily(*fv.ADJUSTMENT_CODES, _WITH_REIMBURSEMENT, True),
    "cards": ActFamily(*fv.ADJUSTMENT_CODES, _WITH_REIMBURSEMENT, True),
}


def _any_like(col: Column, patterns: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [col.like(p) for p in patterns])


def invoiced_txns(t: Tables, as_of: date) -> DataFrame:
    """Financial transactions that are on an invoice opened in the previous month."""
    invoices = t["invoice"].where(in_prev_month(F.col("opening_date"), as_of))
    return semi_chain(
        t["txn"].where(F.col("txn_class") == fv.FINANCIAL_CLASS), "id",
        [(t["invoice_entry"], "txn_id", "invoice_item_id"), (t["invoice_item"], "id", "invoice_id"),
         (invoices, "id", None)],
    )


def txn_facts(t: Tables, as_of: date, family: ActFamily) -> DataFrame:
    """Sales, returns, fees and disputes from one pass over the invoiced transactions.

    Each transaction counts for its originating and its receiving agreement. Amounts are
    summed per agreement id and transaction type before types and agreements are joined,
    so those joins see few rows. Fees are summed per transaction first: their join cannot
    repeat a transaction.
    """
    # a semi join with the month's transactions would shuffle the fees by the same key, and the chain of invoices twice
    fees = t["fee_txn"].groupBy(F.col("txn_id").alias("fee_for")).agg(
        signed_sum(F.col("fee_amount"), F.col("txn_direction") == fv.REVERSAL).alias("fee")
    )
    txns = invoiced_txns(t, as_of).join(fees, F.col("id") == F.col("fee_for"), "left")
    reversed_ = F.col("txn_direction") == fv.REVERSAL
    per_type = (
        txns.select(F.inline(F.array(
            _side("orig", signed(F.col("txn_amount"), reversed_), F.col("fee")),
            _side("rcvr", F.col("txn_amount"), F.lit(None)),
        )))
        .groupBy("agreement_id", "txn_type_id", "side")
        .agg(F.sum("amount").alias("amount"), F.sum("fee").alias("fee"))
    )
    lines = per_type.join(
        t["txn_type"].select(F.col("id").alias("txn_type_id"), "code"), "txn_type_id"
    ).select("agreement_id", F.inline(_lines(family)))
    sums = _by_agreement(lines, t).groupBy("ttype", "agr_number").agg(F.sum("amount").alias("txn_amount"))
    no_default = F.col("ttype").isin("fee", "disp", "disp_cr")
    return sums.withColumn(
        "txn_amount", F.when(no_default, F.col("txn_amount")).otherwise(F.coalesce("txn_amount", F.lit(0)))
    )


def _side(side: str, amount: Column, fee: Column) -> Column:
    return F.struct(
        F.col(f"{side}_agreement_id").alias("agreement_id"), "txn_type_id", F.lit(side).alias("side"),
        amount.cast("decimal(18,2)").alias("amount"), fee.cast("decimal(28,2)").alias("fee"),
    )


def _lines(family: ActFamily) -> Column:
    """Act lines of one agreement and transaction type: sale and fee, or dispute."""
    code, amount, side = F.col("code"), F.col("amount"), F.col("side")
    sale = classify([("debits", code.isin(fv.DEBIT_CODES)), ("credits", code.isin(fv.CREDIT_CODES))])
    dispute = classify([("disp", code == family.dispute_debit), ("disp_cr", code == family.dispute_credit)])
    counted = (side == "orig") & ~code.isin(fv.REIMBURSEMENT_CODES)

    def line(ttype: Column, value: Column) -> Column:
        return F.struct(ttype.alias("ttype"), value.cast("decimal(38,2)").alias("amount"))

    return F.array_compact(F.array(
        F.when(counted, line(sale, amount)),
        F.when(counted, line(F.lit("fee"), F.col("fee"))),
        F.when((side == "rcvr") & dispute.isNotNull(), line(dispute, amount)),
    ))


def _by_agreement(df: DataFrame, t: Tables) -> DataFrame:
    agreements = t["agreement"].select(F.col("id").alias("agr_id"), "agr_number")
    return df.join(agreements, F.col("agreement_id") == F.col("agr_id"))


def _accounts(t: Tables, family: ActFamily) -> DataFrame:
    accounts = t["account"]
    if family.skip_retired_accounts:
        accounts = accounts.where(F.col("audit_state") != fv.RETIRED_ACCOUNT)
    return accounts.select(F.col("account_number").alias("acc_number"), "agreement_id")


def _document_totals(t: Tables, as_of: date, family: ActFamily) -> DataFrame:
    """Posted documents of the month by act line and account, from one scan."""
    debit, credit, purpose = F.col("debit_number"), F.col("credit_number"), F.col("purpose")
    ttype = classify([
        ("reimb", debit.like(fv.REIMB_DEBIT_PATTERN) & _any_like(purpose, family.reimb_purposes)),
        ("fixloan", debit.like(fv.FIXLOAN_DEBIT_PATTERN) & credit.startswith(fv.CLIENT_DEBT_PREFIX)
         & purpose.like(fv.FIXLOAN_PURPOSE)),
    ])
    return (
        t["document"]
        .where((F.col("state") == fv.POSTED_STATE) & in_prev_month(F.col("posted_at"), as_of))
        .select(ttype.alias("ttype"), debit, credit, "amount")
        .where(F.col("ttype").isNotNull())
        .groupBy(
            "ttype",
            F.when(F.col("ttype") == "reimb", debit).otherwise(credit).alias("account_number"),
        )
        .agg(F.sum("amount").alias("amount"))
    )


def document_facts(t: Tables, as_of: date, family: ActFamily) -> DataFrame:
    """Transfers to clients and repaid loans."""
    totals = _document_totals(t, as_of, family)
    on_account = totals.join(_accounts(t, family), F.col("account_number") == F.col("acc_number"))
    return _by_agreement(on_account, t).groupBy("ttype", "agr_number").agg(F.sum("amount").alias("txn_amount"))


def unmatched_documents(t: Tables, as_of: date, family: str = "base") -> DataFrame:
    """Document money that belongs to no known account, by act line: acts leave it out."""
    fam = ACT_FAMILIES[family]
    return (
        _document_totals(t, as_of, fam)
        .join(_accounts(t, fam), F.col("account_number") == F.col("acc_number"), "left_anti")
        .groupBy("ttype").agg(F.sum("amount").alias("amount"), F.count(F.lit(1)).alias("n_accounts"))
    )


def balance_facts(t: Tables, as_of: date, family: ActFamily) -> DataFrame:
    """Debts at both ends of the month, one row per account."""
    lo, hi = previous_month(as_of)
    balances = as_of_balance(t["journal"], "collection_id", ["posted_at", "id"], {"start": lo, "end": hi})
    ledger_accounts = (
        t["ledger_account"].where(F.col("account_number").like(fv.DEBT_ACCOUNT_PATTERN))
        .select(F.col("collection_id").alias("acc_collection"), "account_number")
    )
    side = classify([
        ("debt_bank_", F.col("account_number").startswith(fv.BANK_DEBT_PREFIX)),
        ("debt_client_", F.col("account_number").startswith(fv.CLIENT_DEBT_PREFIX)),
    ])
    owned = (
        balances.join(ledger_accounts, F.col("collection_id") == F.col("acc_collection"))
        .join(_accounts(t, family), F.col("account_number") == F.col("acc_number"))
        .withColumn("ttype", F.concat(side, F.col("cutoff")))
    )
    return (
        _by_agreement(owned, t)
        .groupBy("ttype", "agr_number", "account_number")
        .agg(F.abs(F.sum("balance")).alias("txn_amount"))
        .drop("account_number")
    )


def act_data(t: Tables, as_of: date, family: str = "base", keep_unclassified: bool = False) -> DataFrame:
    """``(ttype, agr_number, txn_amount)`` of the month before ``as_of``.

    Lines whose transaction code fits no type have a NULL ``ttype``; no act uses them, so
    they are left out unless asked for.
    """
    fam = ACT_FAMILIES[family]
    facts = union_sources(*[
        part(t, as_of, fam).select("ttype", "agr_number", F.col("txn_amount").cast("decimal(38,2)"))
        for part in (txn_facts, document_facts, balance_facts)
    ])
    return facts if keep_unclassified else facts.where(F.col("ttype").isNotNull())


def open_agreements(agreements: Sequence[DataFrame], as_of: date) -> DataFrame:
    """Merchant agreements that were not closed before the current month, and how many
    sources list each."""
    _, hi = previous_month(as_of)
    closing = F.col("closing_date")
    listed = [
        a.where((F.col("agreement_class") == fv.MERCHANT_AGREEMENT_CLASS)
                & (closing.isNull() | (closing >= F.lit(hi))))
        .select("agr_number", F.lit(i).alias("source"))
        for i, a in enumerate(agreements)
    ]
    return union_sources(*listed).distinct().groupBy("agr_number").agg(F.count(F.lit(1)).alias("n_sources"))


def act_final(
    facts: DataFrame, agreements: Sequence[DataFrame], merchants: DataFrame, as_of: date,
    repeat_shared: bool = False,
) -> DataFrame:
    """One act per merchant: eleven amounts, their check sum and whether it is zero.

    An agreement listed by several sources counts once; ``repeat_shared`` counts its
    amounts once per source. ``has_data`` tells an act without any line (also "balanced")
    from one that adds up.
    """
    columns = list(fv.ACT_COLUMNS.values())
    sums = pivot_sum(facts, ["agr_number"], "ttype", fv.ACT_COLUMNS, "txn_amount")
    acts = open_agreements(agreements, as_of).join(sums, "agr_number").withColumn("has_data", F.lit(True))
    if repeat_shared:
        acts = acts.withColumns({c: F.col(c) * F.col("n_sources") for c in columns})
    people = merchants.select("agr_number", "agr_date", "director", "merchant", "director_short").distinct()
    full = people.join(acts.drop("n_sources"), "agr_number", "left").withColumns({
        **{c: money(F.coalesce(F.col(c), F.lit(0))) for c in columns},
        "has_data": F.coalesce("has_data", F.lit(False)),
    })
    plus = reduce(lambda a, b: a + b, [F.col(c) for c in fv.ACT_PLUS])
    check = reduce(lambda a, b: a - b, [F.col(c) for c in fv.ACT_MINUS], plus)
    return full.withColumn("check_amount", check).withColumn(
        "condition", F.when(F.col("check_amount") == 0, 1).otherwise(0)
    )


def act_details(final: DataFrame) -> DataFrame:
    """Acts under the labels people read."""
    return final.select(*[F.col(c).alias(label) for c, label in fv.ACT_LABELS.items()])
