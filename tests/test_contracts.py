"""Producers of the registered reports fit their contracts, and ordered queries are in order."""

import pytest

import __spark_entry__ as entry_point
from tallyframe.delivery.catalogue import CONTRACTS
from tallyframe.delivery.contracts import check_contract

PRODUCERS = {
    "q_agreements": "agreements", "q_payments": "merchants_payments", "c_account_status": "account_statuses",
    "c_totals_diff": "acquiring_totals", "c_date_pair_compare": "auto_funding", "c_amount_compare": "merchants_monthly",
    "c_txn_vs_document": "card_transactions", "c_credit_vs_document": "credit_transactions", "c_fake_clear": "fake_clears",
    "c_duplicates": "transaction_duplicates", "c_doc_vs_message": "document_messages",
}


def test_all_contracts_have_a_producer():
    assert sorted(PRODUCERS.values()) == sorted(CONTRACTS)


@pytest.mark.parametrize("key", sorted(PRODUCERS))
def test_producer_fits_its_contract(spark, sf_dir, key):
    found = entry_point.queries()[key](spark, sf_dir)
    assert check_contract(found, CONTRACTS[PRODUCERS[key]]) == []
    assert found.columns == [c.name for c in CONTRACTS[PRODUCERS[key]].columns]


@pytest.mark.parametrize("key, column, classes", [
    ("q_agreements", "error_name", {"missing_in_a", "missing_in_b", "open_date_differs", "close_date_differs"}),
    ("c_account_status", "error_name",
     {"missing_in_a", "missing_in_b", "open_date_differs", "close_date_differs", "status_differs"}),
    ("c_doc_vs_message", "diff_type", {"no_message", "no_document", "sum_differs"}),
    ("rep_register_compare", "error_name", {"missing_in_a", "missing_in_b", "open_date_differs", "amount_differs"}),
    ("join_anti_sides", "side", {"only_a", "only_b"}),
])
def test_all_classes_occur_on_whole_tables(spark, sf_dir, key, column, classes):
    sf_dir = sf_dir.replace("sf0.001", "sf0.01")
    found = entry_point.queries()[key](spark, sf_dir)
    assert {r[0] for r in found.select(column).distinct().collect()} == classes


RANK = {"MACHINERY": 1, "BUILDING": 2}
SEVERITY = {"КРИТИЧЕСКОЕ": 1, "ВЫСОКОЕ": 2, "СРЕДНЕЕ": 3}


@pytest.mark.parametrize("key, order", [
    ("sort_expr", lambda r: (r.diff, r.o_orderkey)),
    ("sort_case_rank", lambda r: (RANK.get(r.c_mktsegment, 9), SEVERITY.get(r.severity, 9), -r.amount, r.c_custkey)),
    ("q_payments", lambda r: (r.diff_amount, r.agreement_number, r.account_number)),
])
def test_rows_come_in_order(spark, sf_dir, key, order):
    found = [order(r) for r in entry_point.queries()[key](spark, sf_dir).collect()]
    assert len(found) > 1 and found == sorted(found)
