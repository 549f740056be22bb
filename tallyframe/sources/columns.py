"""Column names of the banking source tables and the names used here.

Fixed values: left the source column, right ours. ``canonical`` renames, turns ids to
bigint and flags to boolean, so plans see one typing however a source stores them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.ids import norm_id, to_flag

SOURCE_COLUMNS: dict[str, dict[str, str]] = {
    "txn": {
        "id": "id", "txn_type_id": "txn_type_id", "orig_agreement_id": "orig_agreement_id",
        "rcvr_agreement_id": "rcvr_agreement_id", "txn_class": "txn_class",
        "txn_direction": "txn_direction", "txn_amount": "txn_amount",
    },
    "txn_type": {"id": "id", "code": "code"},
    "fee_txn": {"txn_id": "txn_id", "txn_direction": "txn_direction", "fee_amount": "fee_amount"},
    "invoice": {"id": "id", "opening_date": "opening_date"},
    "invoice_item": {"id": "id", "invoice_id": "invoice_id"},
    "invoice_entry": {"txn_id": "txn_id", "invoice_item_id": "invoice_item_id"},
    "agreement": {
        "id": "id", "agr_number": "agr_number", "agreement_class": "agreement_class",
        "signature_date": "signature_date", "closing_date": "closing_date",
    },
    "account": {
        "account_number": "account_number", "agreement_id": "agreement_id", "audit_state": "audit_state",
    },
    "document": {
        "id": "id", "C_DATE_PROV": "posted_at", "C_DATE_DOC": "document_date", "C_NUM_DT": "debit_number",
        "C_NUM_KT": "credit_number", "C_NAZN": "purpose", "STATE_ID": "state", "C_SUM": "amount",
        "C_ACC_DT": "debit_account_id", "C_VID_DOC": "kind",
        "txn_ts": "txn_ts", "txn_id": "txn_id", "dt": "dt",
    },
    "journal": {
        "ID": "id", "COLLECTION_ID": "collection_id", "C_DOC": "doc_id", "C_DATE": "posted_at",
        "C_STAMP": "stamped_at", "C_DT": "is_debit", "C_START_SUM": "in_balance", "C_SUMMA": "amount",
        "C_START_SUM_NAT": "in_balance_rub", "C_SUMMA_NAT": "amount_rub",
        "txn_ts": "txn_ts", "txn_id": "txn_id", "dt": "dt",
    },
    "ledger_account": {
        "ID": "account_id", "C_ARC_MOVE": "collection_id", "C_MAIN_V_ID": "account_number",
        "C_VID": "type_id", "C_OTV": "user_id",
    },
    "legacy_balance": {
        "account_nk": "account_id",
        "account_balance_effective_from_date": "effective_from",
        "account_balance_effective_to_date": "effective_to",
        "account_balance_in_amount": "in_amount", "account_debit_turn_amount": "debit_amount",
        "account_credit_turn_amount": "credit_amount", "account_balance_out_amount": "out_amount",
        "account_balance_in_currency_amount": "in_currency_amount",
        "account_debit_turn_currency_amount": "debit_currency_amount",
        "account_credit_turn_currency_amount": "credit_currency_amount",
        "account_balance_out_currency_amount": "out_currency_amount",
        "closed_date_flag": "closed_date_flag", "valid_to_date": "valid_to_date",
    },
    "account_type": {"ID": "type_id", "C_CODE": "type_code"},
    "account_user": {"ID": "user_id", "C_NAME": "user_name"},
    "merchant_contract": {
        "C_NUM_DOG": "agreement_number", "C_ACCOUNT_DOG": "account_link",
        "C_CLIENT": "client_id", "C_TYPE_DOG": "agreement_type_id",
    },
    "contract_account": {"COLLECTION_ID": "account_link", "C_ACCOUNT_DOG#1#2": "account_id"},
    "client": {"ID": "client_id", "C_NAME": "client_name"},
    "agreement_type": {"ID": "agreement_type_id", "C_NAME": "agreement_type"},
    "op_day": {"C_OP_DAY": "op_day", "C_CHANGE_POSS#0": "day_status"},
    "calendar": {"calendar_date": "calendar_date", "holiday_flag": "holiday_flag"},
    "product": {"C_GUID": "agr_number", "C_DATE_BEG": "open_date", "C_DATE_CLOSE": "close_date"},
    "internal_product": {
        "C_INTERNAL_CODE": "agr_number", "C_DATE_BEGIN": "open_date", "C_DATE_CLOSE": "close_date",
    },
    "merchant": {
        "agr_number": "agr_number", "agr_date": "agr_date", "director": "director",
        "director_short": "director_short", "merchant": "merchant",
    },
}

# Ids that may be stored as decimal text, and flags stored as 1/0, text or boolean.
DECIMAL_IDS = {
    "journal": ["id", "collection_id", "doc_id"],
    "ledger_account": ["account_id", "collection_id", "type_id", "user_id"],
    "document": ["id", "debit_account_id"],
    "contract_account": ["account_link", "account_id"],
    "merchant_contract": ["account_link", "client_id", "agreement_type_id"],
    "client": ["client_id"],
    "agreement_type": ["agreement_type_id"],
    "account_type": ["type_id"],
    "account_user": ["user_id"],
    "legacy_balance": ["account_id"],
}
FLAGS = {"journal": ["is_debit"]}


def canonical(df: DataFrame, table: str) -> DataFrame:
    """A source table under our column names and types; absent columns stay absent."""
    names = SOURCE_COLUMNS[table]
    present = {c.lower(): c for c in df.columns}
    out = df.select(*[
        F.col(f"`{present[src.lower()]}`").alias(ours)
        for src, ours in names.items() if src.lower() in present
    ])
    ids = [c for c in DECIMAL_IDS.get(table, []) if c in out.columns]
    flags = [c for c in FLAGS.get(table, []) if c in out.columns]
    return out.withColumns({
        **{c: norm_id(F.col(c)) for c in ids}, **{c: to_flag(F.col(c)) for c in flags},
    })
