"""The complete reports on small hand-made tables."""

from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from helpers import D, at, day, rows
from tallyframe.operators.filters import valid_on
from tallyframe.operators.ledger import as_of_balance, as_of_snapshot
from tallyframe.plans import (
    act_data, act_details, act_final, agreements_check, balance_intervals, open_agreements, payments_check,
    red_balance, red_summary, turnover, turnover_for_dates, unmatched_documents, violations,
)
from tallyframe.plans import fixed_values as fv

AS_OF = date(2024, 3, 15)  # previous month: February 2024


# -- balances from a journal ---------------------------------------------------------------

def test_as_of_breaks_ties_by_id_and_leaves_late_entities_null(spark):
    journal = spark.createDataFrame([
        ("a", at("2024-01-31 23:59"), 1, D("10.00"), D("1.00"), True),
        ("a", at("2024-01-31 23:59"), 2, D("9.00"), D("4.00"), False),
        ("a", at("2024-02-01 00:00"), 3, D("13.00"), D("3.00"), True),
        ("b", at("2024-02-10 08:00"), 4, D("0.00"), D("7.00"), False),
        ("c", at("2024-03-01 00:00"), 5, D("1.00"), D("1.00"), False),
        ("d", at("2024-01-05 00:00"), 6, D("2.00"), D("1.00"), None),
    ], "acc string, posted_at timestamp, id int, in_balance decimal(18,2), amount decimal(18,2), is_debit boolean")
    cuts = {"start": day("2024-02-01"), "end": day("2024-03-01")}
    assert rows(as_of_balance(journal, "acc", ["posted_at", "id"], cuts)) == [
        ("a", "end", D("10.00")), ("a", "start", D("13.00")), ("b", "end", D("7.00")),
        ("d", "end", D("3.00")), ("d", "start", D("3.00"))]
    snap = as_of_snapshot(journal, "acc", ["posted_at", "id"], [], cuts)
    assert rows(snap.where("start IS NULL"), "acc") == [("b",)]


# -- acts ------------------------------------------------------------------------------------

FEB = at("2024-02-10 12:00")


@pytest.fixture(scope="module")
def act_tables(spark):
    def make(data, schema):
        return spark.createDataFrame(data, schema)

    def bank(n):
        return f"3023281051{n:010d}"

    def client(n):
        return f"3023381051{n:010d}"

    codes = ["purchase", "c2b", "refund", "b2c", "purchaseReimb", "C2BDISPUTE_DEBIT", "C2BDISPUTE_CREDIT",
             "adjDebit", "adjCredit", "strange"]
    txn = [  # id, type, orig, rcvr, class, direction, amount
        (1, 1, 1, 9, "F", "D", "100.00"), (2, 2, 1, 9, "F", "R", "30.00"), (3, 3, 1, 9, "F", "D", "20.00"),
        (4, 5, 1, 9, "F", "D", "999.00"),   # reimbursement code: no line
        (5, 6, 2, 1, "F", "R", "8.00"),     # dispute for the receiving agreement, unsigned
        (6, 7, 2, 1, "F", "D", "5.00"),
        (7, 1, 1, 9, "A", "D", "777.00"),   # not financial
        (8, 1, 1, 9, "F", "D", "555.00"),   # invoice of another month
        (9, 10, 1, 9, "F", "D", "3.00"),    # code outside the lists: fee only
        (10, 8, 2, 1, "F", "D", "6.00"),    # adjustment codes belong to the other families
    ]
    items = [(n, 100 if n != 8 else 200) for n in range(1, 11)]
    documents = [  # posted, debit, credit, purpose, state, amount
        (FEB, bank(1), "40702", "Переводы физических лиц согласно Реестру 5", "PROV", "40.00"),
        (FEB, bank(1), "40702", "Возмещение ден.средств по операциям эквайринга по Реестру 5", "PROV", "41.00"),
        (FEB, bank(1), "40702", "Прочее", "PROV", "42.00"),
        (FEB, bank(1), "40702", "Переводы физических лиц согласно Реестру 6", "NEW", "43.00"),
        (at("2024-03-01 00:00"), bank(1), "40702", "Переводы физических лиц согласно Реестру 7", "PROV", "44.00"),
        (FEB, "40702810", client(1), "Исполнение нетто-требований 1", "PROV", "15.00"),
        (FEB, "40702810", client(7), "Исполнение нетто-требований 2", "PROV", "16.00"),  # unknown account
    ]
    journal = [  # collection, posted, id, in, amount, debit
        (12, at("2024-01-20 00:00"), 1, "50.00", "10.00", True), (12, at("2024-02-20 00:00"), 2, "40.00", "25.00", False),
        (13, at("2024-02-21 00:00"), 3, "-4.00", "3.00", True),
    ]
    money = "decimal(18,2)"
    return {
        "txn": make([(*t[:6], D(t[6])) for t in txn], "id bigint, txn_type_id bigint, orig_agreement_id bigint, "
                    f"rcvr_agreement_id bigint, txn_class string, txn_direction string, txn_amount {money}"),
        "txn_type": make([(i + 1, c) for i, c in enumerate(codes)], "id bigint, code string"),
        "fee_txn": make([(1, "D", D("2.00")), (1, "D", D("0.50")), (2, "R", D("1.00")), (9, "D", D("0.25")),
                         (7, "D", D("70.00"))], f"txn_id bigint, txn_direction string, fee_amount {money}"),
        "invoice": make([(100, day("2024-02-29")), (200, day("2024-01-31"))], "id bigint, opening_date date"),
        "invoice_item": make([(n * 10, inv) for n, inv in items], "id bigint, invoice_id bigint"),
        "invoice_entry": make([(n, n * 10) for n, _ in items] + [(1, 10)], "txn_id bigint, invoice_item_id bigint"),
        "agreement": make([(1, "A-1", "A", None), (2, "A-2", "A", day("2024-03-01")), (3, "A-3", "A", day("2024-02-29")),
                           (4, "A-4", "X", None)], "id bigint, agr_number string, agreement_class string, closing_date date"),
        "account": make([(bank(1), 1, "A"), (client(1), 1, "R")], "account_number string, agreement_id bigint, audit_state string"),
        "document": make([(*d[:5], D(d[5])) for d in documents], "posted_at timestamp, debit_number string, "
                         f"credit_number string, purpose string, state string, amount {money}"),
        "journal": make([(*j[:3], D(j[3]), D(j[4]), j[5]) for j in journal],
                        f"collection_id bigint, posted_at timestamp, id bigint, in_balance {money}, amount {money}, is_debit boolean"),
        "ledger_account": make([(12, bank(1)), (13, client(1)), (14, "40702810500000000001")],
                               "collection_id bigint, account_number string"),
    }


def test_act_lines_of_the_base_family(act_tables):
    assert rows(act_data(act_tables, AS_OF), "ttype", "agr_number", "txn_amount") == [
        ("credits", "A-1", D("20.00")), ("debits", "A-1", D("70.00")), ("debt_bank_end", "A-1", D("65.00")),
        ("debt_bank_start", "A-1", D("40.00")), ("debt_client_end", "A-1", D("7.00")), ("disp", "A-1", D("8.00")),
        ("disp_cr", "A-1", D("5.00")), ("fee", "A-1", D("1.75")), ("fee", "A-2", None),
        ("fixloan", "A-1", D("15.00")), ("reimb", "A-1", D("40.00"))]


def test_other_families_have_adjustments_one_more_purpose_and_no_retired_accounts(act_tables):
    got = {(t, a): x for t, a, x in rows(act_data(act_tables, AS_OF, "settl"), "ttype", "agr_number", "txn_amount")}
    assert got[("reimb", "A-1")] == D("81.00")
    assert got[("disp", "A-1")] == D("6.00")
    assert ("disp_cr", "A-1") not in got and ("fixloan", "A-1") not in got and ("debt_client_end", "A-1") not in got
    assert rows(act_data(act_tables, AS_OF, "cards")) == rows(act_data(act_tables, AS_OF, "settl"))


def test_unclassified_lines_and_unmatched_documents_are_countable(act_tables):
    loose = act_data(act_tables, AS_OF, keep_unclassified=True).where("ttype IS NULL")
    assert rows(loose, "agr_number", "txn_amount") == [("A-1", D("3.00")), ("A-2", D("3.00"))]
    assert rows(unmatched_documents(act_tables, AS_OF)) == [("fixloan", D("16.00"), 1)]


@pytest.fixture(scope="module")
def merchants(spark):
    return spark.createDataFrame(
        [(n, day("2023-01-01"), f"dir {n}", f"merchant {n}", n) for n in ("A-1", "A-2", "A-3", "none")],
        "agr_number string, agr_date date, director string, merchant string, director_short string")


def facts_of(spark, data):
    return spark.createDataFrame([(t, a, D(x)) for t, a, x in data], "ttype string, agr_number string, txn_amount decimal(38,2)")


def test_final_act_checks_the_identity(spark, act_tables, merchants):
    facts = facts_of(spark, [
        ("debt_bank_start", "A-1", "10"), ("debits", "A-1", "100"), ("disp_cr", "A-1", "5"), ("fixloan", "A-1", "1"),
        ("debt_client_end", "A-1", "2"), ("debt_bank_end", "A-1", "8"), ("credits", "A-1", "20"), ("disp", "A-1", "4"),
        ("fee", "A-1", "6"), ("reimb", "A-1", "77"), ("debt_client_start", "A-1", "3"), ("debits", "A-2", "1"),
        ("debits", "A-3", "9"),  # closed before the month's end: no act lines
    ])
    final = act_final(facts, [act_tables["agreement"]], merchants, AS_OF)
    assert rows(final, "agr_number", "check_amount", "condition", "has_data") == [
        ("A-1", D("0.00"), 1, True), ("A-2", D("1.00"), 0, True), ("A-3", D("0.00"), 1, False),
        ("none", D("0.00"), 1, False)]
    assert act_details(final).columns == list(fv.ACT_LABELS.values())
    assert set(fv.ACT_PLUS) | set(fv.ACT_MINUS) == set(fv.ACT_COLUMNS.values())


def test_an_agreement_in_two_sources_counts_once(spark, act_tables, merchants):
    facts = facts_of(spark, [("debits", "A-1", "100")])
    sources = [act_tables["agreement"], act_tables["agreement"]]
    once = act_final(facts, sources, merchants, AS_OF)
    twice = act_final(facts, sources, merchants, AS_OF, repeat_shared=True)
    assert once.where("agr_number = 'A-1'").first()["purchases_amount"] == D("100.00")
    assert twice.where("agr_number = 'A-1'").first()["purchases_amount"] == D("200.00")
    assert rows(open_agreements(sources, AS_OF)) == [("A-1", 2), ("A-2", 2)]


# -- turnover --------------------------------------------------------------------------------

CUTOVER = date(2024, 3, 1)


@pytest.fixture(scope="module")
def ledger(spark):
    money = "decimal(18,2)"
    changes = [  # collection, doc, id, posted, debit, in, amount, txn_ts, txn_id, dt
        (1, 1, 1, "2024-03-05 09:00", False, "100", "10", 1, 1), (1, 2, 2, "2024-03-05 10:00", True, "110", "40", 1, 1),
        (1, 3, 3, "2024-03-10 08:00", None, "70", "5", 1, 1),
        (1, 4, 4, "2024-03-12 08:00", True, "75", "1", 1, 1), (1, 4, 5, "2024-03-12 08:00", False, "75", "30", 1, 2),
        (2, 5, 6, "2024-03-15 08:00", True, "0", "20", 1, 1), (3, 6, 7, "2024-02-28 08:00", True, "0", "99", 1, 1),
        (2, 7, 8, "2024-03-16 08:00", False, "-20", "1", 1, 1),
    ]
    legacy = [  # account, from, to, out
        (11, "2024-01-01", "2100-12-31", "100"), (12, "2024-01-01", "2024-03-14", "7"), (13, "2024-01-01", "2100-12-31", "3"),
    ]
    return {
        "journal_changes": spark.createDataFrame(
            [(c, d, i, at(p), at(p), b, D(x), D(a), D(x), D(a), t, n, at(p).date()) for c, d, i, p, b, x, a, t, n in changes],
            "collection_id bigint, doc_id bigint, id bigint, posted_at timestamp, stamped_at timestamp, is_debit boolean, "
            f"in_balance {money}, amount {money}, in_balance_rub {money}, amount_rub {money}, txn_ts int, txn_id int, dt date"),
        "legacy_balance": spark.createDataFrame(
            [(a, day(f), day(t), day("2100-12-31"), *[D(x) for x in (o, "0", "0", o)] * 2, True) for a, f, t, o in legacy],
            "account_id bigint, effective_from date, effective_to date, valid_to_date date, "
            + ", ".join(f"{c} {money}" for c in ["in_amount", "debit_amount", "credit_amount", "out_amount", "in_currency_amount",
                                                 "debit_currency_amount", "credit_currency_amount", "out_currency_amount"])
            + ", closed_date_flag boolean"),
        "op_day": spark.createDataFrame([(day("2024-03-05"), 3), (day("2024-03-05"), 1), (day("2024-03-10"), 1)], "op_day date, day_status int"),
        "ledger_account": spark.createDataFrame(
            [(10 + c, c, f"4070281050000000000{c}") for c in (1, 2, 3)], "account_id bigint, collection_id bigint, account_number string"),
    }


@pytest.mark.parametrize("on, expected", [
    # before any movement the former balance stands
    ("2024-03-04", {11: ("100", "100", "0", "0"), 12: ("7", "7", "0", "0"), 13: ("3", "3", "0", "0")}),
    # a day with both signs shows its own opening balance and turnover
    ("2024-03-05", {11: ("100", "70", "-40", "10"), 12: ("7", "7", "0", "0"), 13: ("3", "3", "0", "0")}),
    # a quiet day carries the closing balance
    ("2024-03-07", {11: ("70", "70", "0", "0"), 12: ("7", "7", "0", "0"), 13: ("3", "3", "0", "0")}),
    # an unflagged row is a credit
    ("2024-03-10", {11: ("70", "75", "0", "5"), 12: ("7", "7", "0", "0"), 13: ("3", "3", "0", "0")}),
    # the newer version of document 4 counts; account 12 moves for the first time; its former row ended
    ("2024-03-15", {11: ("105", "105", "0", "0"), 12: ("0", "-20", "-20", "0"), 13: ("3", "3", "0", "0")}),
])
def test_turnover(ledger, on, expected):
    got = {r.account_id: (r.in_amount, r.out_amount, r.debit_amount, r.credit_amount)
           for r in turnover(ledger, day(on), CUTOVER).collect()}
    assert got == {k: tuple(D(x) for x in v) for k, v in expected.items()}


def test_turnover_of_a_day_is_the_interval_that_holds_it(ledger):
    intervals = balance_intervals(ledger, day("2024-03-20"), CUTOVER)
    for offset in (0, 4, 5, 6, 9, 11, 14, 15):
        on = day("2024-03-01") + timedelta(days=offset)
        held = valid_on(intervals, on, "effective_from", "effective_to")
        assert rows(held, "account_id", "out_amount") == rows(turnover(ledger, on, CUTOVER), "account_id", "out_amount")
        assert held.groupBy("account_id").count().where("count > 1").count() == 0


def test_turnover_for_dates_is_the_turnover_of_each(ledger):
    days = [day("2024-03-01") + timedelta(days=k) for k in (0, 4, 9, 14)]
    together = turnover_for_dates(ledger, days, CUTOVER)
    apart = [r for d in days for r in rows(turnover(ledger, d, CUTOVER))]
    assert sorted(rows(together), key=str) == sorted(apart, key=str)


def test_balances_chain_and_day_status(ledger):
    new = balance_intervals(ledger, day("2024-03-20"), CUTOVER).where(F.col("effective_from") >= F.lit(CUTOVER))
    one = rows(new.where("account_id = 11"), "effective_from", "in_amount", "out_amount", "closed_date_flag")
    assert all(later[1] == earlier[2] for earlier, later in zip(one, one[1:]))  # in = previous out
    assert [r[3] for r in one] == [True, False, False]


def test_overlap_keeps_the_stored_interval(ledger):
    on = day("2024-03-07")
    assert turnover(ledger, on, CUTOVER, overlap=True).where("account_id = 11").count() == 2
    assert turnover(ledger, on, CUTOVER).where("account_id = 11").count() == 1


# -- red balances ------------------------------------------------------------------------------

def test_red_balance_at_every_threshold(spark):
    sizes = ["-10000000", "-9999999.99", "-1000000", "-999999.99", "-100000", "-99999.99", "0", "99999.99", "100000", "10000000", None]
    codes = ["А", "П", "АП"]
    data = [(i * 100 + j, D(x) if x else None) for i, _ in enumerate(codes) for j, x in enumerate(sizes)]
    balances = spark.createDataFrame(data, "account_id int, out_amount decimal(18,2)").selectExpr(
        "account_id", "out_amount", "DATE'2024-03-15' AS balance_date", "'40702' AS second_order_account_number",
        "concat('acc', account_id) AS account_number", "0 AS debit_amount", "0 AS credit_amount")
    accounts = balances.selectExpr("account_id", "account_id div 100 AS type_id", "if(account_id < 5, 1, 9) AS user_id")
    types = spark.createDataFrame(list(enumerate(codes)), "type_id long, type_code string")
    users = spark.createDataFrame([(1, "someone")], "user_id int, user_name string")
    found = violations(balances, accounts, types, users)
    assert found.count() == len(data)  # accounts without a responsible user stay
    got = rows(found.where("violation_type <> 'COMPLIANT'"), "acc_type_code", "violation_type", "severity_level", "out_amount")
    critical, high, medium, low = fv.CRITICAL, fv.HIGH, fv.MEDIUM, fv.LOW
    active = [(fv.ACTIVE, "RED_BALANCE_ACTIVE", s, D(x)) for s, x in
              [(critical, "-10000000"), (high, "-9999999.99"), (high, "-1000000"), (medium, "-999999.99"), (medium, "-100000"), (low, "-99999.99")]]
    passive = [(fv.PASSIVE, "RED_BALANCE_PASSIVE", s, D(x)) for s, x in [(low, "99999.99"), (medium, "100000"), (critical, "10000000")]]
    mixed = [(fv.MIXED, "NON_ZERO_ACTIVE_PASSIVE", medium, D(x)) for x in sizes if x not in ("0", None)]
    assert sorted(map(str, got)) == sorted(str((a, b, c, x.quantize(D("0.01")))) for a, b, c, x in active + passive + mixed)

    report = red_balance(balances, accounts, types, users).collect()
    assert [r.section_name for r in report] == (
        [fv.SECTIONS[fv.MIXED]] * 9 + [fv.SECTIONS[fv.ACTIVE]] * 6 + [fv.SECTIONS[fv.PASSIVE]] * 3)
    assert [r.severity_level for r in report][9:] == [critical, high, high, medium, medium, low, critical, medium, low]
    summary = {r.acc_type_code: (r.account_type_name, r.total_violations, r.critical_count, r.high_count, r.medium_count)
               for r in red_summary(found).collect()}
    assert summary == {fv.ACTIVE: ("Активные", 6, 1, 2, 2), fv.PASSIVE: ("Пассивные", 3, 1, 0, 1), fv.MIXED: ("Активно-пассивные", 9, 0, 0, 9)}


def test_class_codes_are_cyrillic_and_active_has_a_section():
    assert [ord(c) for c in fv.ACTIVE + fv.PASSIVE + fv.MIXED] == [0x410, 0x41F, 0x410, 0x41F]
    assert fv.ACTIVE in fv.SECTIONS


# -- agreements --------------------------------------------------------------------------------

def test_agreements_classes(spark):
    def frame(data, opened, closed):
        return spark.createDataFrame([(n, o and day(o), c and day(c)) for n, o, c in data], f"agr_number string, {opened} date, {closed} date")

    d, e, x, y = "2024-03-15", "2024-03-14", "2024-12-01", "2024-12-02"
    products = frame([("ag1", d, None), ("ag2", d, x), ("ag3", d, x), ("ag4", d, x), ("ag5", e, x), ("ag6", e, x), ("ag7", d, None)],
                     "open_date", "close_date")
    internal = frame([("ag1", e, y), ("ag8", d, None), ("zz9", d, None)], "open_date", "close_date")
    agreements = frame([("ag2", d, x), ("ag3", e, y), ("ag4", d, y), ("ag5", d, x), ("ag6", e, y), ("ag7", d, x), ("b1", d, None), ("b2", e, None)],
                       "signature_date", "closing_date")
    got = agreements_check(products, internal, agreements, day(d))
    expected = [("close_date_differs", "ag4"), ("missing_in_a", "b1"), ("missing_in_b", "ag1"), ("missing_in_b", "ag8"),
                ("open_date_differs", "ag3"), ("open_date_differs", "ag5")]
    assert rows(got, "error_name", "agr_number") == expected
    assert rows(got.where("agr_number = 'ag1'"), "a_close_date") == [(day(y),)]  # filled from the internal product
    safe = agreements_check(products, internal, agreements, day(d), null_safe=True)
    assert rows(safe, "error_name", "agr_number") == sorted([*expected, ("close_date_differs", "ag7")])


# -- payments ----------------------------------------------------------------------------------

@pytest.mark.parametrize("as_of, out_balance, paid", [
    ("2024-03-13", "90", "25"),   # Wednesday: postings of Tuesday
    ("2024-03-18", "140", "0"),   # Monday: Friday to Sunday together
])
def test_payments_follow_the_working_days(spark, as_of, out_balance, paid):
    money = "decimal(18,2)"
    journal = [("2024-03-12 09:00", 1, False, "100", "20"), ("2024-03-12 10:00", 2, True, "120", "30"),
               ("2024-03-15 09:00", 3, False, "90", "10"), ("2024-03-17 09:00", 4, False, "100", "40"),
               ("2024-03-18 09:00", 5, False, "140", "1000")]
    documents = [("1", "2024-03-13 11:00", "30232810", "407028", "11451550", "PROV", "25", 1),
                 ("2", "2024-03-13 11:00", "30232810", "407028", "1916953", "PROV", "500", 1),   # kind of the other account
                 ("3", "2024-03-13 11:00", "30232810", "301018", "1916953", "DELETED", "600", 1),
                 ("4", "2024-03-13 11:00", "30232810", "301018", "1916953", "PROV", "700", 1),
                 ("4", "2024-03-14 11:00", "30232810", "301018", "1916953", "PROV", "800", 2)]   # newer version, next day
    one = {
        "journal_changes": spark.createDataFrame(
            [(i, 1, i, at(p), b, D(x), D(a), 1, i, at(p).date()) for p, i, b, x, a in journal],
            f"doc_id int, collection_id int, id int, posted_at timestamp, is_debit boolean, in_balance_rub {money}, amount_rub {money}, "
            "txn_ts int, txn_id int, dt date"),
        "document_changes": spark.createDataFrame(
            [(i, at(p), dt, kt, k, s, D(a), 77, v, v, day("2024-03-13")) for i, p, dt, kt, k, s, a, v in documents],
            f"id string, document_date timestamp, debit_number string, credit_number string, kind string, state string, amount {money}, "
            "debit_account_id int, txn_ts int, txn_id int, dt date"),
        "calendar": spark.sql("SELECT d AS calendar_date, dayofweek(d) IN (1, 7) AS holiday_flag FROM "
                              "(SELECT explode(sequence(DATE'2024-03-01', DATE'2024-03-31')) AS d)"),
        "ledger_account": spark.createDataFrame([(77, 1, "30232810500000000001"), (78, 2, "40702810500000000001")],
                                                "account_id int, collection_id int, account_number string"),
        "merchant_contract": spark.createDataFrame([("C-1", 5, 1, 1), ("C-2", 6, 1, 1)],
                                                   "agreement_number string, account_link int, client_id int, agreement_type_id int"),
        "contract_account": spark.createDataFrame([(5, 77), (6, 78)], "account_link int, account_id int"),
        "client": spark.createDataFrame([(1, "client")], "client_id int, client_name string"),
        "agreement_type": spark.createDataFrame([(2, "other")], "agreement_type_id int, agreement_type string"),
    }
    assert rows(payments_check(one, day(as_of))) == [
        ("C-1", "client", None, "30232810500000000001", D(out_balance), D(paid), D(paid) - D(out_balance))]
