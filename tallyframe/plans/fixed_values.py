"""Codes, account patterns and texts the source systems use.

They must match the data, so they stand here as plain text in one place.
"""

# act lines: type -> column of the act
ACT_COLUMNS = {
    "debt_bank_start": "start_debt_bank_amount",
    "debt_client_start": "start_debt_client_amount",
    "debits": "purchases_amount",
    "credits": "refunds_amount",
    "disp": "dispute_debit_amount",
    "disp_cr": "dispute_credit_amount",
    "fee": "fee_amount",
    "reimb": "transfer_amount",
    "fixloan": "fix_loan_amount",
    "debt_client_end": "end_debt_client_amount",
    "debt_bank_end": "end_debt_bank_amount",
}
ACT_PLUS = [
    "start_debt_bank_amount", "purchases_amount", "dispute_credit_amount", "fix_loan_amount",
    "end_debt_client_amount",
]
ACT_MINUS = [
    "end_debt_bank_amount", "refunds_amount", "dispute_debit_amount", "fee_amount", "transfer_amount",
    "start_debt_client_amount",
]

# transactions
FINANCIAL_CLASS = "F"
REVERSAL = "R"
DEBIT_CODES = ["purchase", "c2b"]
CREDIT_CODES = ["refund", "b2c"]
REIMBURSEMENT_CODES = ["purchaseReimb", "negativeReimb"]
DISPUTE_CODES = ("C2BDISPUTE_DEBIT", "C2BDISPUTE_CREDIT")
ADJUSTMENT_CODES = ("adjDebit", "adjCredit")

# documents
POSTED_STATE = "PROV"
EXCLUDED_STATES = ["ISNULL", "TO_RETURN", "DELETED", "VOZV"]
TRANSFER_PURPOSES = [
    "Переводы физических лиц согласно Реестру%",
    "Переводы физических лиц с использованием СБП согласно  Реестру%",
]
REIMBURSEMENT_PURPOSE = "Возмещение ден.средств по операциям эквайринга по Реестру%"
FIXLOAN_PURPOSE = "Исполнение нетто-требований%"
PAYMENT_KINDS = {"301%": "1916953", "407%": "11451550"}  # credit account -> document kind

# account numbers
BANK_DEBT_PREFIX = "30232"
CLIENT_DEBT_PREFIX = "30233"
REIMB_DEBIT_PATTERN = "30232810_1%"
DEBT_ACCOUNT_PATTERN = "3023_810_1%"
FIXLOAN_DEBIT_PATTERN = "4070%"
RETIRED_ACCOUNT = "R"

# agreements
MERCHANT_AGREEMENT_CLASS = "A"
INTERNAL_PRODUCT_PATTERN = "ag%"

# operating day
DAY_CLOSED = 3

# account classes (Cyrillic letters)
ACTIVE, PASSIVE, MIXED = "А", "П", "АП"
CLASS_NAMES = {ACTIVE: "Активные", PASSIVE: "Пассивные", MIXED: "Активно-пассивные"}
SECTIONS = {
    MIXED: "АКТИВНО-ПАССИВНЫЕ СЧЕТА",
    ACTIVE: "АКТИВНЫЕ СЧЕТА",
    PASSIVE: "ПАССИВНЫЕ СЧЕТА",
}
CRITICAL, HIGH, MEDIUM, LOW = "КРИТИЧЕСКОЕ", "ВЫСОКОЕ", "СРЕДНЕЕ", "НИЗКОЕ"
SEVERITY_FROM = {CRITICAL: 10_000_000, HIGH: 1_000_000, MEDIUM: 100_000}
VIOLATIONS = {
    "RED_BALANCE_ACTIVE": "Недопустимое кредитовое сальдо на активном счете",
    "RED_BALANCE_PASSIVE": "Недопустимое дебетовое сальдо на пассивном счете",
    "NON_ZERO_ACTIVE_PASSIVE": "Остаток должен быть нулевым",
}
COMPLIANT = "COMPLIANT"

# act columns as people read them
ACT_LABELS = {
    "agr_number": "Номер договора",
    "merchant": "ЮЛ",
    "start_debt_bank_amount": "Задолженность Банка на начало отчетного периода составила",
    "start_debt_client_amount": "Задолженность Клиента на начало отчетного периода составила",
    "purchases_amount": "Общая сумма авторизованных операций за отчетный период (руб.)",
    "refunds_amount": "Общая сумма операций возврата/отмены Платежей, произведенных в отчетном периоде (руб.)",
    "dispute_debit_amount": "Сумма операций Chargeback по картам в отчетный период (списание) (руб.)",
    "dispute_credit_amount": "Сумма операций Chargeback по картам в отчетный период (зачисление) (руб.)",
    "fee_amount": "Комиссионное вознаграждение Банка за отчетный период (руб.)",
    "transfer_amount": "Сумма перечисленных денежных средств в пользу Клиента за отчетный период (руб.)",
    "fix_loan_amount": "Сумма погашенной задолженности Клиента перед Банком за отчетный период (руб.)",
    "end_debt_client_amount": "Задолженность Клиента на конец отчетного периода составила",
    "end_debt_bank_amount": "Задолженность Банка на конец отчетного периода составила",
    "condition": "Сумма сошлась",
}
