"""The registered reports and their columns.

Kinds, masks and labels are fixed values; the column names are neutral names of our own. Columns of two
compared systems are named a_* and b_*. For all but ``agreements`` and
``merchants_payments`` only these columns are known; the rules that fill them
(plans.schema_only) are our reading of them.
"""

from .contracts import Contract, amount, day, text

CONTRACTS = {
    c.name: c
    for c in [
        Contract("document_messages", (
            day("check_date", "Дата сверки"), day("document_date", "Дата документа"),
            text("document_num", "Номер документа"), amount("document_sum", "Сумма документа"),
            text("payer_account", "Счет плательщика"), text("recipient_account", "Счет получателя"),
            text("payment_purpose", "Назначение платежа"), text("message_id"),
            text("diff_type", "Тип ошибки"),
        )),
        Contract("account_statuses", (
            text("a_account", "Лицевой счет (A)"), text("b_account", "Лицевой счет (B)"),
            day("a_date_open", "Дата открытия счета (A)"), day("b_date_open", "Дата открытия счета (B)"),
            day("a_date_close", "Дата закрытия счета (A)"), day("b_date_close", "Дата закрытия счета (B)"),
            text("a_status", "Статус счета (A)"), text("b_status", "Статус счета (B)"),
            text("error_name", "Описание расхождения"),
        )),
        Contract("acquiring_totals", (
            amount("payments_a", "Сумма платежей (A)"), amount("refunds_a", "Сумма возвратов (A)"),
            amount("payments_b", "Сумма платежей (B)"), amount("refunds_b", "Сумма возвратов (B)"),
            amount("refunds_diff", "Разница между возвратами"),
            amount("payments_diff", "Разница между платежами"),
        )),
        Contract("agreements", (
            text("error_name", "Название ошибки"), text("agr_number", "Номер договора"),
            day("a_open_date", "Дата открытия договора (A)"), day("b_open_date", "Дата открытия договора (B)"),
            day("a_close_date", "Дата закрытия договора (A)"), day("b_close_date", "Дата закрытия договора (B)"),
        )),
        Contract("auto_funding", (
            text("number", "Номер"), text("buid"),
            day("a_start_date", "Дата начала (A)"), day("b_start_date", "Дата начала (B)"),
            day("a_end_date", "Дата окончания (A)"), day("b_end_date", "Дата окончания (B)"),
        )),
        Contract("merchants_monthly", (
            text("ttype", "Тип"), text("agr_number", "Номер договора"), amount("amount_a", "Сумма (A)"),
            text("acc"), amount("amount_b", "Сумма (B)"), amount("diff", "Разность"),
        )),
        Contract("merchants_payments", (
            text("agreement_number", "Номер договора"), text("client_name", "Наименование клиента"),
            text("agreement_type", "Тип договора"), text("account_number", "Номер счета"),
            amount("out_balance_amount"), amount("payment_documents_amount"),
            amount("diff_amount", "Объем расхождений"),
        )),
        Contract("card_transactions", (
            day("report_date", "Дата отчёта"), text("report_name", "Наименование отчёта"),
            text("error_name", "Наименование ошибки"), day("banking_date", "Дата транзакции"),
            text("debit_account_number"), text("credit_account_number"), text("orig_system", "Система"),
            text("ttype", "Тип транзакции"), text("direction", "Направление"),
            text("t_direction", "Тип направления"), amount("amount", "Сумма операции"),
            amount("sum_settl_amount", "sum(settl_amount)"), amount("sum_c_sum", "sum(c_sum)"),
            amount("sum_amount_rrn", "sum(settl_amount_rrn)"), amount("sum_nazn_rrn", "sum(sum_nazn_rrn)"),
            amount("sum_sum_rrn", "sum(sum_rrn)"), text("agr_number", "Номер договора"),
            text("rrn", "RRN"), text("acq_ref_number", "ARN"), text("trace_ref_number", "TRN"),
        )),
        Contract("credit_transactions", (
            day("report_date", "Дата отчета"), text("report_name", "Наименование отчёта"),
            text("error_name", "Наименование ошибки"), day("txn_date", "Дата транзакции"),
            text("debit_account_number"), text("credit_account_number"), text("ttype", "Тип транзакции"),
            text("direction", "Направление"), text("t_direction", "Тип направления"),
            amount("amount", "Сумма операции"), amount("sum_settl_amount"), amount("sum_c_sum"),
            amount("sum_settl_amount_rrn"), amount("sum_sum_nazn_rrn"), amount("sum_sum_rrn"),
            text("agr_number", "Номер договора"), text("rrn", "RRN"), text("acq_ref_number", "ARN"),
            text("trace_ref_number", "TRN"),
        )),
        Contract("fake_clears", (
            text("error_name", "Наименование ошибки"), day("banking_date", "Дата транзакции"),
            text("trace_ref_number", "TRN"), text("ret_ref_number", "RRN"), text("ttype", "Тип транзакции"),
            amount("amount", "Сумма операции"),
        )),
        Contract("transaction_duplicates", (
            text("report_name", "Наименование отчёта"), day("banking_date", "Дата транзакции"),
            text("ttype", "Тип транзакции"), amount("amount", "Сумма операции"),
            text("ret_ref_number", "RRN"), text("trace_ref_number", "TRN"), text("acq_ref_number", "ARN"),
            text("purpose", "Назначение платежа"), text("root_txn_id"),
        )),
    ]
}
