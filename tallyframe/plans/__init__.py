from .acts import ACT_FAMILIES, act_data, act_details, act_final, open_agreements, unmatched_documents
from .agreements import agreements_check
from .calendar import calendar_of, next_workday
from .payments import payments_check
from .red_balance import red_balance, red_summary, violations
from .turnover import balance_intervals, turnover, turnover_for_dates

__all__ = [
    "ACT_FAMILIES", "act_data", "act_details", "act_final", "agreements_check", "balance_intervals",
    "calendar_of", "next_workday", "open_agreements", "payments_check", "red_balance", "red_summary",
    "turnover", "turnover_for_dates", "unmatched_documents", "violations",
]
