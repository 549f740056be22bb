from .dates import month_bounds, report_dates
from .ids import account_class, norm_id, to_flag
from .money import apply_mask, money, money_round, signed
from .rules import classify, map_value
from .text import explode_json_array, json_field, json_fields, render, safe_name

__all__ = [
    "account_class", "apply_mask", "classify", "explode_json_array", "json_field", "json_fields", "map_value",
    "money", "money_round", "month_bounds", "norm_id", "render", "report_dates", "safe_name",
    "signed", "to_flag",
]
