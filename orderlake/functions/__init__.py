"""Column-level building blocks shared by batch and streaming operators."""

from orderlake.functions.money import money, rate, net_amount, gross_amount, discount_amount, tax_amount, present_money
from orderlake.functions.text import standardise_col, blank_to_null
from orderlake.functions.dates import parse_date_multi, to_event_time, from_event_time, date_key
from orderlake.functions.rules import Rule

__all__ = [
    "money", "rate", "net_amount", "gross_amount", "discount_amount", "tax_amount", "present_money",
    "standardise_col", "blank_to_null", "parse_date_multi", "to_event_time", "from_event_time",
    "date_key", "Rule",
]
