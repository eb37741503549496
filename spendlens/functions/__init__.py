from .columns import (
    flag, flags_by, label_by, labels_by, mean_of, money, money_when, safe_div, share_of, spread, sql_text, squared, sum_money,
    sum_money_widely, tier_by, typed_money, units)
from .text import any_of, clean_text, clean_text_basic, constant, matching, required_literals

__all__ = [
    "any_of", "clean_text", "clean_text_basic", "constant", "flag", "flags_by", "label_by", "labels_by", "matching",
    "mean_of", "money", "money_when", "required_literals", "safe_div", "share_of", "spread", "sql_text", "squared", "sum_money",
    "sum_money_widely", "tier_by", "typed_money", "units",
]
