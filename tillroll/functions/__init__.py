from .columns import (all_not_null, compare, date_parts, full_name, margin_pct,
                      standardise_domain, try_cast_to)
from .money import (dow_sunday0, dow_sunday1, exact, exact_avg, exact_parts, exact_sum, millionths, money_round,
                    money_sum, month_trunc, odd, parts_rounded, parts_value, pct, rounded, safe_divide, sum_parts)

__all__ = [
    "all_not_null", "compare", "date_parts", "dow_sunday0", "dow_sunday1",
    "exact", "exact_avg", "exact_parts", "exact_sum",
    "full_name", "margin_pct", "millionths", "money_round", "money_sum", "month_trunc", "odd",
    "parts_rounded", "parts_value", "pct", "rounded",
    "safe_divide", "standardise_domain", "sum_parts", "try_cast_to",
]
