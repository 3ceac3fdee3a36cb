"""Column-expression helpers shared by all operators (built-in functions only)."""

from .dates import GRAINS, month_index, period_start, period_step
from .money import AMOUNT, TOTAL, line_revenue, money_sum
from .ratios import ratio

__all__ = [
    "AMOUNT", "TOTAL", "GRAINS", "line_revenue", "money_sum", "month_index",
    "period_start", "period_step", "ratio",
]
