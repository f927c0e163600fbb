"""Column expressions shared by the jobs (all built-in Spark functions)."""

from paydw.functions.calendar import calendar_columns, month_ref, is_weekend, is_sunday
from paydw.functions.money import amount, as_double, revenue_amount

__all__ = [
    "calendar_columns", "month_ref", "is_weekend", "is_sunday",
    "amount", "as_double", "revenue_amount",
]
