"""Relational and time-series operators (DataFrame in, DataFrame out)."""

from paydw.operators.acf import acf, acf_first_lag, durbin_levinson, pacf, pacf_first_lag
from paydw.operators.contracts import latest_contracts, resolve_contract
from paydw.operators.densify import day_grid, densify
from paydw.operators.merge import insert_only_merge, new_rows, read_table
from paydw.operators.series import moving_average, pivot_types, split_halves, use_gaps
from paydw.operators.summary import daily_summary
from paydw.operators.trend import trend_extrapolate, trend_fit, trend_predict, trend_summary

__all__ = [
    "acf", "acf_first_lag", "durbin_levinson", "pacf", "pacf_first_lag",
    "latest_contracts", "resolve_contract", "day_grid", "densify",
    "insert_only_merge", "new_rows", "read_table",
    "moving_average", "pivot_types", "split_halves", "use_gaps", "daily_summary",
    "trend_extrapolate", "trend_fit", "trend_predict", "trend_summary",
]
