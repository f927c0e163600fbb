"""Calendar generator (S7) and date bounds."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paydw.functions.calendar import calendar_columns


def date_bounds(df: DataFrame, date_col: str = "data_movimentacao") -> DataFrame:
    """One row (first_day, last_day): a global min/max aggregate, not sort + take."""
    d = F.col(date_col)
    return df.agg(F.min(d).alias("first_day"), F.max(d).alias("last_day"))


def calendar(df: DataFrame, date_col: str = "data_movimentacao",
             end_date: str | _dt.date | None = "today") -> DataFrame:
    """``dim_tempo`` rows from the first day of ``df`` to ``end_date``.

    ``end_date``: ``"today"`` (the reference behaviour), ``"last"`` (last day
    of the data) or an explicit date. One lazy plan: a global min/max
    aggregate followed by ``explode(sequence(...))``; the result has one row
    per day, so its size is bounded by the length of the period, not by the
    data volume.
    """
    b = date_bounds(df, date_col)
    if end_date == "today":
        end = F.current_date()
    elif end_date == "last":
        end = F.col("last_day")
    else:
        end = F.lit(str(end_date)).cast("date")
    days = b.where(F.col("first_day").isNotNull() & (F.col("first_day") <= end)).select(
        F.explode(F.sequence(F.col("first_day"), end, F.expr("INTERVAL 1 DAY"))).alias("data")
    )
    attrs = calendar_columns(F.col("data"))
    return days.select("data", *[c.cast("int").alias(n) for n, c in attrs.items()])
