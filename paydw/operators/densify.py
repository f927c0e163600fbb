"""Dense day axes with zero fill.

A grid of keys x days is generated with ``explode(sequence(...))`` next to
each key (no cross join), then the facts are left-joined to it and missing
measures become 0. The axis is either explicit (``start``/``end``), global
(the min/max day of the data, two scalars) or per key (each key's own first
to last day, the default: it never emits days outside a key's life).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _days(start, end):
    return F.explode(F.sequence(start, end, F.expr("INTERVAL 1 DAY")))


def day_grid(df: DataFrame, keys: list[str], date_col: str, *, start=None, end=None,
             axis: str = "per_key") -> DataFrame:
    """Rows (keys..., date_col) covering every day of the chosen axis."""
    keys = list(keys)
    if start is not None and end is not None:
        s, e = F.lit(str(start)).cast("date"), F.lit(str(end)).cast("date")
        base = df.select(*keys).distinct() if keys else df.sparkSession.range(1).select()
        return base.select(*keys, _days(s, e).alias(date_col))
    if axis == "global":
        b = df.agg(F.min(date_col).alias("s"), F.max(date_col).alias("e")).first()
        if b is None or b["s"] is None:
            return df.select(*keys, F.col(date_col)).where(F.lit(False))  # no data: empty axis
        return day_grid(df, keys, date_col, start=b["s"], end=b["e"])
    if not keys:
        raise ValueError("per_key axis needs keys")
    bounds = df.groupBy(*keys).agg(F.min(date_col).alias("_s"), F.max(date_col).alias("_e"))
    return bounds.select(*keys, _days(F.col("_s"), F.col("_e")).alias(date_col))


def densify(df: DataFrame, keys: list[str], date_col: str, measures: list[str], *,
            start=None, end=None, axis: str = "per_key") -> DataFrame:
    """``df`` (one row per key and day) on a dense day axis; missing measures are 0."""
    keys = list(keys)
    grid = day_grid(df, keys, date_col, start=start, end=end, axis=axis)
    facts = df.select(*keys, date_col, *measures)
    if start is not None and end is not None:
        d = F.col(date_col)
        facts = facts.where((d >= F.lit(str(start)).cast("date")) & (d <= F.lit(str(end)).cast("date")))
    out = grid.join(facts, keys + [date_col], "left")
    return out.select(*keys, date_col,
                      *[F.coalesce(F.col(m), F.lit(0).cast(df.schema[m].dataType)).alias(m)
                        for m in measures])
