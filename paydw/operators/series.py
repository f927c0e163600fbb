"""Ordered-series operators on keyed daily series.

Every operator takes ``keys`` so that many series are processed in one
job: a window partitioned by the keys sorts each series inside one task.
A series holds one row per day, so a partition is bounded by the length of
the period, whatever the data volume.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _w(keys, order):
    w = Window.partitionBy(*keys) if keys else Window.partitionBy()
    return w.orderBy(*[F.col(o) for o in ([order] if isinstance(order, str) else order)])


def moving_average(df: DataFrame, keys: list[str], order: str, cols: list[str],
                   window: int = 5, suffix: str = "_media_movel") -> DataFrame:
    """Trailing mean over the last ``window`` rows, partial at the start (min_periods=1)."""
    w = _w(keys, order).rowsBetween(-(window - 1), Window.currentRow)
    return df.withColumns({f"{c}{suffix}": F.avg(F.col(c)).over(w) for c in cols})


def use_gaps(df: DataFrame, keys: list[str], date_col: str) -> DataFrame:
    """Per key and use day: the previous use day and the number of idle days between."""
    w = _w(keys, date_col)
    prev = F.lag(F.col(date_col)).over(w)
    return (df.withColumn("dia_anterior", prev)
              .withColumn("dias_sem_uso", F.datediff(F.col(date_col), F.col("dia_anterior")) - 1))


def streaks(df: DataFrame, keys: list[str], date_col: str) -> DataFrame:
    """Runs of days with and without a row per key: ``(keys..., uso, primeiro_dia, ultimo_dia, dias)``.

    ``df`` has one row a key and day. Islands: a day minus its place among the
    key's days is the same for all days of a run. Idle runs are what lies
    between two runs of use; days before the first and after the last are none.
    Null days are left out. Partitioned by the keys beforehand, all windows share it.
    """
    at = F.col(date_col)
    days = df.where(at.isNotNull()).select(*keys, at, F.date_sub(at, F.row_number().over(_w(keys, date_col))).alias("_island"))
    used = days.groupBy(*keys, "_island").agg(F.min(at).alias("primeiro_dia"), F.max(at).alias("ultimo_dia"))
    before = F.lag("ultimo_dia").over(_w(keys, "primeiro_dia"))
    run = lambda uso, first, last: F.struct(F.lit(uso).alias("uso"), first.alias("primeiro_dia"), last.alias("ultimo_dia"))
    both = used.withColumn("_before", before).select(*keys, F.explode(F.array_compact(F.array(
        run(True, F.col("primeiro_dia"), F.col("ultimo_dia")),
        F.when(F.col("_before").isNotNull(), run(False, F.date_add("_before", 1), F.date_sub("primeiro_dia", 1)))))).alias("_r"))
    return both.select(*keys, "_r.*").withColumn("dias", F.datediff("ultimo_dia", "primeiro_dia") + 1)


def split_halves(df: DataFrame, keys: list[str], order: str, overlap: bool = True) -> DataFrame:
    """Positional halving: train = rows [0 .. n//2], test = rows [n//2 .. n-1].

    With ``overlap`` (the reference's slicing) row n//2 is in both sets and
    appears twice, once per ``conjunto``. Adds ``posicao`` (0-based) and ``n``.
    """
    w = _w(keys, order)
    wn = Window.partitionBy(*keys) if keys else Window.partitionBy()
    pos = (F.row_number().over(w) - 1).alias("posicao")
    x = df.select("*", pos, F.count(F.lit(1)).over(wn).alias("n"))
    half = F.floor(F.col("n") / 2)
    train_end = half if overlap else half - 1
    sets = F.array_compact(F.array(
        F.when(F.col("posicao") <= train_end, F.lit("treino")),
        F.when(F.col("posicao") >= half, F.lit("teste")),
    ))
    return x.withColumn("conjunto", F.explode(sets))


def pivot_types(df: DataFrame, keys: list[str], type_col: str, value_col: str,
                types: list[str], agg: str = "sum") -> DataFrame:
    """Long -> wide: one column per type (values given, so no extra job to find them)."""
    fn = {"sum": F.sum, "count": F.count}[agg]
    out = df.groupBy(*keys).pivot(type_col, list(types)).agg(fn(F.col(value_col)))
    return out.fillna(0, subset=list(types))
