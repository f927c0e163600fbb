"""Trend families (T1-T9): every family is one keyed fit, not one job per series."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paydw.functions.calendar import month_ref
from paydw.operators.trend import (residual_summary, trend_extrapolate, trend_from_sums, trend_predict, trend_summary,
                                   trend_sums)
from paydw.plans.revenue import revenue_day
from paydw.plans.segments import segment_day_dense
from paydw.plans.warehouse import Warehouse

SERIES = ("boleto", "payin", "payout", "total")


def _stack(df: DataFrame, cols: dict[str, str], date_col: str) -> DataFrame:
    pairs = ", ".join(f"'{k}', `{v}`" for k, v in cols.items())
    return df.select(F.col(date_col).alias("data_movimentacao"),
                     F.expr(f"stack({len(cols)}, {pairs}) AS (serie, valor)"))


def value_type_series(wh: Warehouse, daily: DataFrame | None = None) -> DataFrame:
    """(serie, day, value moved) for boleto, payin, payout and their total (T5 input).

    ``daily``: a prepared ``revenue_day`` (e.g. materialized once for all the
    type trends); computed from the warehouse when None.
    """
    cols = {s: (f"total_{s}" if s != "total" else "total") for s in SERIES}
    return _stack(revenue_day(wh) if daily is None else daily, cols, "data")


def revenue_type_series(wh: Warehouse, daily: DataFrame | None = None) -> DataFrame:
    """(serie, day, revenue) per type and total (T6 input)."""
    return _stack(revenue_day(wh) if daily is None else daily, {s: f"faturamento_{s}" for s in SERIES}, "data")


def segment_series(wh: Warehouse, measure: str, dense: DataFrame | None = None) -> DataFrame:
    """(serie = segment, day, measure) on the dense global axis (T7-T9 input).

    ``dense``: a prepared ``segment_day_dense`` (e.g. materialized once for
    several trend families); computed from the warehouse when None.
    """
    d = segment_day_dense(wh) if dense is None else dense
    return d.select(F.col("segmento").alias("serie"), "data_movimentacao",
                    F.col(measure).cast("double").alias("valor"))


# Decimals reported for (slope, intercept, rmse): counts are small numbers, money large.
DIGITS = {"count": (10, 8, 6), "money": (6, 4, 2)}


def _report(fit: DataFrame, kind: str) -> DataFrame:
    ds, di, dr = DIGITS[kind]
    return fit.select(
        "serie", F.col("n").cast("long").alias("n"),
        F.round("slope", ds).alias("inclinacao_dia"),
        F.round("intercept", di).alias("intercepto"),
        F.round("r2", 8).alias("r2"),
        F.round("rmse", dr).alias("rmse"))


def trend_value_type(wh: Warehouse, daily: DataFrame | None = None) -> DataFrame:
    return _report(trend_summary(value_type_series(wh, daily), ["serie"], "data_movimentacao", "valor"),
                   "money")


def trend_revenue_type(wh: Warehouse, daily: DataFrame | None = None) -> DataFrame:
    return _report(trend_summary(revenue_type_series(wh, daily), ["serie"], "data_movimentacao", "valor"),
                   "money")


def trend_segment_count(wh: Warehouse, dense: DataFrame | None = None) -> DataFrame:
    s = segment_series(wh, "quantidade_movimentacoes", dense)
    return _report(trend_summary(s, ["serie"], "data_movimentacao", "valor"), "count")


def trend_segment_value(wh: Warehouse, dense: DataFrame | None = None) -> DataFrame:
    s = segment_series(wh, "total_movimentacao", dense)
    return _report(trend_summary(s, ["serie"], "data_movimentacao", "valor"), "money")


def trend_segment_revenue(wh: Warehouse, dense: DataFrame | None = None) -> DataFrame:
    s = segment_series(wh, "faturamento", dense)
    return _report(trend_summary(s, ["serie"], "data_movimentacao", "valor"), "money")


def trend_extrapolate_value(wh: Warehouse, dias: int = 30, start_offset: int = 0,
                            daily: DataFrame | None = None) -> DataFrame:
    """``dias`` days of each value-type trend from its last observed day (T4)."""
    fit = trend_summary(value_type_series(wh, daily), ["serie"], "data_movimentacao", "valor")
    ex = trend_extrapolate(fit, ["serie"], "ultimo_dia", dias, start_offset)
    return ex.select("serie", "data_movimentacao", F.round("prediction", 4).alias("prediction"))


def _predictions(series: DataFrame) -> DataFrame:
    p = trend_predict(series, ["serie"], "data_movimentacao", "valor")
    return p.select("serie", "data_movimentacao", "valor", F.round("prediction", 4).alias("prediction"))


def trend_predictions(wh: Warehouse, daily: DataFrame | None = None) -> DataFrame:
    """In-sample predictions of the value-type trends: the exported (day, prediction) tables."""
    return _predictions(value_type_series(wh, daily))


def trend_predictions_revenue(wh: Warehouse, daily: DataFrame | None = None) -> DataFrame:
    """In-sample predictions of the revenue-type trends (boleto, payin, payout, total)."""
    return _predictions(revenue_type_series(wh, daily))


def trend_predictions_segment(wh: Warehouse, dense: DataFrame | None = None) -> DataFrame:
    """In-sample predictions of the segment trends, one family per measure (``medida``):
    transactions, value and revenue per segment on the dense day axis."""
    fams = [("quantidade", "quantidade_movimentacoes"), ("valor", "total_movimentacao"),
            ("faturamento", "faturamento")]
    out = None
    for name, measure in fams:
        p = _predictions(segment_series(wh, measure, dense)).withColumn("medida", F.lit(name))
        out = p if out is None else out.unionByName(p)
    return out.select("medida", "serie", "data_movimentacao", "valor", "prediction")


def keep_trend_sums(wh: Warehouse, path: str, months: list[int]) -> None:
    """Write the sums of the value-type trends for ``months`` (new ones, or those that late rows changed).

    Only these months of the summary are read and only their partitions replaced.
    """
    series = value_type_series(wh, revenue_day(wh, months)).withColumn("mes_ref", month_ref(F.col("data_movimentacao")))
    trend_sums(series, ["serie", "mes_ref"], "data_movimentacao", "valor").coalesce(1).write.mode("overwrite") \
        .option("partitionOverwriteMode", "dynamic").partitionBy("mes_ref").parquet(path)


def trend_of_kept_sums(wh: Warehouse, path: str) -> DataFrame:
    """``trend_value_type`` from the kept sums: one row a series and month is read, however long the history."""
    return _report(trend_from_sums(wh.spark.read.parquet(path), ["serie"]), "money")


def value_residuals(wh: Warehouse, daily: DataFrame | None = None) -> DataFrame:
    """Summary of the residuals of each value-type trend."""
    r = residual_summary(value_type_series(wh, daily), ["serie"], "data_movimentacao", "valor")
    digits = {"media": 4, **dict.fromkeys(("desvio", "minimo", "q25", "q50", "q75", "maximo"), 2)}
    # a sum with 0.0 leaves no negative zero
    return r.select("serie", "n", *[(F.round(c, d) + F.lit(0.0)).alias(c) for c, d in digits.items()])
