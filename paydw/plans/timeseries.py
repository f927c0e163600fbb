"""Time-series models of daily value moved.

The reference studies one series (total value per day) on the driver. Here
the same steps run keyed by ``serie``: the total plus one series per
segment, so any number of series is processed by the same jobs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paydw.operators.acf import acf, acf_first_lag, pacf, pacf_first_lag
from paydw.operators.series import split_halves
from paydw.plans.common import sum_money
from paydw.plans.segments import segment_day_dense
from paydw.plans.warehouse import Warehouse

KEYS = ["serie"]
ORDER = "data_movimentacao"


def daily_total(wh: Warehouse) -> DataFrame:
    """Total value per day, days with data."""
    return wh.fact_dia.groupBy("data_movimentacao").agg(sum_money("total_movimentacao"))


def ts_series(wh: Warehouse, dense: DataFrame | None = None) -> DataFrame:
    """(serie, day, value): 'total' over days with data plus each segment on a dense axis."""
    total = daily_total(wh).select(F.lit("total").alias("serie"), "data_movimentacao",
                                   F.col("total_movimentacao").alias("valor"))
    d = segment_day_dense(wh) if dense is None else dense
    seg = d.select(F.col("segmento").alias("serie"), "data_movimentacao",
                   F.col("total_movimentacao").alias("valor"))
    return total.unionByName(seg)


def series_split(wh: Warehouse, overlap: bool = True, dense: DataFrame | None = None) -> DataFrame:
    """The series split in halves (W5); the input of every model below.

    Each model function takes ``split`` (this table, e.g. materialized once
    for all of them) or computes it from the warehouse when None.
    """
    return split_halves(ts_series(wh, dense), KEYS, ORDER, overlap=overlap)


def _train(wh: Warehouse, split: DataFrame | None) -> DataFrame:
    s = series_split(wh) if split is None else split
    return s.where(F.col("conjunto") == "treino")


def acf_train(wh: Warehouse, nlags: int = 30, split: DataFrame | None = None, block_rows: int | None = None) -> DataFrame:
    a = acf(_train(wh, split), KEYS, ORDER, "valor", nlags=nlags, block_rows=block_rows)
    return a.select("serie", F.col("lag").cast("int").alias("lag"), F.col("n").cast("long").alias("n"),
                    F.round("acf", 8).alias("acf"), F.round("var_bartlett", 10).alias("var_bartlett"),
                    F.round("band", 8).alias("band"))


def acf_candidate(wh: Warehouse, nlags: int = 30, split: DataFrame | None = None) -> DataFrame:
    a = acf(_train(wh, split), KEYS, ORDER, "valor", nlags=nlags)
    return acf_first_lag(a, KEYS).select("serie", F.col("acf_first_lag").cast("int"))


def _pacf(wh: Warehouse, nlags: int, split: DataFrame | None, block_rows: int | None = None) -> DataFrame:
    return pacf(_train(wh, split), KEYS, ORDER, "valor", nlags=nlags, block_rows=block_rows)


def pacf_train(wh: Warehouse, nlags: int = 30, split: DataFrame | None = None, block_rows: int | None = None) -> DataFrame:
    p = _pacf(wh, nlags, split, block_rows)
    return p.select("serie", "lag", F.round("pacf", 8).alias("pacf"), "n", F.round("band", 8).alias("band"))


def pacf_candidate(wh: Warehouse, nlags: int = 30, split: DataFrame | None = None) -> DataFrame:
    return pacf_first_lag(_pacf(wh, nlags, split), KEYS).select("serie", F.col("pacf_first_lag").cast("int"))
