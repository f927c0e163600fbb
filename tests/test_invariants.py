"""Invariants the exported reference trends satisfy, checked on driver data."""

import pytest
from pyspark.sql import functions as F

from paydw.plans import revenue, segments, timeseries, trends
from paydw.plans.warehouse import warehouse_for_sf

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def wh(spark):
    return warehouse_for_sf(spark, SF)


def test_types_add_up_to_total(wh):
    for r in revenue.revenue_day(wh).collect():
        assert r.total == pytest.approx(r.total_boleto + r.total_payin + r.total_payout, abs=1e-6)
        assert r.faturamento_total == pytest.approx(
            r.faturamento_boleto + r.faturamento_payin + r.faturamento_payout, rel=1e-12, abs=1e-6)


def test_segments_add_up_to_total(wh):
    seg = segments.segment_day_all(wh).groupBy("data_movimentacao").agg(
        F.sum("total_movimentacao").alias("v"), F.sum("faturamento").alias("f"),
        F.sum("quantidade_movimentacoes").alias("q"))
    day = revenue.revenue_day(wh).select(F.col("data").alias("data_movimentacao"), "total", "faturamento_total")
    n_tx = wh.fact_dia.groupBy("data_movimentacao").agg(F.sum("quantidade_movimentacoes").alias("n"))
    rows = seg.join(day, "data_movimentacao", "full").join(n_tx, "data_movimentacao", "full").collect()
    assert rows
    for r in rows:
        assert r.v == pytest.approx(r.total, abs=1e-4)
        assert r.f == pytest.approx(r.faturamento_total, rel=1e-9)
        assert r.q == r.n


def test_trend_additivity_on_one_axis(wh):
    # every series on the same zero-filled day axis -> fits are additive
    dense = segments.segment_day_dense(wh)
    total = dense.groupBy("data_movimentacao").agg(F.sum("total_movimentacao").alias("valor")) \
        .withColumn("serie", F.lit("total"))
    per = dense.select(F.col("segmento").alias("serie"), "data_movimentacao",
                       F.col("total_movimentacao").alias("valor"))
    from paydw.operators.trend import trend_fit
    fits = {r.serie: r for r in trend_fit(per.unionByName(total), ["serie"], "data_movimentacao",
                                          "valor").collect()}
    segs = [k for k in fits if k != "total"]
    assert fits["total"].slope == pytest.approx(sum(fits[k].slope for k in segs), rel=1e-9, abs=1e-9)
    assert fits["total"].intercept == pytest.approx(sum(fits[k].intercept for k in segs), rel=1e-9)


def test_trend_mean_recovers_period_total(wh):
    # least squares keeps the mean: mean(prediction) * n = sum(values)
    p = trends.trend_predictions(wh).groupBy("serie").agg(
        F.sum("prediction").alias("sp"), F.sum("valor").alias("sv"))
    for r in p.collect():
        assert r.sp == pytest.approx(r.sv, rel=1e-9)


def test_split_and_acf_shapes(wh):
    s = timeseries.series_split(wh)
    per = s.groupBy("serie", "n").agg(F.sum(F.when(F.col("conjunto") == "treino", 1).otherwise(0)).alias("tr"),
                                      F.sum(F.when(F.col("conjunto") == "teste", 1).otherwise(0)).alias("te"))
    for r in per.collect():
        assert r.tr == r.n // 2 + 1 and r.te == r.n - r.n // 2
    a = timeseries.acf_train(wh)
    assert a.where(F.col("lag") == 0).select(F.min("acf"), F.max("acf")).first() == (1.0, 1.0)
