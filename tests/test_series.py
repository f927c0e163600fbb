"""Ordered-series operators, trends, autocorrelation and forecasts."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from paydw.operators.acf import acf, durbin_levinson, pacf
from paydw.operators.densify import densify
from paydw.operators.series import moving_average, split_halves, use_gaps
from paydw.operators.trend import trend_extrapolate, trend_fit, trend_summary

D0 = dt.date(2024, 1, 1)


def _series(spark, values, key="s", start=D0, step=1):
    rows = [(key, start + dt.timedelta(days=i * step), float(v)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "serie string, data_movimentacao date, valor double")


def test_moving_average_min_periods(spark):
    df = _series(spark, [1, 2, 3, 4, 5, 6])
    out = moving_average(df, ["serie"], "data_movimentacao", ["valor"], window=5)
    got = [r.valor_media_movel for r in out.orderBy("data_movimentacao").collect()]
    assert got == [1, 1.5, 2, 2.5, 3, 4]


def test_gap_filled_with_zero(spark):
    rows = [("a", D0 + dt.timedelta(days=d), 1.0) for d in (0, 1, 4)]
    df = spark.createDataFrame(rows, "serie string, data_movimentacao date, valor double")
    out = densify(df, ["serie"], "data_movimentacao", ["valor"])
    got = [r.valor for r in out.orderBy("data_movimentacao").collect()]
    assert got == [1.0, 1.0, 0.0, 0.0, 1.0]
    gaps = use_gaps(df, ["serie"], "data_movimentacao").orderBy("data_movimentacao").collect()
    assert [g.dias_sem_uso for g in gaps] == [None, 0, 2]


def test_split_122(spark):
    out = split_halves(_series(spark, range(122)), ["serie"], "data_movimentacao")
    n_train = out.where(F.col("conjunto") == "treino").count()
    n_test = out.where(F.col("conjunto") == "teste").count()
    shared = out.groupBy("posicao").count().where(F.col("count") == 2).count()
    assert (n_train, n_test, shared) == (62, 61, 1)


def test_trend_exact_line(spark):
    df = _series(spark, [3 + 2.5 * i for i in range(50)])
    r = trend_summary(df, ["serie"], "data_movimentacao", "valor").collect()[0]
    assert r.slope == pytest.approx(2.5, abs=1e-12)
    x0 = (D0 - dt.date(1970, 1, 1)).days
    assert r.intercept + r.slope * x0 == pytest.approx(3.0, abs=1e-6)
    assert r.rmse == pytest.approx(0.0, abs=1e-6)
    assert r.r2 == pytest.approx(1.0, abs=1e-12)


def test_trend_matches_numpy(spark):
    rng = np.random.default_rng(7)
    y = np.round(1000 + 3 * np.arange(120) + rng.normal(0, 50, 120), 2)
    df = _series(spark, y)
    r = trend_summary(df, ["serie"], "data_movimentacao", "valor").collect()[0]
    x = np.arange(120) + (D0 - dt.date(1970, 1, 1)).days
    b, a = np.polyfit(x, y, 1)
    assert r.slope == pytest.approx(b, rel=1e-9)
    assert r.intercept == pytest.approx(a, rel=1e-9)
    rmse = np.sqrt(np.mean((y - (a + b * x)) ** 2))
    assert r.rmse == pytest.approx(rmse, rel=1e-7)


def test_trend_additivity(spark):
    rng = np.random.default_rng(3)
    parts = {k: np.round(rng.uniform(0, 100, 60), 2) for k in ("boleto", "payin", "payout")}
    total = sum(parts.values())
    df = None
    for k, v in list(parts.items()) + [("total", total)]:
        s = _series(spark, v, key=k)
        df = s if df is None else df.unionByName(s)
    fits = {r.serie: r for r in trend_fit(df, ["serie"], "data_movimentacao", "valor").collect()}
    assert fits["total"].slope == pytest.approx(sum(fits[k].slope for k in parts), rel=1e-9, abs=1e-12)
    assert fits["total"].intercept == pytest.approx(sum(fits[k].intercept for k in parts), rel=1e-9)


def test_extrapolate_repeats_last_day(spark):
    df = _series(spark, [1, 2, 3])
    fit = trend_summary(df, ["serie"], "data_movimentacao", "valor")
    out = trend_extrapolate(fit, ["serie"], "ultimo_dia", 3).orderBy("data_movimentacao").collect()
    assert out[0].data_movimentacao == D0 + dt.timedelta(days=2)
    assert [round(r.prediction, 9) for r in out] == [3.0, 4.0, 5.0]


def _np_acf(y, nlags):
    c = y - y.mean()
    d = np.sum(c * c)
    return np.array([np.sum(c[k:] * c[:len(c) - k]) / d for k in range(nlags + 1)])


def test_acf_matches_brute_force(spark):
    rng = np.random.default_rng(11)
    y = np.cumsum(rng.normal(size=80)) + 10
    a = acf(_series(spark, y), ["serie"], "data_movimentacao", "valor", nlags=10)
    got = np.array([r.acf for r in a.orderBy("lag").collect()])
    ref = _np_acf(y, 10)
    assert np.allclose(got, ref, atol=1e-12)
    bands = [r.band for r in a.orderBy("lag").collect()]
    var = [(1 + 2 * np.sum(ref[1:k] ** 2)) / len(y) for k in range(1, 11)]
    assert np.allclose(bands[1:], 1.959963984540054 * np.sqrt(var), atol=1e-12)


def test_durbin_levinson_matches_yule_walker():
    r = np.array([1.0, 0.6, 0.3, 0.1, 0.05])
    dl = durbin_levinson(r)
    for k in range(1, 5):
        R = np.array([[r[abs(i - j)] for j in range(k)] for i in range(k)])
        phi = np.linalg.solve(R, r[1:k + 1])
        assert dl[k] == pytest.approx(phi[-1], abs=1e-12)
    assert list(durbin_levinson(np.array([1, 0.5, 0.25, 0.125]))[:4]) == pytest.approx([1, 0.5, 0, 0])


def test_pacf_grouped(spark):
    rng = np.random.default_rng(5)
    y = np.zeros(300)
    for t in range(1, 300):
        y[t] = 0.7 * y[t - 1] + rng.normal()
    df = _series(spark, y, "a").unionByName(_series(spark, rng.normal(size=300), "b"))
    p = {(r.serie, r.lag): r.pacf for r in pacf(df, ["serie"], "data_movimentacao", "valor", 5).collect()}
    assert p[("a", 0)] == 1.0
    assert p[("a", 1)] == pytest.approx(0.7, abs=0.1)
    assert abs(p[("a", 2)]) < 0.15


def test_pivot_types_equals_conditional_counts(spark):
    from paydw.operators.series import pivot_types

    rows = [("a", D0, "boleto", 2), ("a", D0, "payin", 1), ("b", D0, "payout", 4)]
    df = spark.createDataFrame(rows, "k string, d date, tipo string, n long")
    got = {(r.k,): (r.boleto, r.payin, r.payout) for r in
           pivot_types(df, ["k", "d"], "tipo", "n", ["boleto", "payin", "payout"]).collect()}
    assert got == {("a",): (2, 1, 0), ("b",): (0, 0, 4)}
