"""Property tests: merge and contract resolution against plain-Python models."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from paydw.operators.contracts import resolve_contract
from paydw.operators.merge import insert_only_merge
from paydw.schemas import STAGING_CONTRATOS, STAGING_TRANSACOES

SETTINGS = settings(max_examples=12, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow])

rows = st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 6)), st.integers(0, 3)), max_size=12)


def _merge_model(target, source):
    have = {k for k, _ in target if k is not None}
    return target + [(k, v) for k, v in source if k is None or k not in have]


@SETTINGS
@given(target=rows, sources=st.lists(rows, min_size=1, max_size=3))
def test_merge_matches_model(spark, target, sources):
    import uuid

    from paydw.session import scratch_path

    path = scratch_path(spark, "paydw-prop", uuid.uuid4().hex[:12])
    schema = "k long, v long"
    model = []
    if target:
        insert_only_merge(spark.createDataFrame(target, schema), path, ["k"])
        model = list(target)
    for src in sources:
        if not src:
            continue
        insert_only_merge(spark.createDataFrame(src, schema), path, ["k"])
        model = _merge_model(model, src)
    got = sorted(((r.k if r.k is not None else -1), r.v) for r in spark.read.parquet(path).collect()) \
        if model else []
    assert got == sorted(((k if k is not None else -1), v) for k, v in model)


D0 = dt.date(2024, 1, 1)
contracts = st.lists(st.tuples(st.integers(1, 4), st.integers(0, 20)), max_size=10)
txs = st.lists(st.tuples(st.integers(1, 5), st.integers(0, 25)), max_size=15)


def _resolve_model(tx, con):
    out = []
    for tid, (cli, d) in enumerate(tx):
        exp = [v for c, v in con if c == cli and v >= d]
        if not exp:
            continue
        m = max(exp)
        out += [(tid, cid) for cid, (c, v) in enumerate(con) if c == cli and v == m and d <= v]
    return sorted(out)


@SETTINGS
@given(con=contracts, tx=txs)
def test_resolution_matches_correlated_model(spark, con, tx):
    cdf = spark.createDataFrame(
        [(cid, c, 1.0, 1.0, 1.0, D0 + dt.timedelta(days=v)) for cid, (c, v) in enumerate(con)],
        STAGING_CONTRATOS)
    tdf = spark.createDataFrame(
        [(tid, c, "payin", 1.0, D0 + dt.timedelta(days=d), dt.datetime(2024, 1, 1)) for tid, (c, d) in enumerate(tx)],
        STAGING_TRANSACOES)
    got = sorted((r.id_transacao, r.id_contrato) for r in resolve_contract(tdf, cdf).collect())
    assert got == _resolve_model(tx, con)


@SETTINGS
@given(vals=st.lists(st.lists(st.integers(0, 10**7), min_size=3, max_size=40), min_size=2, max_size=3),
       start=st.integers(0, 20000))
def test_trend_matches_numpy_and_adds_up(spark, vals, start):
    import numpy as np
    import pytest

    from paydw.operators.trend import trend_fit

    n = min(len(v) for v in vals)
    series = [np.array(v[:n]) / 100.0 for v in vals]            # money with cents
    d0 = dt.date(1970, 1, 1) + dt.timedelta(days=start)
    rows = [(f"s{k}", d0 + dt.timedelta(days=i), float(y[i])) for k, y in enumerate(series) for i in range(n)]
    rows += [("total", d0 + dt.timedelta(days=i), float(sum(round(y[i], 2) for y in series))) for i in range(n)]
    df = spark.createDataFrame(rows, "serie string, data_movimentacao date, valor double")
    fits = {r.serie: r for r in trend_fit(df, ["serie"], "data_movimentacao", "valor").collect()}
    x = np.arange(n) + start
    for k, y in enumerate(series):
        b, a = np.polyfit(x, y, 1)
        assert fits[f"s{k}"].slope == pytest.approx(b, rel=1e-6, abs=1e-6)
        assert fits[f"s{k}"].intercept == pytest.approx(a, rel=1e-6, abs=1e-3)
    assert fits["total"].slope == pytest.approx(sum(fits[f"s{k}"].slope for k in range(len(series))),
                                                rel=1e-6, abs=1e-6)


@SETTINGS
@given(data=st.dictionaries(st.sampled_from(["a", "b", "c"]),
                            st.dictionaries(st.integers(0, 40), st.integers(1, 99), min_size=1, max_size=8),
                            min_size=1, max_size=3))
def test_densify_per_key_axis(spark, data):
    from paydw.operators.densify import densify

    d0 = dt.date(2024, 1, 1)
    rows = [(k, d0 + dt.timedelta(days=i), v) for k, days in data.items() for i, v in days.items()]
    df = spark.createDataFrame(rows, "k string, d date, v long")
    got = {(r.k, r.d): r.v for r in densify(df, ["k"], "d", ["v"]).collect()}
    want = {}
    for k, days in data.items():
        for i in range(min(days), max(days) + 1):
            want[(k, d0 + dt.timedelta(days=i))] = days.get(i, 0)
    assert got == want


@SETTINGS
@given(vals=st.lists(st.integers(-1000, 1000), min_size=1, max_size=60), window=st.integers(1, 7))
def test_split_and_moving_average(spark, vals, window):
    import pandas as pd

    from paydw.operators.series import moving_average, split_halves

    d0 = dt.date(2024, 1, 1)
    df = spark.createDataFrame([("s", d0 + dt.timedelta(days=i), float(v)) for i, v in enumerate(vals)],
                               "serie string, d date, valor double")
    n = len(vals)
    sp = split_halves(df, ["serie"], "d").collect()
    tr = sorted(r.posicao for r in sp if r.conjunto == "treino")
    te = sorted(r.posicao for r in sp if r.conjunto == "teste")
    assert tr == list(range(0, n // 2 + 1)) and te == list(range(n // 2, n))
    ma = [r.valor_media_movel for r in moving_average(df, ["serie"], "d", ["valor"], window).orderBy("d").collect()]
    ref = pd.Series(vals, dtype=float).rolling(window, min_periods=1).mean().tolist()
    assert all(abs(a - b) < 1e-9 for a, b in zip(ma, ref)) and len(ma) == n


@SETTINGS
@given(vals=st.lists(st.integers(-500, 500), min_size=2, max_size=50), nlags=st.integers(1, 10))
def test_acf_matches_definition(spark, vals, nlags):
    import numpy as np

    from paydw.operators.acf import acf

    d0 = dt.date(2024, 1, 1)
    df = spark.createDataFrame([("s", d0 + dt.timedelta(days=i), float(v)) for i, v in enumerate(vals)],
                               "serie string, d date, valor double")
    got = {r.lag: r.acf for r in acf(df, ["serie"], "d", "valor", nlags).collect()}
    y = np.array(vals, dtype=float)
    c = y - y.mean()
    den = float(c @ c)
    for k in range(nlags + 1):
        if den == 0 or k >= len(y):
            assert got[k] is None
        else:
            assert abs(got[k] - float(c[k:] @ c[:len(c) - k]) / den) < 1e-9


day_rows = st.lists(st.tuples(st.integers(1, 4), st.integers(0, 70), st.integers(0, 9)), max_size=15)


@SETTINGS
@given(target=day_rows, source=day_rows)
def test_partition_pruned_merge_matches_model(spark, target, source):
    import uuid

    from pyspark.sql import functions as F

    from paydw.functions.calendar import month_ref
    from paydw.session import scratch_path

    d0 = dt.date(2024, 1, 1)
    path = scratch_path(spark, "paydw-prop", uuid.uuid4().hex[:12])
    schema = "id_cliente long, data_movimentacao date, v long"

    def frame(rows):
        df = spark.createDataFrame([(c, d0 + dt.timedelta(days=d), v) for c, d, v in rows], schema)
        return df.withColumn("mes_ref", month_ref(F.col("data_movimentacao")))

    keys = ["id_cliente", "data_movimentacao"]
    if target:
        insert_only_merge(frame(target), path, keys, partition_by="mes_ref", prune_on="mes_ref")
    if source:
        insert_only_merge(frame(source), path, keys, partition_by="mes_ref", prune_on="mes_ref")
    have = {(c, d) for c, d, _ in target}
    model = list(target) + [(c, d, v) for c, d, v in source if (c, d) not in have]
    got = []
    if model:
        got = sorted((r.id_cliente, (r.data_movimentacao - d0).days, r.v) for r in spark.read.parquet(path).collect())
    assert got == sorted(model)
