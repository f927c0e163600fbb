"""Streaks, blocked lags, kept trend sums, quantile sketches, sessions and late rows, run-time pruning."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from paydw.operators.acf import acf, pacf
from paydw.operators.series import streaks
from paydw.operators.trend import (quantile_sketch, residual_summary, sketched_quantiles, trend_from_sums, trend_predict,
                                   trend_summary, trend_sums)
from paydw.plans import volume
from paydw.plans.warehouse import warehouse_for_sf
from paydw.streaming.live import live_sessions, split_late

SF = "/root/testdata/sf0.001"
D0 = dt.date(2024, 1, 1)


def day(n):
    return D0 + dt.timedelta(days=n)


def test_streaks_by_counting(spark):
    rng = random.Random(2)
    use = {c: sorted(rng.sample(range(60), n)) for c, n in (("a", 30), ("b", 1), ("c", 60), ("d", 45))}
    rows = [(c, day(n)) for c, days in use.items() for n in days] + [("a", None), ("none", None)]
    got = {(r.c, r.uso, r.primeiro_dia, r.ultimo_dia, r.dias)
           for r in streaks(spark.createDataFrame(rows, "c string, d date"), ["c"], "d").collect()}
    want = set()
    for c, days in use.items():
        flags = [n in days for n in range(days[0], days[-1] + 1)]
        start = 0
        for i in range(1, len(flags) + 1):
            if i == len(flags) or flags[i] != flags[start]:
                want.add((c, flags[start], day(days[0] + start), day(days[0] + i - 1), i - start))
                start = i
    assert got == want
    assert streaks(spark.createDataFrame([], "c string, d date"), ["c"], "d").count() == 0


@pytest.mark.parametrize("block", [8, 50, 1000])
def test_blocked_lags_equal_one_window(spark, block):
    rng = random.Random(3)
    rows = [(s, day(n), None if rng.random() < 0.02 else rng.uniform(-5, 5)) for s, step in (("x", 1), ("y", 3), ("z", 40))
            for n in range(0, 400, step)] + [("short", day(0), 1.0), ("flat", day(0), 2.0), ("flat", day(1), 2.0)]
    df = spark.createDataFrame(rows, "s string, d date, v double")
    for f in (acf, pacf):
        one = {(r.s, r.lag): r for r in f(df, ["s"], "d", "v", nlags=6).collect()}
        cut = f(df, ["s"], "d", "v", nlags=6, block_rows=block)
        name = f.__name__
        for r in cut.collect():
            w = one.pop((r.s, r.lag))
            assert r.n == w.n and (r[name] == w[name] if w[name] is None else r[name] == pytest.approx(w[name], abs=1e-9))
        assert not one
    with pytest.raises(ValueError):
        acf(df, ["s"], "d", "v", nlags=8, block_rows=8)


def trend_rows(spark, n=200):
    rng = random.Random(4)
    rows = [(s, day(i), round(a * i + rng.gauss(0, 3), 2)) for s, a in (("up", 2.5), ("down", -1.25)) for i in range(n)]
    return spark.createDataFrame(rows + [("one", day(0), 5.0), ("up", day(5), None)], "s string, d date, v double")


def test_kept_sums_give_the_fit_of_all_rows(spark):
    df = trend_rows(spark)
    sums = trend_sums(df.withColumn("m", F.trunc("d", "month")), ["s", "m"], "d", "v")
    got = {r.s: r for r in trend_from_sums(sums, ["s"]).collect()}
    for w in trend_summary(df, ["s"], "d", "v").collect():
        r = got[w.s]
        assert (r.n, r.ultimo_dia, r.slope, r.intercept) == (w.n, w.ultimo_dia, w.slope, w.intercept)
        assert (r.rmse is None) == (w.rmse is None) and (w.rmse is None or r.rmse == pytest.approx(w.rmse, rel=1e-6))


def test_sketches_of_months_merge_within_their_error(spark):
    df = trend_predict(trend_rows(spark, 3000), ["s"], "d", "v").where("s <> 'one'")
    exact = {r.s: r for r in residual_summary(trend_rows(spark, 3000), ["s"], "d", "v").collect()}
    values = {s: sorted(r.residual for r in df.where((F.col("s") == s) & F.col("residual").isNotNull()).collect()) for s in ("up", "down")}
    months = quantile_sketch(df.withColumn("m", F.trunc("d", "month")), ["s", "m"], "residual")
    for r in sketched_quantiles(months, ["s"]).collect():
        below = sum(v <= r.valor for v in values[r.s]) / len(values[r.s])
        assert abs(below - r.posicao) < 0.03
        assert exact[r.s][f"q{int(r.posicao * 100)}"] == pytest.approx(
            values[r.s][0] + (values[r.s][-1] - values[r.s][0]) * 0.5, abs=30)
    assert exact["up"].n == 3000 and abs(exact["up"].media) < 1e-6


def test_a_filter_on_the_calendar_prunes_months_at_run_time(spark):
    wh = warehouse_for_sf(spark, SF)
    df = volume.daily_join_calendar(wh)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan and "mes_ref" in plan.split("PartitionFilters")[1][:200]


EVENTS = "event_id long, ts timestamp, user_id long, event_type string, value double, props string"


def test_late_rows_are_kept_and_sessions_close_behind_the_watermark(spark, scratch):
    t0 = dt.datetime(2024, 1, 1, 12)
    at = lambda minutes: t0 + dt.timedelta(minutes=minutes)
    batches = [[(1, at(0), 1), (2, at(10), 1), (3, at(45), 1), (4, at(75), 1), (5, at(0), 2), (6, None, 2)],
               [(7, at(5000), 1), (8, at(5001), None)],
               [(9, at(20), 1), (10, at(5001 - 1440), 2), (11, at(5001 - 1441), 2), (12, at(5010), 1)]]

    def run(n):
        stream = spark.readStream.schema(EVENTS).parquet(f"{scratch}/in/*")
        split_late(spark, stream, f"{scratch}/out", f"{scratch}/ck{n}").awaitTermination()

    for n, rows in enumerate(batches):
        spark.createDataFrame([(i, t, u, "view", 1.5, "{}") for i, t, u in rows], EVENTS).coalesce(1).write.parquet(f"{scratch}/in/b={n}")
        run("")
    late = lambda: sorted(r.event_id for r in spark.read.parquet(f"{scratch}/out/atrasados").collect())
    assert late() == [9, 11]
    assert sorted(r.event_id for r in spark.read.parquet(f"{scratch}/out/pontuais").collect()) == [1, 2, 3, 4, 5, 6, 7, 8, 10, 12]
    sessions = f"{scratch}/sessions"
    live_sessions(spark.readStream.schema(EVENTS).parquet(f"{scratch}/out/pontuais/*"), sessions, f"{scratch}/sck").awaitTermination()
    epoch = lambda m: int(at(m).replace(tzinfo=dt.timezone.utc).timestamp())
    got = sorted((r.id_cliente, r.inicio, r.fim, r.eventos, r.valor_total) for r in spark.read.parquet(sessions).collect())
    # 45 to 75 is exactly the gap: one session; 5001 - 1440 and later ones are still open
    assert got == [(1, epoch(0), epoch(40), 2, 3.0), (1, epoch(45), epoch(105), 2, 3.0), (2, epoch(0), epoch(30), 1, 1.5)]
