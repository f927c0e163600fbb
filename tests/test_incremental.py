"""Incremental runs lose nothing, amounts are not rounded, tables exist by their files."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from paydw import storage
from paydw.jobs import main
from paydw.operators.merge import read_table
from paydw.operators.trend import trend_fit
from paydw.plans import revenue
from paydw.plans.warehouse import Warehouse
from paydw.schemas import STAGING_CLIENTES, STAGING_CONTRATOS, STAGING_TRANSACOES
from paydw.sources.driver import Staging

D = dt.date.fromisoformat


def staging(spark, tx, clients=(1, 2), contracts=((11, 1), (21, 2)), rates=(0.5, 0.25, 1.0), until="2030-01-01"):
    return Staging(
        spark.createDataFrame([(c, f"c{c}", D("2020-01-01"), "ativo", None, "varejo") for c in clients], STAGING_CLIENTES),
        spark.createDataFrame([(k, c, *rates, D(until)) for k, c in contracts], STAGING_CONTRATOS),
        spark.createDataFrame([(i, c, kind, v, D(d), dt.datetime.fromisoformat(d)) for i, c, kind, v, d in tx], STAGING_TRANSACOES))


def summary(wh):
    return sorted((r.id_cliente, str(r.data_movimentacao), r.quantidade_movimentacoes, r.total_movimentacao)
                  for r in wh.fact_dia.collect())


def test_open_day_is_summarized_once_it_is_closed(spark, scratch):
    wh = Warehouse(spark, scratch)
    wh.create_tables()
    wh.run_interval(staging(spark, [(1, 1, "payin", 10.0, "2024-01-10")]), end_date="last", process_date="2024-01-10")
    assert summary(wh) == []
    wh.run_interval(staging(spark, [(2, 1, "payin", 5.0, "2024-01-10"), (3, 1, "boleto", 20.0, "2024-01-10")]),
                    end_date="last", process_date="2024-01-11")
    assert summary(wh) == [(1, "2024-01-10", 3, 35.0)]


@pytest.mark.parametrize("late,want", [("recompute", (1, "2024-01-10", 2, 15.0)), ("ignore", (1, "2024-01-10", 1, 10.0))])
def test_late_rows_of_a_closed_day(spark, scratch, late, want):
    wh = Warehouse(spark, scratch)
    wh.create_tables()
    wh.run_interval(staging(spark, [(1, 1, "payin", 10.0, "2024-01-10")]), end_date="last", process_date="2024-01-11")
    wh.run_interval(staging(spark, [(2, 1, "payin", 5.0, "2024-01-10"), (3, 2, "payin", 1.0, "2024-01-20")]),
                    end_date="last", process_date="2024-01-15", late=late)
    assert summary(wh) == [want]


def test_transaction_waits_for_its_contract(spark, scratch):
    wh = Warehouse(spark, scratch)
    wh.create_tables()
    tx = [(1, 1, "payin", 10.0, "2024-01-10"), (2, 2, "payin", 7.0, "2024-01-10")]
    wh.run_interval(staging(spark, tx, contracts=((11, 1),)), end_date="last", process_date="2024-01-11")
    assert wh.fact.count() == 1 and wh.pending().count() == 1
    wh.run_interval(staging(spark, [(3, 1, "payin", 1.0, "2024-01-12")]), end_date="last", process_date="2024-01-13")
    assert sorted(r.id_transacao for r in wh.fact.collect()) == [1, 2, 3] and wh.pending().count() == 0
    assert summary(wh) == [(1, "2024-01-10", 1, 10.0), (1, "2024-01-12", 1, 1.0), (2, "2024-01-10", 1, 7.0)]


def test_calendar_has_no_holes_and_grows_with_ingest(spark, scratch):
    wh = Warehouse(spark, f"{scratch}/dw")
    wh.create_tables()
    for day in ("2024-01-10", "2024-01-15"):
        wh.run_interval(staging(spark, [(int(day[-2:]), 1, "payin", 1.0, day)]), end_date="last", process_date="2024-02-01")
    assert wh.tempo.count() == 6
    staging(spark, [(30, 1, "payin", 2.0, "2024-01-18")]).transacoes.write.parquet(f"{scratch}/in")
    main(["ingest", "--warehouse", f"{scratch}/dw", "--incoming", f"{scratch}/in", "--checkpoint", f"{scratch}/ck",
          "--process-date", "2024-02-01"])
    assert sorted(str(r.data) for r in wh.tempo.collect())[-1] == "2024-01-18" and wh.tempo.count() == 9
    days = {str(r.data): r.total for r in revenue.revenue_day(wh).collect()}
    assert days == {"2024-01-10": 1.0, "2024-01-15": 1.0, "2024-01-18": 2.0}


def test_interval_job_pulls_a_window_and_clears_what_it_read(spark, scratch, monkeypatch):
    st = staging(spark, [(1, 1, "payin", 1.0, "2024-01-10"), (2, 1, "payin", 2.0, "2024-01-11"), (3, 1, "payin", 4.0, "2024-01-12")])
    for name in ("clientes", "contratos", "transacoes"):
        getattr(st, name).coalesce(1).write.parquet(f"{scratch}/s/{name}")
    job = ["interval", "--warehouse", f"{scratch}/dw", "--staging", f"{scratch}/s", "--end-date", "2024-01-31", "--process-date", "2024-02-01"]
    fact = lambda: sorted(r.id_transacao for r in Warehouse(spark, f"{scratch}/dw").fact.collect())
    with pytest.raises(SystemExit):  # the row of 2024-01-12 would be lost
        main([*job, "--start", "2024-01-10", "--end", "2024-01-12", "--clear-staging"])
    assert storage.has_data(spark, f"{scratch}/s/transacoes")
    main([*job, "--start", "2024-01-10", "--end", "2024-01-12"])
    assert fact() == [1, 2]
    main([*job, "--start", "2024-01-11"])  # an open end
    assert fact() == [1, 2, 3]
    # a file that arrives while the job runs is not cleared
    load = Warehouse.run_interval

    def and_more(self, *a, **k):
        load(self, *a, **k)
        staging(spark, [(4, 1, "payin", 8.0, "2024-01-13")]).transacoes.coalesce(1).write.mode("append").parquet(f"{scratch}/s/transacoes")

    monkeypatch.setattr(Warehouse, "run_interval", and_more)
    main([*job, "--clear-staging"])
    monkeypatch.setattr(Warehouse, "run_interval", load)
    assert not storage.has_data(spark, f"{scratch}/s/contratos")
    assert [r.id_transacao for r in spark.read.parquet(f"{scratch}/s/transacoes").collect()] == [4]
    main([*job, "--clear-staging"])
    assert fact() == [1, 2, 3, 4] and not storage.has_data(spark, f"{scratch}/s/transacoes")
    with pytest.raises(SystemExit):
        main(["ingest", "--warehouse", f"{scratch}/dw", "--incoming", f"{scratch}/s"])


def run(wh, st, day, **k):
    wh.run_interval(st, end_date="last", process_date=day, **k)


def test_a_row_without_an_id_is_inserted_once_for_each_time_it_comes(spark, scratch):
    wh = Warehouse(spark, scratch)
    run(wh, staging(spark, [(None, 1, "payin", 10.0, "2024-01-10"), (1, 1, "payin", 5.0, "2024-01-10")]), "2024-01-11")
    for _ in range(3):
        run(wh, staging(spark, []), "2024-01-20")
    assert wh.fact.count() == 2 and summary(wh) == [(1, "2024-01-10", 2, 15.0)]
    run(wh, staging(spark, [(None, 1, "payin", 10.0, "2024-01-10")]), "2024-01-21")
    assert wh.fact.count() == 3 and summary(wh) == [(1, "2024-01-10", 3, 25.0)]
    assert wh.pending() is None


def test_equal_rows_that_wait_are_all_inserted(spark, scratch):
    wh = Warehouse(spark, scratch)
    twice = [(7, 2, "payin", 3.0, "2024-01-10")] * 2 + [(None, 2, "payin", 1.0, "2024-01-10")] * 2
    run(wh, staging(spark, twice, contracts=((11, 1),)), "2024-01-11")
    assert wh.fact.count() == 0 and wh.pending().count() == 4
    run(wh, staging(spark, twice[:2], contracts=((11, 1),)), "2024-01-12")  # known to wait: nothing is added
    assert wh.pending().count() == 4
    run(wh, staging(spark, []), "2024-01-13")
    assert wh.fact.count() == 4 and wh.pending().count() == 0 and summary(wh) == [(2, "2024-01-10", 4, 8.0)]


def test_only_clients_with_new_contracts_are_tried_again(spark, scratch, monkeypatch):
    wh = Warehouse(spark, scratch)
    waits = [(i, c, "payin", 1.0, "2024-01-10") for i, c in ((1, 2), (2, 3), (3, 4), (4, None))]
    expired = ((11, 1), (41, 4))
    run(wh, staging(spark, waits, contracts=expired, until="2024-01-01"), "2024-01-11")
    assert wh.pending().count() == 4
    tried = []
    due = Warehouse._due
    monkeypatch.setattr(Warehouse, "_due", lambda self: tried.append(d := due(self)) or d)
    run(wh, staging(spark, [], contracts=(*expired, (21, 2))), "2024-01-12")
    run(wh, staging(spark, [], contracts=(*expired, (21, 2))), "2024-01-13")  # no new contract: nothing is read
    run(wh, staging(spark, [], contracts=((42, 4),)), "2024-01-14")
    assert [d is not None for d in tried] == [True, False, True]
    assert sorted(r.id_transacao for r in wh.fact.collect()) == [1, 3]
    assert sorted(r.id_transacao for r in wh.pending().collect()) == [2, 4]


def test_views_are_empty_when_nothing_has_resolved(spark, scratch):
    wh = Warehouse(spark, scratch)
    wh.bootstrap(staging(spark, [(1, 9, "payin", 10.0, "2024-01-10")]), end_date="last")
    assert wh.fact.count() == 0 and wh.fact_dia.count() == 0 and revenue.revenue_day(wh).collect() == []
    assert wh.fact.columns[-1] == "mes_ref" and wh.tempo.count() == 1


@pytest.mark.parametrize("step,after", [("_stage", False), ("_apply", False), ("_put", True), ("recompute_summary", True),
                                        ("finish_runs", False)])
def test_a_broken_run_is_finished_by_the_next(spark, scratch, monkeypatch, step, after):
    """The driver is lost before or after a step of the second run; the third run gets everything right."""
    wh = Warehouse(spark, scratch)
    first = [(1, 1, "payin", 10.0, "2024-01-10"), (2, 2, "payin", 7.0, "2024-01-10")]
    second = [(3, 1, "payin", 1.0, "2024-01-10"), (None, 1, "payin", 2.0, "2024-01-10"), (4, 3, "payin", 4.0, "2024-01-12")]
    run(wh, staging(spark, first, contracts=((11, 1),)), "2024-01-11")
    whole = getattr(Warehouse, step)

    def broken(self, *a, **k):
        if after:
            whole(self, *a, **k)
        raise RuntimeError("lost")

    monkeypatch.setattr(Warehouse, step, broken)
    with pytest.raises(RuntimeError):
        run(wh, staging(spark, second), "2024-01-13")
    monkeypatch.setattr(Warehouse, step, whole)
    # the source brings the lost run's rows again unless they had been staged
    staged = bool(wh.runs.with_mark("staged", without="done"))
    again = [] if staged or (step == "finish_runs" and after) else second
    run(wh, staging(spark, again, contracts=((31, 3),)), "2024-01-14")
    assert sorted(r.id_transacao or 0 for r in wh.fact.collect()) == [0, 1, 2, 3, 4]
    assert summary(wh) == [(1, "2024-01-10", 3, 13.0), (2, "2024-01-10", 1, 7.0), (3, "2024-01-12", 1, 4.0)]
    assert wh.pending().count() == 0


def test_amounts_are_not_rounded(spark, scratch):
    wh = Warehouse(spark, scratch)
    wh.create_tables()
    tx = [(1, 1, "payin", 7.0, "2024-01-10"), (2, 1, "payin", 0.004, "2024-01-10"), (3, 1, "payin", 0.004, "2024-01-10"),
          (4, 2, "payout", 1_000_000.0, "2024-01-10"), (5, 2, "boleto", 100.0, "2024-01-10")]
    wh.run_interval(staging(spark, tx, rates=(0.0000004, 1.0, 0.1234567)), end_date="last", process_date="2024-01-11")
    assert summary(wh)[0] == (1, "2024-01-10", 3, 7.008)
    day = revenue.revenue_day(wh).first()
    assert day.faturamento_payout == 0.4 and day.faturamento_boleto == 12.34567


def test_trend_on_shares(spark):
    rows = [("s", D("2024-01-01") + dt.timedelta(days=i), 0.001 + 0.0003 * i) for i in range(30)]
    fit = trend_fit(spark.createDataFrame(rows, "serie string, d date, v double"), ["serie"], "d", "v").first()
    assert fit.slope == pytest.approx(0.0003, rel=1e-9) and fit.r2 == pytest.approx(1.0)


def test_existence_is_decided_by_the_files_system(spark, scratch):
    assert read_table(spark, f"{scratch}/none") is None
    spark.range(3).write.parquet(f"{scratch}/t")
    assert read_table(spark, f"{scratch}/t").count() == 3
    before = sorted(storage.files(spark, f"{scratch}/t"))
    spark.range(2).write.mode("append").parquet(f"{scratch}/t")
    assert sorted(storage.files(spark, f"{scratch}/t")) != before
    # a path without a scheme belongs to the default file system, whatever that is
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    old, plain = conf.get("fs.defaultFS"), scratch.removeprefix("file:")
    conf.set("fs.viewfs.mounttable.dw.link./data", "file:///")
    conf.set("fs.defaultFS", "viewfs://dw/")
    try:
        assert storage.has_data(spark, f"/data{plain}/t") and not storage.has_data(spark, f"/data{plain}/none")
    finally:
        conf.set("fs.defaultFS", old)


def test_a_broken_table_is_an_error(spark, scratch):
    spark.range(1).select(F.lit("x").alias("t")).write.text(f"{scratch}/bad")
    with pytest.raises(Exception):
        read_table(spark, f"{scratch}/bad").count()
