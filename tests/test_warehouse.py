"""Warehouse ETL: bootstrap, interval runs, calendar and late transactions."""

import datetime as dt

from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from paydw.operators.summary import daily_summary, merged_summary, partial_summary
from paydw.plans import warehouse
from paydw.plans.warehouse import Warehouse
from paydw.sources.calendar import calendar
from paydw.sources.driver import Staging, staging_from_sf


def test_calendar_attributes(spark):
    df = spark.createDataFrame([(dt.date(2023, 10, 1),)], "data_movimentacao date")
    row = calendar(df, end_date="2023-10-01").collect()[0]
    assert (row.ano, row.mes, row.dia, row.dia_da_semana, row.dia_do_ano, row.trimestre) == (2023, 10, 1, 7, 274, 4)


def test_calendar_end_today_and_empty(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 1),)], "data_movimentacao date")
    assert calendar(df, end_date="2024-01-10").count() == 10
    assert calendar(df.limit(0), end_date="2024-01-10").count() == 0
    assert calendar(df, end_date="today").count() >= 10


def _split(st: Staging, cut: str, before: bool) -> Staging:
    c = F.col("data_movimentacao") < F.lit(cut).cast("date")
    return Staging(st.clientes, st.contratos, st.transacoes.where(c if before else ~c))


def test_interval_runs_equal_bootstrap(spark, scratch):
    sf = "/root/testdata/sf0.001"
    st = staging_from_sf(spark, sf)
    full = Warehouse(spark, scratch + "/full")
    full.run_interval(st, end_date="2002-01-01")
    inc = Warehouse(spark, scratch + "/inc")
    inc.run_interval(_split(st, "1998-01-01", True), end_date="2002-01-01")
    later = _split(st, "1998-01-01", False)
    days = [r[0] for r in later.transacoes.select("data_movimentacao").distinct().collect()]
    inc.run_interval(later, end_date="2002-01-01", summary_days=days)
    inc.run_interval(later, end_date="2002-01-01", summary_days=days)  # a retried run changes nothing
    for name in ("fact_transacoes", "fact_transacoes_dia", "dim_tempo", "dim_clientes", "dim_contratos"):
        a = sorted(map(tuple, full.table(name).collect()))
        b = sorted(map(tuple, inc.table(name).collect()))
        assert a == b, name


def test_late_transaction_does_not_change_summary(spark, scratch):
    sf = "/root/testdata/sf0.001"
    st = staging_from_sf(spark, sf)
    wh = Warehouse(spark, scratch)
    wh.run_interval(st, end_date="last")
    before = sorted(map(tuple, wh.fact_dia.collect()))
    row = wh.fact.orderBy("data_movimentacao").first()
    late = spark.createDataFrame(
        [(10**12, row.id_cliente, "payin", 5.0, row.data_movimentacao, row.hora_movimentacao)],
        st.transacoes.schema)
    wh.run_interval(Staging(st.clientes, st.contratos, late), end_date="last",
                    summary_days=[row.data_movimentacao])
    assert wh.fact.where(F.col("id_transacao") == 10**12).count() == 1
    assert sorted(map(tuple, wh.fact_dia.collect())) == before


def test_recompute_mode_takes_late_rows(spark, scratch):
    sf = "/root/testdata/sf0.001"
    st = staging_from_sf(spark, sf)
    wh = Warehouse(spark, scratch)
    wh.run_interval(st, end_date="last")
    row = wh.fact.orderBy("data_movimentacao").first()
    late = spark.createDataFrame(
        [(10**12, row.id_cliente, "payin", 5.0, row.data_movimentacao, row.hora_movimentacao)],
        st.transacoes.schema)
    wh.run_interval(Staging(st.clientes, st.contratos, late), end_date="last", summarize=False)
    other_before = sorted(map(tuple, wh.fact_dia.where(F.col("mes_ref") != int(
        row.data_movimentacao.strftime("%Y%m"))).collect()))
    wh.recompute_summary([row.data_movimentacao])
    from paydw.operators.summary import daily_summary
    want = sorted(map(tuple, daily_summary(wh.fact.drop("mes_ref")).collect()))
    got = sorted(map(tuple, wh.fact_dia.drop("mes_ref").collect()))
    assert got == want
    other_after = sorted(map(tuple, wh.fact_dia.where(F.col("mes_ref") != int(
        row.data_movimentacao.strftime("%Y%m"))).collect()))
    assert other_after == other_before


def test_empty_interval_changes_nothing(spark, scratch):
    sf = "/root/testdata/sf0.001"
    st = staging_from_sf(spark, sf)
    wh = Warehouse(spark, scratch)
    wh.run_interval(st, end_date="2002-01-01")
    before = {t: sorted(map(tuple, wh.table(t).collect())) for t in ("fact_transacoes", "fact_transacoes_dia")}
    empty = Staging(st.clientes.limit(0), st.contratos.limit(0), st.transacoes.limit(0))
    wh.run_interval(empty, end_date="2002-01-01", summary_days=[])
    for t, rows in before.items():
        assert sorted(map(tuple, wh.table(t).collect())) == rows


def test_etl_with_a_hot_client_equals_plain_resolution(spark, scratch):
    from paydw.operators.contracts import resolve_contract
    from paydw.operators.summary import daily_summary

    st = staging_from_sf(spark, "/root/testdata/sf0.001")
    # give a third of all transactions to client 7
    tx = st.transacoes.withColumn(
        "id_cliente", F.when(F.pmod(F.col("id_transacao"), F.lit(3)) == 0, F.lit(7)).otherwise(F.col("id_cliente")))
    hot = Staging(st.clientes, st.contratos, tx)
    wh = Warehouse(spark, scratch, hot_client_share=0.2, salt_buckets=8)
    wh.run_interval(hot, end_date="2002-01-01")
    want = resolve_contract(tx, st.contratos)
    got = wh.fact.drop("mes_ref")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.select(*got.columns).collect()))
    assert sorted(map(tuple, wh.fact_dia.drop("mes_ref").collect())) == \
        sorted(map(tuple, daily_summary(want).collect()))


def test_partial_sums_and_summary_move_their_rows_once(spark, scratch, monkeypatch):
    written, write = {}, DataFrameWriter.parquet

    def noted(self, path, *a, **k):
        written[path] = self._df._jdf.queryExecution().executedPlan().toString().count("Exchange ")
        write(self, path, *a, **k)

    monkeypatch.setattr(DataFrameWriter, "parquet", noted)
    monkeypatch.setattr(warehouse, "SUMMARY_ROWS", 3)  # several ranges
    st = staging_from_sf(spark, "/root/testdata/sf0.001")
    st = Staging(st.clientes, st.contratos, st.transacoes.limit(40))
    wh = Warehouse(spark, scratch)
    wh.run_interval(st, end_date="last")
    moved = {p.removeprefix(f"{scratch}/").split("/")[0]: n for p, n in written.items()}
    assert moved["resumo_parcial"] == 1 and moved["fact_transacoes_dia"] == 1
    want = daily_summary(wh.fact).collect()
    assert want and sorted(map(tuple, want)) == sorted(tuple(r)[:-1] for r in wh.fact_dia.collect())
    wh.recompute_summary([r.data_movimentacao for r in want[:5]])
    assert sorted(map(tuple, want)) == sorted(tuple(r)[:-1] for r in wh.fact_dia.collect())


def test_sums_of_a_type_without_a_value(spark):
    """Narrow partial sums keep what is null: rows without a type, a value or a client."""
    rows = [(1, 1, "payin", None), (1, 1, "payout", 2.0), (1, 2, "payin", None), (1, 3, None, 4.0), (1, 3, "x", 1.0),
            (None, 4, "boleto", 8.0), (1, 5, "boleto", None), (1, 5, "boleto", 3.0)]
    fact = spark.createDataFrame([(c, dt.date(2024, 1, d), 9, t, v) for c, d, t, v in rows],
                                 "id_cliente long, data_movimentacao date, id_contrato long, tipo_transacao string, valor_transacao double")
    parts = partial_summary(fact.where("data_movimentacao < '2024-01-05'")).union(
        partial_summary(fact.where("valor_transacao is null and data_movimentacao > '2024-01-04'"))).union(
        partial_summary(fact.where("valor_transacao = 3")))
    key = lambda r: str(r[:3])
    assert parts.columns[-2:] == ["quantidade", "total"]
    assert sorted(map(tuple, merged_summary(parts).collect()), key=key) == sorted(map(tuple, daily_summary(fact).collect()), key=key)
