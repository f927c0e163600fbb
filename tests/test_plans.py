"""Plan parameters (F1, F2), export sink (K7), bootstrap (K9) and the X3 job."""

import datetime as dt
import glob
import os

from pyspark.sql import functions as F

from paydw.plans import trends, usage, volume
from paydw.plans.warehouse import Warehouse, warehouse_for_sf
from paydw.sources.driver import Staging, staging_from_sf
from paydw.sources.sinks import export_trend_csv

SF = "/root/testdata/sf0.001"


def test_client_filter_equals_filtered_result(spark):
    wh = warehouse_for_sf(spark, SF)
    cid = wh.fact_dia.select("id_cliente").first()[0]
    a = sorted(map(tuple, volume.volume_client_day(wh, id_cliente=cid).collect()))
    b = sorted(map(tuple, volume.volume_client_day(wh).where(F.col("id_cliente") == cid).collect()))
    assert a == b and len(a) > 0


def test_year_filter_prunes_and_matches(spark):
    wh = warehouse_for_sf(spark, SF)
    a = usage.usage_client_day_type(wh, ano=1998)
    b = usage.usage_client_day_type(wh).where(F.col("ano") == 1998)
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))
    plan = a._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan or "mes_ref" in plan


def test_usage_dense_marks_sundays_and_idle_days(spark):
    wh = warehouse_for_sf(spark, SF)
    d = usage.usage_dense(wh, start="1998-01-01", end="1998-03-31")
    rows = d.collect()
    assert {r.data_movimentacao.isoweekday() == 7 for r in rows if r.is_domingo} == {True}
    assert all(r.uso == (r.quantidade_movimentacoes > 0) for r in rows)
    n_clients = d.select("id_cliente").distinct().count()
    assert len(rows) == n_clients * 90


def test_export_trend_csv(spark, scratch):
    wh = warehouse_for_sf(spark, SF)
    export_trend_csv(trends.trend_predictions(wh), scratch + "/rl")
    if scratch.startswith("file:"):
        scratch = scratch[5:]
    files = glob.glob(os.path.join(scratch, "rl", "serie=total", "*.csv"))
    assert files
    lines = open(files[0]).read().splitlines()
    assert lines[0] == "data_movimentacao,prediction"
    assert lines[1].endswith(tuple("0123456789")) and "T00:00:00Z," in lines[1]


def test_bootstrap_and_previous_day_job(spark, scratch):
    st = staging_from_sf(spark, SF)
    wh = Warehouse(spark, scratch)
    wh.create_tables()
    assert wh.clientes.count() == 0 and wh.clientes.schema["id_cliente"].dataType.typeName() == "long"
    first_day = st.transacoes.agg(F.min("data_movimentacao")).first()[0]
    cut = F.col("data_movimentacao") <= F.lit(first_day + dt.timedelta(days=100))
    wh.run_interval(Staging(st.clientes, st.contratos, st.transacoes.where(cut)), end_date="2002-01-01")
    nxt = st.transacoes.where(~cut).agg(F.min("data_movimentacao")).first()[0]
    day = Staging(st.clientes, st.contratos, st.transacoes.where(F.col("data_movimentacao") == nxt))
    wh.run_interval(day, end_date="2002-01-01", summarize=False)
    before = wh.fact_dia.where(F.col("data_movimentacao") == nxt).count()
    wh.daily_summary_job(nxt + dt.timedelta(days=1))
    after = wh.fact_dia.where(F.col("data_movimentacao") == nxt).count()
    expect = wh.fact.where(F.col("data_movimentacao") == nxt).select("id_cliente", "id_contrato").distinct().count()
    assert before == 0 and after == expect > 0


def test_staging_readers_enforce_schema_and_window(spark, scratch):
    from paydw.schemas import STAGING_TRANSACOES
    from paydw.sources.staging import read_staging, read_staging_window

    rows = [(1, 7, "payin", 10.5, dt.date(2024, 1, d), dt.datetime(2024, 1, d, 9)) for d in (1, 2, 3)]
    spark.createDataFrame(rows, STAGING_TRANSACOES).write.option("header", True).csv(scratch + "/csv")
    df = read_staging(spark, scratch + "/csv", STAGING_TRANSACOES, fmt="csv")
    assert df.schema == STAGING_TRANSACOES
    assert sorted(r.data_movimentacao.day for r in df.collect()) == [1, 2, 3]
    w = read_staging_window(spark, scratch + "/csv", STAGING_TRANSACOES, "data_movimentacao",
                            "2024-01-02", "2024-01-03", fmt="csv")
    assert [r.data_movimentacao.day for r in w.collect()] == [2]
    spark.createDataFrame(rows, STAGING_TRANSACOES).write.parquet(scratch + "/pq")
    wp = read_staging_window(spark, scratch + "/pq", STAGING_TRANSACOES, "data_movimentacao",
                             "2024-01-02", "2024-01-04")
    plan = wp._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(data_movimentacao" in plan and wp.count() == 2


def test_jdbc_day_predicates_and_cluster_conf():
    from paydw.session import cluster_conf
    from paydw.sources.staging import jdbc_day_predicates

    p = jdbc_day_predicates("data_movimentacao", ["2024-02-28", dt.date(2024, 2, 29)])
    assert p == ["data_movimentacao >= DATE '2024-02-28' AND data_movimentacao < DATE '2024-02-29'",
                 "data_movimentacao >= DATE '2024-02-29' AND data_movimentacao < DATE '2024-03-01'"]
    c = cluster_conf(4000, shuffle_bytes=100 * 2**40)
    assert int(c["spark.sql.shuffle.partitions"]) == 409600          # 100 TB at 256 MB
    assert int(cluster_conf(4000)["spark.sql.shuffle.partitions"]) == 12000   # three task waves
    assert c["spark.sql.adaptive.skewJoin.enabled"] == "true"
