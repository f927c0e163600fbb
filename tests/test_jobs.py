"""Scheduled job commands: bootstrap + interval equal a one-shot build."""

from pyspark.sql import functions as F

from paydw.jobs import main
from paydw.plans.warehouse import Warehouse
from paydw.sources.driver import staging_from_sf

SF = "/root/testdata/sf0.001"


def test_bootstrap_then_interval_equals_one_shot(spark, scratch):
    st = staging_from_sf(spark, SF)
    cut = F.col("data_movimentacao") < F.lit("1999-01-01").cast("date")
    for name, df in (("clientes", st.clientes), ("contratos", st.contratos)):
        df.write.parquet(f"{scratch}/s1/{name}")
        df.write.parquet(f"{scratch}/s2/{name}")
    st.transacoes.where(cut).write.parquet(f"{scratch}/s1/transacoes")
    st.transacoes.where(~cut).write.parquet(f"{scratch}/s2/transacoes")
    main(["bootstrap", "--warehouse", f"{scratch}/dw", "--staging", f"{scratch}/s1", "--end-date", "2002-01-01"])
    main(["interval", "--warehouse", f"{scratch}/dw", "--staging", f"{scratch}/s2", "--end-date", "2002-01-01"])
    one = Warehouse(spark, f"{scratch}/one")
    one.bootstrap(st, end_date="2002-01-01")
    inc = Warehouse(spark, f"{scratch}/dw")
    for t in ("fact_transacoes", "fact_transacoes_dia", "dim_tempo", "dim_clientes", "dim_contratos"):
        assert sorted(map(tuple, inc.table(t).collect())) == sorted(map(tuple, one.table(t).collect())), t


def test_export_trends_writes_every_family(spark, scratch):
    import glob
    import os

    from paydw.plans.warehouse import warehouse_for_sf

    wh = warehouse_for_sf(spark, SF)
    main(["export-trends", "--warehouse", wh.path, "--out", f"{scratch}/exp"])
    root = scratch[5:] if scratch.startswith("file:") else scratch
    for fam in ("valor", "faturamento", "segmento_quantidade", "segmento_valor", "segmento_faturamento"):
        dirs = glob.glob(os.path.join(root, "exp", fam, "serie=*"))
        assert len(dirs) >= 4, fam


def test_ingest_and_daily_summary_commands(spark, scratch):
    st = staging_from_sf(spark, SF)
    cut = F.col("data_movimentacao") < F.lit("1999-01-01").cast("date")
    for name, df in (("clientes", st.clientes), ("contratos", st.contratos)):
        df.write.parquet(f"{scratch}/s1/{name}")
    st.transacoes.where(cut).write.parquet(f"{scratch}/s1/transacoes")
    main(["bootstrap", "--warehouse", f"{scratch}/dw", "--staging", f"{scratch}/s1", "--end-date", "2002-01-01"])
    st.transacoes.where(~cut).write.parquet(f"{scratch}/incoming/part=1")
    main(["ingest", "--warehouse", f"{scratch}/dw", "--incoming", f"{scratch}/incoming/*",
          "--checkpoint", f"{scratch}/ck"])
    one = Warehouse(spark, f"{scratch}/one")
    one.bootstrap(st, end_date="2002-01-01")
    inc = Warehouse(spark, f"{scratch}/dw")
    for t in ("fact_transacoes", "fact_transacoes_dia"):
        assert sorted(map(tuple, inc.table(t).collect())) == sorted(map(tuple, one.table(t).collect())), t
    # the previous-day job over a day already summarized changes nothing
    day = inc.fact.agg(F.max("data_movimentacao")).first()[0]
    before = inc.fact_dia.count()
    main(["daily-summary", "--warehouse", f"{scratch}/dw", "--process-date", str(day + __import__("datetime").timedelta(days=1))])
    assert inc.fact_dia.count() == before
