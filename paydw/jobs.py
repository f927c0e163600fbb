"""Scheduled jobs, one command each (what the reference runs as notebooks).

    python -m paydw.jobs bootstrap     --warehouse W --staging S [--end-date D]
    python -m paydw.jobs interval      --warehouse W --staging S [--end-date D] [--process-date D]
                                       [--start D --end D] [--late ignore] [--clear-staging]
    python -m paydw.jobs daily-summary --warehouse W --process-date D
    python -m paydw.jobs ingest        --warehouse W --incoming F --checkpoint C [--staging S] [--process-date D]
    python -m paydw.jobs export-trends --warehouse W --out O

``S`` holds one parquet folder per staging table (clientes, contratos,
transacoes) with the staging schemas; ``F`` is a folder where transaction
files arrive. A scheduler (cron, a workflow tool) runs these on a cadence;
``ingest`` processes what arrived since its last run and stops. Days before the
process date are closed and summarized; late rows rebuild their month unless
``--late ignore``. ``--start`` and ``--end`` pull one window of transactions
(end exclusive, either may be left out) with all clients and contracts.
``--clear-staging`` removes the files that the run has read, once it has
succeeded; files that arrived meanwhile stay. Where a window leaves rows of
these files unread, the job refuses to start with it.
"""

from __future__ import annotations

import argparse
import datetime as dt

from pyspark.sql import functions as F

from paydw.schemas import STAGING_CLIENTES, STAGING_CONTRATOS, STAGING_TRANSACOES
from paydw.session import get_session
from paydw.sources.driver import Staging
from paydw.sources.staging import clear_staging, in_window, read_staging, staging_files


_SCHEMAS = {"clientes": STAGING_CLIENTES, "contratos": STAGING_CONTRATOS, "transacoes": STAGING_TRANSACOES}
_DAY = "data_movimentacao"


def _staging(spark, path: str, read: dict[str, list[str]], start=None, end=None) -> Staging:
    """The staging tables, of exactly the files in ``read``."""
    tables = {name: read_staging(spark, f"{path}/{name}", schema, names=read[name]) for name, schema in _SCHEMAS.items()}
    return Staging(tables["clientes"], tables["contratos"], tables["transacoes"].where(in_window(_DAY, start, end)))


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="paydw.jobs")
    ap.add_argument("job", choices=["bootstrap", "interval", "daily-summary", "ingest", "export-trends"])
    ap.add_argument("--warehouse", required=True)
    ap.add_argument("--staging")
    ap.add_argument("--incoming")
    ap.add_argument("--checkpoint")
    ap.add_argument("--out")
    ap.add_argument("--end-date", default="today")
    ap.add_argument("--process-date", default=str(dt.date.today()))
    ap.add_argument("--start")
    ap.add_argument("--end")
    ap.add_argument("--late", choices=["recompute", "ignore"], default="recompute")
    ap.add_argument("--clear-staging", action="store_true")
    ap.add_argument("--master")
    a = ap.parse_args(argv)

    from paydw.plans.warehouse import Warehouse

    spark = get_session(a.master)
    wh = Warehouse(spark, a.warehouse)
    start, end = (dt.date.fromisoformat(d) if d else None for d in (a.start, a.end))
    if a.job in ("bootstrap", "interval"):
        read = {name: staging_files(spark, f"{a.staging}/{name}") for name in _SCHEMAS}
    if a.job == "bootstrap":
        wh.bootstrap(_staging(spark, a.staging, read), end_date=a.end_date)
    elif a.job == "interval":
        if a.clear_staging and (start or end):
            whole = read_staging(spark, f"{a.staging}/transacoes", STAGING_TRANSACOES, names=read["transacoes"])
            if whole.where(~F.coalesce(in_window(_DAY, start, end), F.lit(False))).limit(1).count():
                ap.error("--clear-staging: the window leaves rows of the staging files unread")
        wh.run_interval(_staging(spark, a.staging, read, start, end), end_date=a.end_date,
                        process_date=a.process_date, late=a.late)
        if a.clear_staging:
            for name, names in read.items():
                clear_staging(spark, f"{a.staging}/{name}", names)
    elif a.job == "daily-summary":
        wh.daily_summary_job(a.process_date)
    elif a.job == "ingest":
        from paydw.streaming.ingest import staging_stream

        if not a.checkpoint:
            ap.error("ingest needs --checkpoint, a folder that outlives the run")
        if a.staging:
            wh.load_clientes(read_staging(spark, f"{a.staging}/clientes", STAGING_CLIENTES))
            wh.load_contratos(read_staging(spark, f"{a.staging}/contratos", STAGING_CONTRATOS))
        stream = staging_stream(spark, a.incoming, STAGING_TRANSACOES)
        wh.ingest(stream, a.checkpoint, a.process_date, late=a.late).awaitTermination()
    elif a.job == "export-trends":
        from paydw.plans import trends
        from paydw.sources.sinks import export_trend_csv

        export_trend_csv(trends.trend_predictions(wh), f"{a.out}/valor")
        export_trend_csv(trends.trend_predictions_revenue(wh), f"{a.out}/faturamento")
        seg = trends.trend_predictions_segment(wh)
        for medida in ("quantidade", "valor", "faturamento"):
            export_trend_csv(seg.where(F.col("medida") == medida), f"{a.out}/segmento_{medida}")


if __name__ == "__main__":
    main()
