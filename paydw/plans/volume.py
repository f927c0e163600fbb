"""Volume per client and day by type."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paydw.operators.series import moving_average
from paydw.plans.common import drop_partition, with_calendar
from paydw.plans.warehouse import Warehouse

QTY = ("quantidade_boleto", "quantidade_payout", "quantidade_payin")


def volume_client_day(wh: Warehouse, id_cliente: int | None = None,
                      by_client: bool = False) -> DataFrame:
    """Per (day, client): summed quantities of boleto, payout, payin.

    ``by_client`` hash-partitions the summary rows by client first, so that
    the aggregate and a later per-client window share one shuffle (the rows
    are already daily, so a client adds at most a few rows a day).
    """
    fd = wh.fact_dia.select("id_cliente", "data_movimentacao", *QTY)
    if id_cliente is not None:
        fd = fd.where(F.col("id_cliente") == id_cliente)
    if by_client:
        fd = fd.repartition("id_cliente")
    j = with_calendar(fd, wh.tempo)
    return j.groupBy("data", "id_cliente").agg(*[F.sum(q).cast("long").alias(q) for q in QTY])


def volume_moving_avg(wh: Warehouse, window: int = 5, id_cliente: int | None = None) -> DataFrame:
    """G2 with a trailing ``window``-row mean per client, ordered by day."""
    v = volume_client_day(wh, id_cliente, by_client=True)
    out = moving_average(v, ["id_cliente"], "data", list(QTY), window=window)
    return out.withColumnsRenamed({f"{q}_media_movel": f"media_movel_{q.split('_')[1]}" for q in QTY})


def daily_join_calendar(wh: Warehouse, mes: int = 4, dia_min: int = 5, dia_max: int = 20) -> DataFrame:
    """Summary rows of days with mes = ``mes`` and dia_min < dia < dia_max (README sample)."""
    t = wh.tempo.where((F.col("mes") == mes) & (F.col("dia") > dia_min) & (F.col("dia") < dia_max))
    # the filter on the calendar prunes the summary's months at run time
    return drop_partition(with_calendar(wh.fact_dia, t))


def daily_with_calendar(wh: Warehouse) -> DataFrame:
    """Every summary row with its calendar attributes (J1), the base of the volume views."""
    return drop_partition(with_calendar(wh.fact_dia, wh.tempo))


def date_bounds(wh: Warehouse) -> DataFrame:
    """First day, last day and number of distinct days with data."""
    d = F.col("data_movimentacao")
    return wh.fact_dia.agg(F.min(d).alias("primeiro_dia"), F.max(d).alias("ultimo_dia"),
                           F.countDistinct(d).alias("dias_com_dados"))
