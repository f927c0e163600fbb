"""Analyses proposed by the reference but not coded there."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paydw.functions.money import amount, as_double
from paydw.plans.common import sum_money, with_calendar
from paydw.plans.segments import segment_day, transacao_cliente
from paydw.plans.warehouse import Warehouse
from paydw.schemas import TRANSACTION_TYPES


def type_by_segment(wh: Warehouse) -> DataFrame:
    """Per (segment, type, day): transactions and value (E1), from the summary."""
    t = transacao_cliente(wh)
    pairs = ", ".join(f"'{x}', quantidade_{x}, total_{x}" for x in TRANSACTION_TYPES)
    long = t.select("segmento", "data_movimentacao",
                    F.expr(f"stack({len(TRANSACTION_TYPES)}, {pairs}) AS (tipo_transacao, quantidade, total)"))
    return long.groupBy("segmento", "tipo_transacao", "data_movimentacao").agg(
        F.sum("quantidade").cast("long").alias("quantidade_movimentacoes"),
        sum_money("total", "total_movimentacao"))


def movement_cube(wh: Warehouse) -> DataFrame:
    """Transactions and value by segment, type and month at all levels of the three.

    ``nivel`` is the grouping id (0: all three, 7: the grand total). The
    rows are added up to the finest level first, which is as small as the
    domain; the cube then multiplies these few rows and not the summary's.
    """
    t = transacao_cliente(wh)
    pairs = ", ".join(f"'{x}', quantidade_{x}, total_{x}" for x in TRANSACTION_TYPES)
    d = F.col("data_movimentacao")
    fine = t.select("segmento", (F.year(d) * 100 + F.month(d)).alias("mes_ref"),
                    F.expr(f"stack({len(TRANSACTION_TYPES)}, {pairs}) AS (tipo_transacao, quantidade, total)")) \
        .groupBy("segmento", "tipo_transacao", "mes_ref") \
        .agg(F.sum("quantidade").alias("q"), F.sum(amount("total")).alias("v"))
    return fine.cube("segmento", "tipo_transacao", "mes_ref").agg(
        F.grouping_id().cast("int").alias("nivel"), F.sum("q").cast("long").alias("quantidade_movimentacoes"),
        as_double(F.sum("v")).alias("total_movimentacao"))


def client_profile(wh: Warehouse) -> DataFrame:
    """Per client: share of each type in its transactions against its segment's mean share."""
    t = transacao_cliente(wh)
    per = t.groupBy("id_cliente", "segmento").agg(
        F.sum("quantidade_movimentacoes").cast("long").alias("quantidade_movimentacoes"),
        *[F.sum(f"quantidade_{x}").cast("long").alias(f"quantidade_{x}") for x in TRANSACTION_TYPES])
    tot = F.col("quantidade_movimentacoes").cast("double")
    per = per.select("id_cliente", "segmento", "quantidade_movimentacoes",
                     *[(F.col(f"quantidade_{x}").cast("double") / tot).alias(f"participacao_{x}")
                       for x in TRANSACTION_TYPES])
    seg = per.groupBy("segmento").agg(*[F.avg(f"participacao_{x}").alias(f"_media_{x}")
                                        for x in TRANSACTION_TYPES])
    out = per.join(seg, "segmento")
    return out.select(
        "id_cliente", "segmento", "quantidade_movimentacoes",
        *[F.round(f"participacao_{x}", 8).alias(f"participacao_{x}") for x in TRANSACTION_TYPES],
        *[F.round(F.col(f"participacao_{x}") - F.col(f"_media_{x}"), 8).alias(f"desvio_{x}")
          for x in TRANSACTION_TYPES])


def weekday_seasonality(wh: Warehouse) -> DataFrame:
    """Per (segment, weekday): days observed, mean transactions and mean value a day."""
    return _seasonality(wh, "dia_da_semana")


def month_seasonality(wh: Warehouse) -> DataFrame:
    """Per (segment, calendar month): days observed, mean transactions and mean value a day."""
    return _seasonality(wh, "mes")


def _seasonality(wh: Warehouse, attr: str) -> DataFrame:
    sd = with_calendar(segment_day(wh), wh.tempo)
    n = F.count(F.lit(1))
    return sd.groupBy("segmento", attr).agg(
        n.alias("dias"),
        (F.sum("quantidade_movimentacoes").cast("double") / n).alias("quantidade_media"),
        (as_double(F.sum(amount("total_movimentacao"))) / n)
        .alias("valor_medio"))
