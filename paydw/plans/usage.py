"""Product use per client and day."""

from __future__ import annotations

import calendar as _cal
import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paydw.functions.calendar import is_sunday
from paydw.operators.densify import densify
from paydw.operators.series import streaks, use_gaps
from paydw.plans.common import months_between_filter, sum_money, with_calendar, year_filter
from paydw.plans.warehouse import Warehouse
from paydw.schemas import TRANSACTION_TYPES


def usage_client_day_type(wh: Warehouse, ano: int | None = None) -> DataFrame:
    """Per (client, day, dia, mes, ano, type): value moved and number of transactions."""
    fact = wh.fact.select("id_cliente", "tipo_transacao", "valor_transacao",
                          "data_movimentacao", "mes_ref")
    tempo = wh.tempo
    if ano is not None:
        fact = fact.where(year_filter(ano))  # partition pruning on the fact table
        tempo = tempo.where(F.col("ano") == ano)
    j = with_calendar(fact, tempo)
    return j.groupBy("id_cliente", "data", "dia", "mes", "ano", "tipo_transacao").agg(
        sum_money("valor_transacao", "total_movimentacao"),
        F.count("id_cliente").alias("quantidade_movimentacoes"),
    )


def usage_window_bounds(wh: Warehouse, today=None) -> tuple[_dt.date, _dt.date]:
    """The reference window: 3 months before ``today`` to 1 month before, inclusive.

    ``today`` defaults to the last day of the calendar (deterministic runs).
    """
    if today is None:
        today = wh.tempo.agg(F.max("data").alias("m")).first()["m"]
    if isinstance(today, str):
        today = _dt.date.fromisoformat(today)

    return _minus_months(today, 3), _minus_months(today, 1)


def _minus_months(d: _dt.date, k: int) -> _dt.date:
    """``d`` minus ``k`` months, clamped to the last day of the month (as add_months)."""
    y, m = divmod(d.year * 12 + d.month - 1 - k, 12)
    m += 1
    return _dt.date(y, m, min(d.day, _cal.monthrange(y, m)[1]))


def usage_window(wh: Warehouse, start=None, end=None, today=None) -> DataFrame:
    """G3 rows of the window [start, end] (both ends inclusive, F3), days with use only."""
    if start is None or end is None:
        start, end = usage_window_bounds(wh, today)
    fact = wh.fact.select("id_cliente", "tipo_transacao", "valor_transacao", "data_movimentacao", "mes_ref")
    d = F.col("data_movimentacao")
    fact = fact.where(months_between_filter(start, end)
                      & (d >= F.lit(str(start)).cast("date")) & (d <= F.lit(str(end)).cast("date")))
    j = with_calendar(fact, wh.tempo)
    return j.groupBy("id_cliente", "data", "dia", "mes", "ano", "tipo_transacao").agg(
        sum_money("valor_transacao", "total_movimentacao"),
        F.count("id_cliente").alias("quantidade_movimentacoes"),
    )


def usage_dense(wh: Warehouse, start=None, end=None, today=None) -> DataFrame:
    """Per client active in [start, end] and every day of it: use and value, 0 when idle."""
    if start is None or end is None:
        start, end = usage_window_bounds(wh, today)
    d = F.col("data_movimentacao")
    fd = (wh.fact_dia.where(months_between_filter(start, end)
                            & (d >= F.lit(str(start)).cast("date"))
                            & (d <= F.lit(str(end)).cast("date")))
          .groupBy("id_cliente", "data_movimentacao")
          .agg(F.sum("quantidade_movimentacoes").cast("long").alias("quantidade_movimentacoes"),
               *[F.sum(f"quantidade_{t}").cast("long").alias(f"quantidade_{t}")
                 for t in TRANSACTION_TYPES],
               sum_money("total_movimentacao")))
    measures = ["quantidade_movimentacoes", *[f"quantidade_{t}" for t in TRANSACTION_TYPES],
                "total_movimentacao"]
    dense = densify(fd, ["id_cliente"], "data_movimentacao", measures, start=start, end=end)
    return dense.withColumns({"uso": F.col("quantidade_movimentacoes") > 0,
                              "is_domingo": is_sunday(F.col("data_movimentacao"))})


def usage_gaps(wh: Warehouse) -> DataFrame:
    """Per client and use day: previous use day and idle days in between."""
    # one shuffle by client serves both the distinct and the per-client window
    days = wh.fact_dia.select("id_cliente", "data_movimentacao").repartition("id_cliente").distinct()
    return use_gaps(days, ["id_cliente"], "data_movimentacao")


def usage_streaks(wh: Warehouse) -> DataFrame:
    """Per client the runs of consecutive days with use and the idle runs between them."""
    days = wh.fact_dia.select("id_cliente", "data_movimentacao").repartition("id_cliente").distinct()
    return streaks(days, ["id_cliente"], "data_movimentacao")


def event_streaks(events: DataFrame) -> DataFrame:
    """``usage_streaks`` of the use-event source; raw events are reduced to days before they meet by client."""
    return streaks(events.select("id_cliente", "data_movimentacao").distinct(), ["id_cliente"], "data_movimentacao")


def usage_pivot_type(wh: Warehouse) -> DataFrame:
    """One row per (client, day) with the transaction count of each type.

    Long -> wide as conditional counts in one aggregate over the fact rows
    (one shuffle); pivoting the per-type rows (``pivot_types``) gives the same
    table with two more shuffles.
    """
    fact = wh.fact.select("id_cliente", "tipo_transacao", "data_movimentacao")
    j = with_calendar(fact, wh.tempo)
    t = F.col("tipo_transacao")
    return j.groupBy("id_cliente", "data").agg(
        *[F.sum(F.when(t == x, 1).otherwise(0)).cast("long").alias(x) for x in TRANSACTION_TYPES])


def event_use_days(spark, events: DataFrame) -> DataFrame:
    """Use days and gaps from the use-event source: per (client, day) events and value.

    Raw events are aggregated with partial (map-side) aggregation before the
    shuffle, so a client with a third of all events adds one row per task;
    the per-client window then runs over one row per client and day.
    """
    per_day = events.groupBy("id_cliente", "data_movimentacao").agg(
        F.count(F.lit(1)).alias("eventos"), sum_money("valor", "valor_total"))
    return use_gaps(per_day, ["id_cliente"], "data_movimentacao")
