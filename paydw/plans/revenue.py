"""Revenue per client and day."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paydw.functions.money import amount, as_double, revenue_amount
from paydw.plans.common import sum_money, sum_revenue, with_calendar
from paydw.plans.warehouse import Warehouse
from paydw.schemas import TRANSACTION_TYPES

RATE = {t: f"taxa_{t}" for t in TRANSACTION_TYPES}


def _revenue_rows(wh: Warehouse, months: list[int] | None = None) -> DataFrame:
    """Summary rows (of ``months`` only, if given) with their contract's rates and calendar day.

    The summary holds one row per (client, day, contract), so even a client
    with a third of all transactions adds at most one row per day here.
    """
    fd = wh.fact_dia if months is None else wh.fact_dia.where(F.col("mes_ref").isin(months))
    fd = fd.select("id_cliente", "id_contrato", "data_movimentacao",
                            *[f"total_{t}" for t in TRANSACTION_TYPES])
    c = wh.contratos.select("id_contrato", *RATE.values())
    return with_calendar(fd.join(c, "id_contrato"), wh.tempo)


def revenue_client_day(wh: Warehouse) -> DataFrame:
    """Per (day, client): revenue (rate x value) and value of each type."""
    r = _revenue_rows(wh)
    return r.groupBy("data", "id_cliente").agg(
        *[sum_revenue(RATE[t], f"total_{t}", f"faturamento_{t}") for t in TRANSACTION_TYPES],
        *[sum_money(f"total_{t}") for t in TRANSACTION_TYPES],
    )


def revenue_day(wh: Warehouse, months: list[int] | None = None) -> DataFrame:
    """Per day (of ``months``, as yyyymm, or all): revenue and value of each type and their totals (G5 + P4)."""
    r = _revenue_rows(wh, months)
    rates = {t: revenue_amount(RATE[t], f"total_{t}") for t in TRANSACTION_TYPES}
    values = {t: amount(f"total_{t}") for t in TRANSACTION_TYPES}
    return r.groupBy("data").agg(
        *[as_double(F.sum(rates[t])).alias(f"faturamento_{t}") for t in TRANSACTION_TYPES],
        as_double(F.sum(reduce(add, rates.values()))).alias("faturamento_total"),
        *[as_double(F.sum(values[t])).alias(f"total_{t}") for t in TRANSACTION_TYPES],
        as_double(F.sum(reduce(add, values.values()))).alias("total"),
    )
