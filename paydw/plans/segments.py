"""Client segments."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paydw.functions.money import revenue_amount
from paydw.operators.densify import densify
from paydw.plans.common import sum_money
from paydw.plans.warehouse import Warehouse
from paydw.schemas import TRANSACTION_TYPES


def clients_per_segment(wh: Warehouse) -> DataFrame:
    return wh.clientes.groupBy("segmento").agg(F.count("id_cliente").alias("clientes"))


def _segment_dims(wh: Warehouse) -> DataFrame:
    """contract -> (client, segment, rates): a join of the two dimensions only.

    The summary is then joined once on (contract, client) instead of twice
    (client, then contract): one shuffle of the large side instead of two.
    Same rows as the two joins, because every summary row's contract
    belongs to its client (contract resolution joins on the client).
    """
    cli = wh.clientes.select("id_cliente", "segmento")
    con = wh.contratos.select("id_contrato", "id_cliente", *[f"taxa_{t}" for t in TRANSACTION_TYPES])
    return con.join(cli, "id_cliente")


def transacao_cliente(wh: Warehouse) -> DataFrame:
    """Summary rows with the client's segment and the contract's rates."""
    return wh.fact_dia.drop("mes_ref").join(_segment_dims(wh), ["id_contrato", "id_cliente"])


def daily_with_client_contract(wh: Warehouse) -> DataFrame:
    """Every summary row with its client's attributes and its contract's terms."""
    cli = wh.clientes
    con = wh.contratos.drop("id_cliente")
    fd = wh.fact_dia.drop("mes_ref")
    return fd.join(cli, "id_cliente").join(con, "id_contrato")


def _revenue_row():
    return reduce(add, [revenue_amount(f"taxa_{t}", f"total_{t}") for t in TRANSACTION_TYPES])


def segment_day(wh: Warehouse) -> DataFrame:
    """Per (segment, day): transactions and value."""
    return transacao_cliente(wh).groupBy("segmento", "data_movimentacao").agg(
        F.sum("quantidade_movimentacoes").cast("long").alias("quantidade_movimentacoes"),
        sum_money("total_movimentacao"))


def segment_revenue_day(wh: Warehouse) -> DataFrame:
    """Per (segment, day): revenue = sum over types of rate x value."""
    return transacao_cliente(wh).groupBy("segmento", "data_movimentacao").agg(
        F.sum(_revenue_row()).cast("double").alias("faturamento"))


def segment_day_all(wh: Warehouse) -> DataFrame:
    return transacao_cliente(wh).groupBy("segmento", "data_movimentacao").agg(
        F.sum("quantidade_movimentacoes").cast("long").alias("quantidade_movimentacoes"),
        sum_money("total_movimentacao"),
        F.sum(_revenue_row()).cast("double").alias("faturamento"))


def dense_days(sparse: DataFrame) -> DataFrame:
    """``segment_day_all`` rows on one global day axis (first to last day with data), zero-filled."""
    return densify(sparse, ["segmento"], "data_movimentacao",
                   ["quantidade_movimentacoes", "total_movimentacao", "faturamento"], axis="global")


def segment_day_dense(wh: Warehouse) -> DataFrame:
    """(segment, day) on the dense axis; the segment days are kept while axis and facts read them."""
    return dense_days(segment_day_all(wh).persist(StorageLevel.MEMORY_AND_DISK))
