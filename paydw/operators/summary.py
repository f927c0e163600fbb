"""Daily summary (G1): conditional aggregation per (client, day, contract).

One hash aggregate with partial (map-side) aggregation: a hot client or day
is combined inside each map task before the shuffle, so the shuffle carries
at most one row per group per task.

The same aggregate in two steps: ``partial_summary`` gives counts and decimal
sums by group and type, which can be added up in any order; ``merged_summary``
adds them up and turns sums into DOUBLE once. A run's partial rows stand for its
transactions, so late ones change a day without another look at the fact table.
They are narrow (one count and one sum a row), as most groups have one type.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paydw.functions.money import AMOUNT_TYPE, amount, as_double

SUMMARY_GROUP = ("id_cliente", "data_movimentacao", "id_contrato")
# column order of the summary table
SUMMARY_TYPE_ORDER = ("payin", "payout", "boleto")


def summary_aggs(type_col: str = "tipo_transacao", value_col: str = "valor_transacao",
                 count_col: str = "id_cliente") -> list:
    t = F.col(type_col)
    v = amount(value_col)
    aggs = [F.count(count_col).cast("int").alias("quantidade_movimentacoes")]
    aggs += [F.sum(F.when(t == typ, 1).otherwise(0)).cast("int").alias(f"quantidade_{typ}")
             for typ in SUMMARY_TYPE_ORDER]
    aggs.append(as_double(F.sum(v)).alias("total_movimentacao"))
    aggs += [as_double(F.sum(F.when(t == typ, v).otherwise(F.lit(0).cast(AMOUNT_TYPE))))
             .alias(f"total_{typ}") for typ in SUMMARY_TYPE_ORDER]
    return aggs


def daily_summary(fact: DataFrame, group: tuple[str, ...] = SUMMARY_GROUP) -> DataFrame:
    """``fact_transacoes_dia`` rows from resolved transactions."""
    return fact.groupBy(*group).agg(*summary_aggs())


def partial_summary(fact: DataFrame, group: tuple[str, ...] = SUMMARY_GROUP) -> DataFrame:
    """Count and exact sum per group and type, to be added up with those of other runs."""
    return fact.groupBy(*group, "tipo_transacao").agg(
        F.count(F.lit(1)).alias("quantidade"), F.sum(amount("valor_transacao")).alias("total"))


def merged_summary(partials: DataFrame, group: tuple[str, ...] = SUMMARY_GROUP) -> DataFrame:
    """``daily_summary`` of all the transactions that ``partials`` stand for."""
    t, none = F.col("tipo_transacao"), F.lit(0).cast(AMOUNT_TYPE)
    named = F.col("id_cliente").isNotNull()  # a row without a client is not counted
    return partials.groupBy(*group).agg(
        F.sum(F.when(named, F.col("quantidade")).otherwise(0)).cast("int").alias("quantidade_movimentacoes"),
        *[F.sum(F.when(t == typ, F.col("quantidade")).otherwise(0)).cast("int").alias(f"quantidade_{typ}")
          for typ in SUMMARY_TYPE_ORDER],
        as_double(F.sum("total")).alias("total_movimentacao"),
        *[as_double(F.sum(F.when(t == typ, F.col("total")).otherwise(none))).alias(f"total_{typ}")
          for typ in SUMMARY_TYPE_ORDER])
