"""Roles of the driver tables in the payments star schema.

The test data has no payments tables, so staging tables are derived from it
by fixed rules (plain column expressions, no shuffle):

* clients      <- ``customer``
* contracts    <- ``customer`` x k in {1, 2}, except k = 2 when c_custkey % 7 = 0
* transactions <- ``orders``
* use events   <- ``events`` (a second, denser source of use days)
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the role mapping.
STATUS_TO_TYPE = {"F": "payin", "O": "payout"}  # any other status -> "boleto"
CONTRACT_BASE_DATE = "1997-01-01"
CLIENT_BASE_DATE = "1995-01-01"


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def staging_clientes(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _read(spark, sf_dir, "customer")
    return c.select(
        F.col("c_custkey").cast("long").alias("id"),
        F.col("c_name").alias("razao_social"),
        F.date_add(F.lit(CLIENT_BASE_DATE).cast("date"),
                   F.pmod(F.col("c_custkey"), F.lit(365)).cast("int")).alias("data_inicio_relacionamento"),
        F.lit("ativo").alias("status"),
        F.lit(None).cast("date").alias("data_fim_relacionamento"),
        F.col("c_mktsegment").alias("segmento"),
    )


def staging_contratos(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _read(spark, sf_dir, "customer").select(F.col("c_custkey").cast("long").alias("c"))
    k = F.col("k")
    base = F.lit(CONTRACT_BASE_DATE).cast("date")
    return (
        c.withColumn("k", F.explode(F.array(F.lit(1), F.lit(2))))
        .where(~((k == 2) & (F.pmod(F.col("c"), F.lit(7)) == 0)))
        .select(
            (F.col("c") * 10 + k).alias("id_contrato"),
            F.col("c").alias("id_cliente"),
            ((F.pmod(F.col("c"), F.lit(4)) + 1) / 2.0).cast("double").alias("taxa_payout"),
            ((F.pmod(F.col("c"), F.lit(3)) + 1) / 4.0).cast("double").alias("taxa_payin"),
            ((F.pmod(F.col("c"), F.lit(5)) + 1) / 2.0).cast("double").alias("taxa_boleto"),
            F.date_add(base, (F.pmod(F.col("c") * 37, F.lit(1000)) + k * 800).cast("int"))
            .alias("data_vencimento_contrato"),
        )
    )


def transaction_type(status) -> "F.Column":
    expr = F.lit("boleto")
    for s, t in reversed(list(STATUS_TO_TYPE.items())):
        expr = F.when(status == s, t).otherwise(expr)
    return expr


def staging_transacoes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orders_to_transacoes(_read(spark, sf_dir, "orders"))


def orders_to_transacoes(o: DataFrame) -> DataFrame:
    """Staging transaction columns from ``orders`` rows (batch or streaming)."""
    return o.select(
        F.col("o_orderkey").cast("long").alias("id_transacao"),
        F.col("o_custkey").cast("long").alias("id_cliente"),
        transaction_type(F.col("o_orderstatus")).alias("tipo_transacao"),
        F.col("o_totalprice").cast("double").alias("valor_transacao"),
        F.to_date(F.col("o_orderdate")).alias("data_movimentacao"),
        F.col("o_orderdate").alias("hora_movimentacao"),
    )


def use_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Use events (client, timestamp, value) from the ``events`` table."""
    e = _read(spark, sf_dir, "events")
    return e.select(
        F.col("user_id").cast("long").alias("id_cliente"),
        F.col("ts").alias("hora_movimentacao"),
        F.to_date(F.col("ts")).alias("data_movimentacao"),
        F.col("event_type"),
        F.col("value").cast("double").alias("valor"),
    )


@dataclass(frozen=True)
class Staging:
    clientes: DataFrame
    contratos: DataFrame
    transacoes: DataFrame


def staging_from_sf(spark: SparkSession, sf_dir: str) -> Staging:
    return Staging(
        staging_clientes(spark, sf_dir),
        staging_contratos(spark, sf_dir),
        staging_transacoes(spark, sf_dir),
    )
