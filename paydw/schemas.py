"""Explicit schemas of the star schema and the staging tables."""

from pyspark.sql.types import (
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)


def _schema(*fields):
    return StructType([StructField(n, t, True) for n, t in fields])


# Staging tables as they arrive from the operational database.
STAGING_CLIENTES = _schema(
    ("id", LongType()),
    ("razao_social", StringType()),
    ("data_inicio_relacionamento", DateType()),
    ("status", StringType()),
    ("data_fim_relacionamento", DateType()),
    ("segmento", StringType()),
)

STAGING_CONTRATOS = _schema(
    ("id_contrato", LongType()),
    ("id_cliente", LongType()),
    ("taxa_payout", DoubleType()),
    ("taxa_payin", DoubleType()),
    ("taxa_boleto", DoubleType()),
    ("data_vencimento_contrato", DateType()),
)

STAGING_TRANSACOES = _schema(
    ("id_transacao", LongType()),
    ("id_cliente", LongType()),
    ("tipo_transacao", StringType()),
    ("valor_transacao", DoubleType()),
    ("data_movimentacao", DateType()),
    ("hora_movimentacao", TimestampType()),
)

# Warehouse tables.
DIM_CLIENTES = _schema(
    ("id_cliente", LongType()),
    ("razao_social", StringType()),
    ("data_inicio_relacionamento", DateType()),
    ("status", StringType()),
    ("data_fim_relacionamento", DateType()),
    ("segmento", StringType()),
)

DIM_CONTRATOS = STAGING_CONTRATOS

DIM_TEMPO = StructType(
    [StructField("data", DateType(), True)]
    + [
        StructField(n, IntegerType(), True)
        for n in ("ano", "mes", "dia", "dia_da_semana", "dia_do_ano", "trimestre")
    ]
)

FACT_TRANSACOES = _schema(
    ("id_transacao", LongType()),
    ("id_cliente", LongType()),
    ("id_contrato", LongType()),
    ("tipo_transacao", StringType()),
    ("valor_transacao", DoubleType()),
    ("data_movimentacao", DateType()),
    ("hora_movimentacao", TimestampType()),
)

FACT_TRANSACOES_DIA = _schema(
    ("id_cliente", LongType()),
    ("data_movimentacao", DateType()),
    ("id_contrato", LongType()),
    ("quantidade_movimentacoes", IntegerType()),
    ("quantidade_payin", IntegerType()),
    ("quantidade_payout", IntegerType()),
    ("quantidade_boleto", IntegerType()),
    ("total_movimentacao", DoubleType()),
    ("total_payin", DoubleType()),
    ("total_payout", DoubleType()),
    ("total_boleto", DoubleType()),
)

# Fixed values of the data model.
TRANSACTION_TYPES = ("boleto", "payin", "payout")

# Month partition column written next to the fact tables (yyyymm).
MONTH_PARTITION = "mes_ref"

# Merge keys of the warehouse tables.
KEYS = {
    "dim_clientes": ("id_cliente",),
    "dim_contratos": ("id_contrato",),
    "dim_tempo": ("data",),
    "fact_transacoes": ("id_transacao", "id_cliente"),
    "fact_transacoes_dia": ("id_cliente", "data_movimentacao"),
}
