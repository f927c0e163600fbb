"""Contract resolution.

Each transaction takes the contract of its client whose expiry is the
*latest* among those expiring on or after the transaction day. A transaction
after every expiry is dropped; ties on the latest expiry keep every tied
contract (one output row each).

The correlated form ``v = (SELECT MAX(v) ... WHERE v >= day)`` decorrelates
into a nested-loop join on the day inequality. It is rewritten with

    max{v : v >= d} = m   if m >= d, else NULL,   m = max(v) per client

so only an equi-join on the client remains: a window partitioned by client
over the contracts keeps those at their client's latest expiry (one row
per client, already hash-partitioned by client), then the transactions are
joined on the client. The big side (transactions) is shuffled once; hot
clients are split by a salted join (``hot_clients``) or AQE's skew join,
and when the contract side is small at runtime AQE turns the join into a
broadcast without any hint.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from paydw.operators.skew import salted_join


def latest_contracts(contratos: DataFrame, max_source: DataFrame | None = None,
                     client: str = "id_cliente",
                     expiry: str = "data_vencimento_contrato") -> DataFrame:
    """Contracts whose expiry equals the latest expiry of their client.

    ``max_source`` is the table the maximum is taken over (the warehouse
    dimension in the reference); it defaults to ``contratos``. One window
    partitioned by client over (max_source rows + candidate rows) gives the
    maximum next to each candidate: a single exchange on the client, and the
    result stays hash-partitioned by client for the join with the
    transactions. A client has a handful of contracts, so a window partition
    stays small even for a client with a third of all transactions.
    """
    w = Window.partitionBy(client)
    # contracts without a client can never match a transaction: dropping them
    # also keeps them from forming one large NULL window partition
    contratos = contratos.where(F.col(client).isNotNull())
    if max_source is None:
        x = contratos.withColumn("_latest", F.max(expiry).over(w))
        return x.where(F.col(expiry) == F.col("_latest")).drop("_latest")
    cand = contratos.withColumn("_cand", F.lit(True))
    ref = max_source.where(F.col(client).isNotNull()).select(
        *[F.col(f.name) if f.name in (client, expiry) else F.lit(None).cast(f.dataType).alias(f.name)
          for f in contratos.schema.fields],
        F.lit(False).alias("_cand"))
    x = cand.unionByName(ref).withColumn(
        "_latest", F.max(F.when(~F.col("_cand"), F.col(expiry))).over(w))
    return x.where(F.col("_cand") & (F.col(expiry) == F.col("_latest"))).drop("_cand", "_latest")


def resolve_contract(transacoes: DataFrame, contratos: DataFrame,
                     max_source: DataFrame | None = None,
                     client: str = "id_cliente", day: str = "data_movimentacao",
                     expiry: str = "data_vencimento_contrato",
                     contract_cols: tuple[str, ...] = ("id_contrato",),
                     hot_clients: list | None = None, salt_buckets: int = 32,
                     row_key: str = "id_transacao", keep_unresolved: bool = False) -> DataFrame:
    """Transactions with the id of the contract in force (columns of ``transacoes`` + ``contract_cols``).

    With ``keep_unresolved`` a transaction without a contract in force stays,
    once, with null contract columns: one join then tells both kinds apart.
    Rows without a client never match and do not go through that join.

    ``hot_clients`` (e.g. from ``skew.hot_keys``) are split over
    ``salt_buckets`` tasks by a salted join; without them the join relies
    on AQE's skew-join handling.
    """
    cand = latest_contracts(contratos, max_source, client, expiry).select(
        client, expiry, *contract_cols)
    if keep_unresolved:
        known = transacoes.where(F.col(client).isNotNull())
        out = salted_join(known, cand, client, hot_clients or [], salt_buckets, [row_key], "left",
                          on=lambda t, c: t[day] <= c[expiry])
        nowhere = transacoes.where(F.col(client).isNull())
        return out.select(*transacoes.columns, *contract_cols).unionByName(nowhere, allowMissingColumns=True)
    if hot_clients:
        joined = salted_join(transacoes, cand, client, hot_clients, salt_buckets, [row_key])
    else:
        joined = transacoes.join(cand, client)
    out = joined.where(F.col(day) <= F.col(expiry))
    return out.select(*transacoes.columns, *contract_cols)
