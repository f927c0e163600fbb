"""Contract resolution (J5) and insert-only merge (K1-K5) on handmade rows."""

import datetime as dt

from pyspark.sql import functions as F

from paydw.operators.contracts import resolve_contract
from paydw.operators.merge import insert_only_merge
from paydw.schemas import STAGING_CONTRATOS, STAGING_TRANSACOES

D = dt.date.fromisoformat


def _contracts(spark, rows):
    return spark.createDataFrame(
        [(cid, cli, 0.5, 0.25, 1.0, D(v)) for cid, cli, v in rows], STAGING_CONTRATOS)


def _tx(spark, rows):
    return spark.createDataFrame(
        [(tid, cli, "payin", 10.0, D(d), dt.datetime.fromisoformat(d + "T10:00:00")) for tid, cli, d in rows],
        STAGING_TRANSACOES)


def by_rule(tx, con):
    """(transaction, contract) by the rule itself: of the client's contracts none expires later, and the day is not past it."""
    con = [c for c in con.collect() if c.id_cliente is not None and c.data_vencimento_contrato is not None]
    out = []
    for t in tx.collect():
        own = [c for c in con if c.id_cliente == t.id_cliente]
        out += [(t.id_transacao, c.id_contrato) for c in own if t.data_movimentacao is not None
                and t.data_movimentacao <= c.data_vencimento_contrato
                and not any(x.data_vencimento_contrato > c.data_vencimento_contrato for x in own)]
    return sorted(out)


CONTRACTS = [(11, 1, "2024-02-01"), (12, 1, "2024-12-31"),
             (21, 2, "2024-06-01"), (22, 2, "2024-06-01"),
             (31, 3, "2024-06-01"), (41, 4, "2024-05-10")]
TX = [(1, 1, "2024-01-01"), (2, 1, "2024-03-01"), (3, 2, "2024-01-05"),
      (4, 3, "2025-01-01"), (5, 4, "2024-05-10")]


def _resolved(spark):
    out = resolve_contract(_tx(spark, TX), _contracts(spark, CONTRACTS))
    return sorted((r.id_transacao, r.id_contrato) for r in out.collect())


def test_fixture_cases(spark):
    got = _resolved(spark)
    # two valid contracts -> latest expiry; first expired -> the other one
    assert (1, 12) in got and (2, 12) in got
    assert (1, 11) not in got
    # tie on the latest expiry -> one row per tied contract
    assert [g for g in got if g[0] == 3] == [(3, 21), (3, 22)]
    # every contract expired -> row dropped
    assert all(g[0] != 4 for g in got)
    # expiry on the transaction day -> kept
    assert (5, 41) in got
    assert len(got) == 5


def test_rewrite_equals_the_rule(spark):
    assert by_rule(_tx(spark, TX), _contracts(spark, CONTRACTS)) == _resolved(spark)


def test_rewrite_equals_the_rule_on_driver_data(spark):
    from paydw.sources.driver import staging_contratos, staging_transacoes

    sf = "/root/testdata/sf0.001"
    tx, con = staging_transacoes(spark, sf), staging_contratos(spark, sf)
    ours = sorted(tuple(r) for r in resolve_contract(tx, con).select("id_transacao", "id_contrato").collect())
    assert ours == by_rule(tx, con) and len(ours) > 0


def test_merge_twice_is_idempotent(spark, scratch):
    src = _contracts(spark, CONTRACTS)
    insert_only_merge(src, scratch, ["id_contrato"])
    first = sorted(tuple(r) for r in spark.read.parquet(scratch).collect())
    insert_only_merge(src, scratch, ["id_contrato"])
    assert sorted(tuple(r) for r in spark.read.parquet(scratch).collect()) == first


def test_merge_keeps_existing_and_inserts_duplicates_and_nulls(spark, scratch):
    s = spark.createDataFrame([(1, "a"), (2, "b")], "k long, v string")
    insert_only_merge(s, scratch, ["k"])
    s2 = spark.createDataFrame([(1, "changed"), (3, "x"), (3, "y"), (None, "n")], "k long, v string")
    insert_only_merge(s2, scratch, ["k"])
    insert_only_merge(spark.createDataFrame([(None, "n")], "k long, v string"), scratch, ["k"])
    rows = sorted((r.k if r.k is not None else -1, r.v) for r in spark.read.parquet(scratch).collect())
    # existing key untouched, both rows of a new duplicated key, NULL key on every run
    assert rows == [(-1, "n"), (-1, "n"), (1, "a"), (2, "b"), (3, "x"), (3, "y")]


def test_merge_shuffled_path_matches_broadcast_path(spark, scratch):
    t = spark.range(0, 50).select(F.col("id").alias("k"), F.lit("old").alias("v"))
    insert_only_merge(t, scratch + "/a", ["k"])
    insert_only_merge(t, scratch + "/b", ["k"])
    s = spark.range(40, 60).select(F.col("id").alias("k"), F.lit("new").alias("v"))
    insert_only_merge(s, scratch + "/a", ["k"])
    insert_only_merge(s, scratch + "/b", ["k"])
    a = sorted(tuple(r) for r in spark.read.parquet(scratch + "/a").collect())
    b = sorted(tuple(r) for r in spark.read.parquet(scratch + "/b").collect())
    assert a == b and len(a) == 60


def test_hot_client_salted_join_equals_plain(spark):
    from paydw.operators.skew import hot_keys

    # client 1 holds a third of all transactions
    rows = [(i, 1 if i % 3 == 0 else 2 + i % 50, "2024-01-01") for i in range(3000)]
    tx = _tx(spark, rows)
    con = _contracts(spark, [(10 + c, c, "2024-12-31") for c in range(1, 52)])
    hot = hot_keys(tx, "id_cliente", min_share=0.2)
    assert hot == [1]
    plain = sorted(tuple(r) for r in resolve_contract(tx, con).collect())
    salted = sorted(tuple(r) for r in resolve_contract(tx, con, hot_clients=hot, salt_buckets=8).collect())
    assert plain == salted and len(plain) == 3000


def test_nulls_follow_the_definition(spark):
    con = spark.createDataFrame(
        [(1, 1, 0.5, 0.25, 1.0, D("2024-06-01")), (2, 1, 0.5, 0.25, 1.0, None),
         (3, None, 0.5, 0.25, 1.0, D("2024-12-31")), (4, 2, 0.5, 0.25, 1.0, None)], STAGING_CONTRATOS)
    tx = spark.createDataFrame(
        [(1, 1, "payin", 1.0, D("2024-01-01"), dt.datetime(2024, 1, 1)),
         (2, None, "payin", 1.0, D("2024-01-01"), dt.datetime(2024, 1, 1)),
         (3, 2, "payin", 1.0, D("2024-01-01"), dt.datetime(2024, 1, 1)),
         (4, 1, "payin", 1.0, None, None)], STAGING_TRANSACOES)
    ref = by_rule(tx, con)
    got = sorted(tuple(r) for r in resolve_contract(tx, con).select("id_transacao", "id_contrato").collect())
    assert got == ref == [(1, 1)]
