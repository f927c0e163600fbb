"""The key index: matches of any batch size, Bloom filters that skip row groups, repeated runs."""

import random

import pytest

from paydw.operators.key_index import KeyIndex, indexed_merge

KEYS = ("id_transacao", "id_cliente")


def frame(spark, keys):
    return spark.createDataFrame(keys, "id_transacao long, id_cliente long")


@pytest.mark.parametrize("most", [256, 0])
def test_matches_are_those_of_all_keys(spark, scratch, most):
    rng = random.Random(1)
    pick = lambda n: [(rng.randint(-50, 400), rng.choice([1, 2, None])) for _ in range(n)]
    index, have = KeyIndex(spark, scratch, KEYS, buckets=4, lookup_most=most), set()
    assert index.matched(frame(spark, pick(5))) is None
    for run in (1, 2, 3):
        keys = pick(150) + [(None, 1)]
        batch = frame(spark, keys)
        known = index.matched(batch)
        got = {tuple(r) for r in known.collect()} if known is not None else set()
        assert got == {k for k in keys if k in have}
        for _ in range(2):  # a run that is repeated replaces its keys
            index.append(batch, run)
        have |= {k for k in keys if None not in k}
        assert {tuple(r) for r in index.stored().select(*KEYS).collect()} == have
    assert index.matched(frame(spark, [(None, None)])) is None


def scanned(df):
    """Rows that the scans of an executed plan gave."""
    df.collect()
    plan, n = df._jdf.queryExecution().executedPlan(), 0
    todo = [plan]
    while todo:
        p = todo.pop()
        if p.nodeName().startswith("AdaptiveSparkPlan"):
            todo.append(p.executedPlan())
            continue
        if p.nodeName().startswith("Scan parquet"):
            n += p.metrics().apply("numOutputRows").value()
        todo += [p.children().apply(i) for i in range(p.children().size())]
    return n


def test_a_small_batch_of_random_ids_opens_few_row_groups(spark, scratch):
    """Ids without any order: minimum and maximum of a row group say nothing, its Bloom filter does."""
    from pyspark.sql import functions as F

    from paydw.operators.key_index import setting

    index = KeyIndex(spark, scratch, KEYS, buckets=4, row_group_bytes=64 << 10)
    ids = spark.range(200_000).select(F.xxhash64("id").alias("id_transacao"), (F.col("id") % 7).alias("id_cliente"))
    index.append(ids, 1)
    known = ids.limit(3).collect()
    batch = [tuple(r) for r in known] + [(i * 2 ** 50 + 12345, 1) for i in range(20)]
    assert {tuple(r) for r in index.matched(frame(spark, batch)).collect()} == {tuple(r) for r in known}
    with_bucket = [tuple(r) for r in frame(spark, batch[3:]).withColumn("kb", index.bucket()).collect()]
    with setting(spark, "spark.sql.parquet.pushdown.inFilterThreshold", "256"), \
            setting(spark, "spark.sql.parquet.enableVectorizedReader", "true"):
        few = scanned(index.probe(index.stored(), with_bucket))
    assert few < 200_000 / 10
    assert spark.conf.get("spark.sql.parquet.pushdown.inFilterThreshold") == "10"


def test_indexed_merge_twice_is_one_merge(spark, scratch):
    src = spark.createDataFrame([(1, 1, "a"), (1, 1, "b"), (2, 1, "c"), (None, 1, "n")], "id_transacao long, id_cliente long, v string")
    index = KeyIndex(spark, f"{scratch}/keys", KEYS)
    for run in (1, 2):
        indexed_merge(src, f"{scratch}/t", index, run)
    assert sorted(r.v for r in spark.read.parquet(f"{scratch}/t").collect()) == ["a", "b", "c", "n", "n"]
