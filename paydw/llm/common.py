"""Helpers shared by the operators: cutting lineage, bounded buffers, components."""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paydw.session import scratch_path
from paydw.storage import remove

# ASCII white space of the word pattern and the word pattern itself.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table, by whatever path Spark can read."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame, what: str, made: list[str] | None = None) -> DataFrame:
    """``df`` written once below ``spark.checkpoint.dir`` and read back.

    Later steps start at this table, so a lost executor costs a reread and not
    a recomputation, and a table that is used twice is computed once. ``made``
    receives its path, for operators that drop their tables at their end.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "paydw-llm", f"{what}-{uuid.uuid4().hex}")
    df.write.option("compression", "zstd").parquet(path)
    if made is not None:
        made.append(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_tables(spark: SparkSession, made: list[str]) -> None:
    """Remove tables of ``cut`` that no plan reads any more, as their result is a written table itself."""
    for path in made:
        remove(spark, path)


def let(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once, however often ``use`` refers to it."""
    return F.element_at(F.transform(F.array(value), use), 1)


def bounded_batches(spark: SparkSession, limit: int = 16 << 20) -> None:
    """Hand Python workers at most about ``limit`` bytes a batch, however long the texts are."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(limit))


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]):
    """Session settings for the jobs that are run inside; those of before come back."""
    before = {k: spark.conf.get(k, None) for k in values}
    try:
        for k, v in values.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def doubles(values: list[float]) -> Column:
    """A constant array of numbers, handed over as one text; the optimizer folds it to a literal."""
    return F.split(F.lit(",".join(map(repr, values))), ",").cast("array<double>")


def give_back() -> None:
    """Return a Python worker's freed memory to the system; the worker stays for later tasks."""
    import ctypes
    import gc

    import pyarrow as pa

    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def in_buckets(df: DataFrame, keys: DataFrame, col: str, bits: int = 20) -> DataFrame:
    """Rows of ``df`` whose hash ``col`` shares its low ``bits`` with a key in ``keys``.

    A prefilter before an exact join: at most ``2 ** bits`` longs are broadcast,
    however many keys there are; rows that match by chance go in the exact join.
    """
    few = keys.select(F.col(col).bitwiseAND((1 << bits) - 1).alias("_bucket")).distinct()
    return (df.withColumn("_bucket", F.col(col).bitwiseAND((1 << bits) - 1))
            .join(F.broadcast(few), "_bucket", "left_semi").drop("_bucket"))


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, component)`` for every node of ``links``; component is its smallest node.

    Alternating star contraction: "large" points each node's larger neighbours
    to its smallest neighbour, "small" does so with the smaller ones. Rounds
    grow with the logarithm of the longest path; every round is two grouped
    minima and joins over the edges, cut by a written table. A node with very
    many neighbours is only aggregated (partial minima) and joined, and a join
    of a hot key is split by adaptive execution.
    """
    spark = links.sparkSession

    def both(e):
        return e.union(e.select("v", "u"))

    def starred(pairs):
        least = pairs.groupBy("u").agg(F.min("v").alias("m")) \
            .select("u", F.least("u", "m").alias("m"))
        return pairs.join(least, "u")

    edges = cut(links.select(F.col(a).alias("u"), F.col(b).alias("v"))
                .where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                .distinct(), "edges")
    while True:
        large = starred(both(edges)).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = cut(large.where("u <> v").distinct(), "large")
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        small = starred(down)
        after = cut(small.select(F.col("v").alias("u"), F.col("m").alias("v"))
                    .union(small.select("u", F.col("m").alias("v")))
                    .where("u <> v").distinct(), "small")
        same = edges.join(after, ["u", "v"], "left_anti").limit(1).count() == 0 \
            and after.join(edges, ["u", "v"], "left_anti").limit(1).count() == 0
        edges = after
        if same:
            break
    found = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return found.union(roots)
