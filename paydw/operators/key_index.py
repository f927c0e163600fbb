"""The keys of a table, kept apart from its rows.

A merge only has to know which keys of a batch the target already holds. The
index is a narrow Parquet table of the key columns: dealt to files by a hash
bucket of the key, sorted by bucket and key within a file, in small row groups
with a Bloom filter on the leading key. Ids need not grow with time.

* A small batch (at most ``lookup_most`` rows a bucket) reads its buckets with
  the ids themselves as a pushed filter: a row group is opened only if its
  minimum, maximum and Bloom filter leave an id possible.
* A larger batch joins its buckets' keys, without the target's other columns.

Every run writes a folder of its own (``run=N``), so a retried run replaces
what it wrote before.
"""

from __future__ import annotations

from contextlib import contextmanager
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paydw.storage import has_data

BUCKET = "kb"


@contextmanager
def setting(spark: SparkSession, name: str, value: str):
    """A session setting for what is executed inside; afterwards it is as before."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


class KeyIndex:
    def __init__(self, spark: SparkSession, path: str, keys: tuple[str, ...], buckets: int = 16,
                 lookup_most: int = 256, row_group_bytes: int = 8 << 20, fpp: float = 0.001):
        self.spark, self.path, self.keys = spark, path, list(keys)
        self.buckets, self.lookup_most = buckets, lookup_most
        self.row_group_bytes, self.fpp = row_group_bytes, fpp

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*[F.col(k).cast("long") for k in self.keys]), F.lit(self.buckets)).cast("int")

    def not_null(self) -> Column:
        return reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in self.keys])

    def append(self, rows: DataFrame, run: int) -> None:
        """Add the keys of ``rows`` (those with a null never match and stay out) as the keys of ``run``."""
        keys = rows.where(self.not_null()).select(*self.keys, self.bucket().alias(BUCKET))
        lead = self.keys[0]
        # files follow the batch's bytes: a small batch is one file, a large bucket is split
        keys.hint("rebalance", F.col(BUCKET)).sortWithinPartitions(BUCKET, *self.keys).write.mode("overwrite") \
            .option("parquet.block.size", str(self.row_group_bytes)) \
            .option(f"parquet.bloom.filter.enabled#{lead}", "true") \
            .option(f"parquet.bloom.filter.fpp#{lead}", str(self.fpp)) \
            .option(f"parquet.bloom.filter.expected.ndv#{lead}", str(self.row_group_bytes // 8)) \
            .option("parquet.bloom.filter.adaptive.enabled", "true") \
            .option(f"parquet.enable.dictionary#{lead}", "false") \
            .parquet(f"{self.path}/run={run}")

    def stored(self) -> DataFrame | None:
        """All keys, with their bucket; None if there is none yet."""
        if not has_data(self.spark, self.path):
            return None
        schema = ", ".join([*[f"{k} long" for k in self.keys], f"{BUCKET} int", "run long"])
        return self.spark.read.schema(schema).parquet(self.path)

    def matched(self, batch: DataFrame) -> DataFrame | None:
        """The distinct keys of ``batch`` that the index holds; None if there is none.

        One job counts the batch's rows by bucket (at most ``buckets`` rows);
        only if every count is small are the keys themselves (at most
        ``buckets * lookup_most``) brought to the driver, to be pushed to the scan.
        """
        stored = self.stored()
        if stored is None:
            return None
        keys = batch.where(self.not_null()).select(*[F.col(k).cast("long") for k in self.keys]) \
            .withColumn(BUCKET, self.bucket())
        lead = self.keys[0]
        counts = keys.groupBy(BUCKET).agg(F.count(F.lit(1)).alias("n"), F.min(lead).alias("lo"), F.max(lead).alias("hi")).collect()
        if not counts:
            return None
        if max(r["n"] for r in counts) <= self.lookup_most:
            return self.looked_up(stored, [tuple(r) for r in keys.distinct().collect()])
        within = F.col(lead).between(min(r["lo"] for r in counts), max(r["hi"] for r in counts))
        near = stored.where(F.col(BUCKET).isin([r[BUCKET] for r in counts]) & within)
        return near.select(BUCKET, *self.keys).join(keys, [BUCKET, *self.keys], "left_semi").select(*self.keys)

    def probe(self, stored: DataFrame, keys: list[tuple]) -> DataFrame:
        """The stored keys whose leading part is one of ``keys``', by a scan a bucket with these ids as filter."""
        wanted: dict[int, set] = {}
        for *key, bucket in keys:
            wanted.setdefault(bucket, set()).add(key[0])
        return reduce(DataFrame.unionAll, [
            stored.where((F.col(BUCKET) == b) & F.col(self.keys[0]).isin(sorted(ids))).select(*self.keys)
            for b, ids in sorted(wanted.items())])

    def looked_up(self, stored: DataFrame, keys: list[tuple]) -> DataFrame:
        """``matched`` for few keys: the pushed filter has to hold every id, or Parquet sees their range only."""
        with setting(self.spark, "spark.sql.parquet.pushdown.inFilterThreshold", str(self.lookup_most)):
            rows = {tuple(r) for r in self.probe(stored, keys).collect()}
        schema = ", ".join(f"{k} long" for k in self.keys)
        return self.spark.createDataFrame(sorted(rows & {k[:-1] for k in keys}), schema)


def indexed_merge(source: DataFrame, target_path: str, index: KeyIndex, run: int) -> None:
    """Insert-only merge of ``source`` into the table at ``target_path`` whose keys ``index`` holds."""
    known = index.matched(source)
    new = source if known is None else source.join(known, index.keys, "left_anti")
    new.write.mode("append").parquet(target_path)
    index.append(source if known is None else source.join(known, index.keys, "left_anti"), run)
