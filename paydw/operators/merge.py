"""Insert-only merge.

``MERGE INTO target USING source ON keys WHEN NOT MATCHED THEN INSERT *``
re-expressed without a table format that supports row-level merges:

    new = source LEFT ANTI JOIN target ON keys      -> append new to target

Semantics kept from MERGE: existing keys are never touched; all source rows
of a new key are inserted (the source is not de-duplicated); NULL keys never
match, so they insert on every run.

Plan at scale: the key columns of the target are scanned, restricted to the
min/max range of the batch's keys (pushed to parquet: row groups of older keys
are skipped by statistics), and reduced to the keys that the batch has. Which
side of that semi-join is broadcast, if any, is Spark's choice by bytes, so a
small batch never shuffles the target and a backfill is an ordinary shuffled
join. With ``prune_on`` (a partition column that is a function of the key) the
range filter on it prunes partitions.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paydw.storage import has_data


def read_table(spark: SparkSession, path: str) -> DataFrame | None:
    """The parquet table at ``path``, or None when it has no data file yet; any other error is raised."""
    return spark.read.parquet(path) if has_data(spark, path) else None


_RANGE_TYPES = ("long", "integer", "short", "byte", "date", "timestamp", "timestamp_ntz", "string")


def new_rows(source: DataFrame, target: DataFrame | None, keys: list[str] | tuple[str, ...],
             prune_on: str | None = None) -> DataFrame:
    """Rows of ``source`` whose key is not in ``target`` (NULL keys always new).

    One small job first measures the distinct non-NULL source keys and their
    min/max. The bounds become range filters on the target scan: exact (keys
    outside them cannot match) and pushed to parquet, so row groups whose
    statistics lie outside the batch's key range are skipped.
    """
    keys = list(keys)
    if target is None:
        return source
    join_keys = keys + ([prune_on] if prune_on else [])
    not_null = F.greatest(*[F.col(k).isNull().cast("int") for k in join_keys]) == 0 \
        if len(join_keys) > 1 else F.col(join_keys[0]).isNotNull()
    src_keys = source.select(*join_keys).where(not_null).distinct()
    ranged = [k for k in join_keys if source.schema[k].dataType.typeName() in _RANGE_TYPES]
    stats = src_keys.agg(F.count(F.lit(1)).alias("_n"),
                         *[F.min(k).alias(f"_lo_{k}") for k in ranged],
                         *[F.max(k).alias(f"_hi_{k}") for k in ranged]).first()
    if stats["_n"] == 0:
        return source
    tgt = target.select(*join_keys)
    for k in ranged:
        tgt = tgt.where(F.col(k).between(F.lit(stats[f"_lo_{k}"]), F.lit(stats[f"_hi_{k}"])))
    matched = tgt.join(src_keys, join_keys, "left_semi").distinct()
    return source.join(matched, join_keys, "left_anti")


def insert_only_merge(source: DataFrame, target_path: str, keys, *,
                      partition_by: str | None = None, sort_by: list[str] | None = None,
                      prune_on: str | None = None, laid_out: bool = False) -> None:
    """Append the rows of ``source`` whose key is new to the parquet table at ``target_path``.

    ``laid_out`` is that of ``append``; it holds where there is no target to join with yet.
    """
    spark = source.sparkSession
    target = read_table(spark, target_path)
    cached = None
    if target is not None:
        # the batch is read twice (key statistics, then the anti join): keep it
        # for the duration of the merge; it spills to disk, and a lost
        # executor's blocks are recomputed from lineage
        cached = source = source.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        append(new_rows(source, target, keys, prune_on=prune_on), target_path, target, partition_by, sort_by,
               laid_out=laid_out and target is None)
    finally:
        if cached is not None:
            cached.unpersist()


def append(rows: DataFrame, target_path: str, target: DataFrame | None = None,
           partition_by: str | None = None, sort_by: list[str] | None = None, laid_out: bool = False) -> None:
    """Append ``rows`` to the table at ``target_path``, in the types of ``target`` if it is there.

    A partitioned table's files follow the bytes of a partition: ``rebalance``
    lets adaptive execution split a large partition (also one that a single
    client fills) and put small ones together, whatever the cluster's size.
    Rows that are ``laid_out`` already lie together by partition and are not moved again.
    """
    if target is not None:
        rows = rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in target.schema.fields])
    if partition_by:
        if not laid_out:
            rows = rows.hint("rebalance", F.col(partition_by))
        rows = rows.sortWithinPartitions(partition_by, *(sort_by or []))
    writer = rows.write.mode("append")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(target_path)
