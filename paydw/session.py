"""Session helpers: a tuned local/cluster session and the shared scratch dir."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Settings that matter for every job in this library. On a cluster they are
# normally in spark-defaults; ``get_session`` applies them for local runs.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    # an amount that does not fit its type fails the job and is not lost as NULL
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
}


def cluster_conf(total_cores: int, shuffle_bytes: int | None = None,
                 target_partition_bytes: int = 256 << 20) -> dict:
    """Settings for a large cluster (e.g. 1000 executors reading ~100 TB).

    Initial shuffle partitions: enough for ``shuffle_bytes`` at
    ``target_partition_bytes`` each and at least 3 waves of tasks, so a
    partition fits in executor memory without spilling; AQE then coalesces
    small ones and splits skewed ones at runtime. Scan splits of 256 MB keep
    the number of scan tasks proportional to the data.
    """
    parts = 3 * total_cores
    if shuffle_bytes:
        parts = max(parts, -(-shuffle_bytes // target_partition_bytes))
    return {
        **DEFAULT_CONF,
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(2 * target_partition_bytes),
        "spark.sql.autoBroadcastJoinThreshold": str(64 << 20),
        "spark.sql.parquet.filterPushdown": "true",
        "spark.sql.parquet.compression.codec": "zstd",
        "spark.sql.optimizer.dynamicPartitionPruning.enabled": "true",
        # streaming state (live totals) off the JVM heap, checkpointed incrementally
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    }


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app: str = "paydw", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this is a shared filesystem path set by the operator. Only
    when it is unset (local tests) a folder is made under the local temp dir.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    if not d:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="paydw-ckpt-")
        spark.sparkContext.setCheckpointDir(d)
    return d.rstrip("/")


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A path below the shared checkpoint folder."""
    return "/".join([ensure_checkpoint_dir(spark), *parts])
