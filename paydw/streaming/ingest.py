"""The stream of staging files that ``Warehouse.ingest`` loads.

A file-source stream over the staging folder is run with
``trigger(availableNow=True)`` by the scheduler that also runs the other jobs:
each run processes every file that arrived since the last one and stops. The
checkpoint (below ``spark.checkpoint.dir``, a shared folder) records which files
each batch owns; a failed batch is run again with the same files, and the
warehouse's run ledger finishes what the broken attempt had staged.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def staging_stream(spark: SparkSession, path: str, schema, mapper=None,
                   max_files_per_trigger: int | None = None) -> DataFrame:
    """A file-source stream over a staging folder with a fixed schema."""
    r = spark.readStream.schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    df = r.parquet(path)
    return mapper(df) if mapper else df
