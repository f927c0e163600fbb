"""Staging readers.

Staging tables are plain files (parquet by default) or a JDBC table pulled
for one time window. Both enforce the staging schema so that a drifting
source fails at read time, not in the middle of a merge.
"""

from __future__ import annotations

import datetime as _dt
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from paydw.storage import files, remove


def read_staging(spark: SparkSession, path: str, schema: StructType,
                 fmt: str = "parquet", options: dict | None = None, names: list[str] | None = None) -> DataFrame:
    """The staging table at ``path``; with ``names`` only these of its files (as ``staging_files`` gives them)."""
    opts = {"header": "true"} if fmt == "csv" else {}
    if names == []:
        return spark.createDataFrame([], schema)
    opts.update(options or {})
    reader = spark.read.format(fmt).options(**opts)
    if fmt != "parquet":
        reader = reader.schema(schema)
    df = reader.load(path) if names is None else reader.option("basePath", path).load([path + n for n in names])
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def staging_files(spark: SparkSession, path: str) -> list[str]:
    """The data files below ``path`` now; what arrives later is not among them."""
    return [name for name, _, _ in files(spark, path)]


def clear_staging(spark: SparkSession, path: str, names: list[str]) -> None:
    """Remove the files of ``names`` and nothing else."""
    for name in names:
        remove(spark, path + name)


def read_staging_window(spark: SparkSession, path: str, schema: StructType,
                        date_col: str, start, end, fmt: str = "parquet",
                        options: dict | None = None, names: list[str] | None = None) -> DataFrame:
    """Rows of one pull window ``start <= date_col < end``; either end may be open. The filter reaches the scan."""
    return read_staging(spark, path, schema, fmt, options, names).where(in_window(date_col, start, end))


def in_window(date_col: str, start, end):
    c = F.col(date_col)
    ends = [*([c >= F.lit(start)] if start is not None else []), *([c < F.lit(end)] if end is not None else [])]
    return reduce(lambda a, b: a & b, ends, F.lit(True))


def jdbc_day_predicates(date_col: str, days: list) -> list[str]:
    """One half-open predicate per day: each becomes one JDBC partition (one task)."""
    out = []
    for d in days:
        d0 = _dt.date.fromisoformat(str(d))
        d1 = d0 + _dt.timedelta(days=1)
        out.append(f"{date_col} >= DATE '{d0.isoformat()}' AND {date_col} < DATE '{d1.isoformat()}'")
    return out


def read_jdbc_window(spark: SparkSession, url: str, table: str, schema: StructType,
                     date_col: str, days: list, properties: dict | None = None) -> DataFrame:
    """Pull one window from an operational database, one partition per day.

    ``days`` are ISO dates; every day becomes its own JDBC predicate, so the
    pull is split over executors and a failed day is retried by Spark alone.
    """
    df = spark.read.jdbc(url, table, predicates=jdbc_day_predicates(date_col, days),
                         properties=properties or {})
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
