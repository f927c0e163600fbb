"""File status through Hadoop's FileSystem, so that every path Spark can read is judged alike."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def files(spark: SparkSession, path: str) -> Iterator[tuple[str, int, int]]:
    """(name, bytes, time of change) of the data files at or below ``path``; none if it does not exist.

    Files below a name that begins with ``_`` or ``.`` are not data: they
    belong to writers or to unfinished writes.
    """
    fs, p = _open(spark, path)
    if not fs.exists(p):
        return
    root = fs.getFileStatus(p).getPath().toString().rstrip("/")
    found = fs.listFiles(p, True)
    while found.hasNext():
        f = found.next()
        name = f.getPath().toString()[len(root):]
        if not any(part[:1] in ("_", ".") for part in name.split("/") if part):
            yield name, f.getLen(), f.getModificationTime()


def has_data(spark: SparkSession, path: str) -> bool:
    return next(files(spark, path), None) is not None


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _open(spark, path)
    return fs.exists(p)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names directly below ``path``, in order; none if it does not exist."""
    fs, p = _open(spark, path)
    return sorted(f.getPath().getName() for f in fs.listStatus(p)) if fs.exists(p) else []


def make_folder(spark: SparkSession, path: str) -> None:
    fs, p = _open(spark, path)
    fs.mkdirs(p)


def mark(spark: SparkSession, path: str) -> None:
    """An empty file at ``path``: a step that is done (made at once, nothing is overwritten)."""
    fs, p = _open(spark, path)
    fs.create(p, True).close()


def remove(spark: SparkSession, path: str) -> None:
    fs, p = _open(spark, path)
    fs.delete(p, True)
