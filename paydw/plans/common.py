"""Joins and measures shared by the analytics plans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paydw.functions.money import amount, as_double, revenue_amount
from paydw.operators.merge import read_table
from paydw.schemas import MONTH_PARTITION


_MARTS: dict[tuple, str] = {}
# Bump when a materialized table's definition changes (old copies are then ignored).
MARTS_VERSION = "1"


def materialized(wh, name: str, build) -> DataFrame:
    """``build(wh)`` written once as a parquet table below the warehouse and read back.

    For warehouses that no longer change (a built snapshot, as in
    ``warehouse_for_sf``): the derived table cuts the lineage of every query
    that starts from it (one job to write it, no recomputation by later
    queries or other processes). A one-row pointer table publishes a
    complete write, so a half-written table is never read.
    """
    import uuid

    spark = wh.spark
    key = (spark.sparkContext.applicationId, wh.path, name)
    path = _MARTS.get(key)
    if path is None:
        base = f"{wh.path}/_marts/{name}-v{MARTS_VERSION}"
        ptr = read_table(spark, f"{base}/_latest")
        row = ptr.first() if ptr is not None else None
        if row is not None:
            path = row["path"]
        else:
            path = f"{base}/{uuid.uuid4().hex[:12]}"
            build(wh).write.parquet(path)
            spark.createDataFrame([(path,)], "path string").coalesce(1) \
                .write.mode("overwrite").parquet(f"{base}/_latest")
        _MARTS[key] = path
    return spark.read.parquet(path)


def with_calendar(facts: DataFrame, tempo: DataFrame, on: str = "data_movimentacao") -> DataFrame:
    """facts JOIN dim_tempo ON day.

    The calendar holds one row per day, so its size is bounded by the length
    of the period (about 36,500 rows a century) and never by the data
    volume: it is broadcast and the facts are not shuffled. Facts with their
    month partition are joined on the month, too: any filter on the calendar
    then prunes fact partitions at run time (dynamic partition pruning).
    """
    if MONTH_PARTITION not in facts.columns:
        return facts.join(F.broadcast(tempo), F.col(on) == tempo["data"], "inner")
    days = tempo.withColumn("_mes", F.col("ano") * 100 + F.col("mes"))
    return facts.join(F.broadcast(days), (F.col(on) == days["data"]) & (F.col(MONTH_PARTITION) == days["_mes"]), "inner").drop("_mes")


def drop_partition(df: DataFrame) -> DataFrame:
    return df.drop(MONTH_PARTITION) if MONTH_PARTITION in df.columns else df


def months_between_filter(start, end) -> Column:
    """Partition filter on ``mes_ref`` implied by a day range (static pruning)."""
    s, e = str(start), str(end)
    return F.col(MONTH_PARTITION).between(int(s[:4] + s[5:7]), int(e[:4] + e[5:7]))


def year_filter(ano: int) -> Column:
    return F.col(MONTH_PARTITION).between(ano * 100 + 1, ano * 100 + 12)


def sum_money(c: str, alias: str | None = None) -> Column:
    return as_double(F.sum(amount(c))).alias(alias or c)


def sum_revenue(rate: str, value: str, alias: str) -> Column:
    """SUM(rate * value) as DOUBLE, the same for any order of rows."""
    return as_double(F.sum(revenue_amount(rate, value))).alias(alias)


def rnd(c: Column | str, digits: int, alias: str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c, digits).alias(alias)
