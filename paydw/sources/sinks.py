"""Sinks: trend exports (K7) and table registration (K6)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed format of the exported trend tables: header ``data_movimentacao,prediction``,
# days written as UTC midnight timestamps such as 2023-10-01T00:00:00Z.
EXPORT_DAY_FORMAT = "yyyy-MM-dd"
EXPORT_MIDNIGHT_SUFFIX = "T00:00:00Z"


def _export_cols(date_col: str, value_col: str) -> list:
    day = F.date_format(F.to_date(F.col(date_col)), EXPORT_DAY_FORMAT)
    return [F.concat(day, F.lit(EXPORT_MIDNIGHT_SUFFIX)).alias("data_movimentacao"),
            F.col(value_col).cast("double").alias("prediction")]


def trend_export_frame(pred: DataFrame, date_col: str = "data_movimentacao",
                       value_col: str = "prediction", by: str | None = None) -> DataFrame:
    return pred.select(*([by] if by else []), *_export_cols(date_col, value_col))


def export_trend_csv(pred: DataFrame, path: str, by: str | None = "serie",
                     date_col: str = "data_movimentacao", value_col: str = "prediction") -> None:
    """Write ``data_movimentacao,prediction`` CSV, one folder per series when ``by`` is set.

    Each series is one row per day (bounded by the period); the files are
    written by the executors, nothing is collected to the driver.
    """
    out = trend_export_frame(pred, date_col, value_col, by)
    w = out.sortWithinPartitions(*([by] if by else []), "data_movimentacao").write.mode("overwrite")
    if by:
        w = w.partitionBy(by)
    w.option("header", True).csv(path)


def register(df: DataFrame, name: str) -> DataFrame:
    """Temp view for SQL users (K6)."""
    df.createOrReplaceTempView(name)
    return df
