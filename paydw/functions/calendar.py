"""Calendar attributes of a DATE column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def calendar_columns(d: Column) -> dict[str, Column]:
    """Attributes of ``dim_tempo``; the weekday runs Monday=1 .. Sunday=7."""
    return {
        "ano": F.year(d),
        "mes": F.month(d),
        "dia": F.dayofmonth(d),
        "dia_da_semana": (F.weekday(d) + 1).cast("int"),
        "dia_do_ano": F.dayofyear(d),
        "trimestre": F.quarter(d),
    }


def month_ref(d: Column) -> Column:
    """yyyymm as INT, the partition column of the fact tables."""
    return (F.year(d) * 100 + F.month(d)).cast("int")


def is_weekend(d: Column) -> Column:
    return F.weekday(d) >= 5


def is_sunday(d: Column) -> Column:
    return F.weekday(d) == 6
