"""Money arithmetic that does not depend on row order and rounds no row.

Money columns are DOUBLE, as in the data model. A value is turned into a wide
decimal before it is added up: 26 digits before the point and 10 behind it,
more than a DOUBLE of money carries. Sums are then exact and the same for any
order of partitions; they become DOUBLE again once, at the end. A value that
does not fit fails the job (ANSI mode, Spark's default) and is not cut off.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

AMOUNT_TYPE = "decimal(36,10)"


def amount(c: Column | str) -> Column:
    """A DOUBLE as the decimal that it is written as."""
    c = F.col(c) if isinstance(c, str) else c
    return c.cast(AMOUNT_TYPE)


def as_double(total: Column) -> Column:
    return total.cast("double")


def revenue_amount(rate: Column | str, value: Column | str) -> Column:
    """rate x value, the DOUBLE product, as an amount."""
    rate = F.col(rate) if isinstance(rate, str) else rate
    value = F.col(value) if isinstance(value, str) else value
    return amount(rate * value)
