"""Hot keys: detection by counting and salted equi-joins.

A key that holds a large share of the rows (one client with a third of all
transactions) sends all of them to one task of a shuffled join. AQE's skew
join splits such partitions at runtime; ``salted_join`` does it explicitly
and independently of AQE thresholds:

* ``hot_keys`` counts the rows of every key (one column scanned, partial
  aggregation before the shuffle) and returns the keys holding at least
  ``min_share`` of them. At most 1/min_share keys can qualify, so the list
  brought to the driver is bounded whatever the data size. All rows
  are processed by the join; the counts only steer the plan.
* the big side gets a salt in [0, buckets) on rows of hot keys (0 otherwise),
  taken from a hash of row columns; the small side repeats each hot key's
  rows once per salt. Hot keys are split over ``buckets`` tasks; other keys
  are untouched and the small side grows by (hot rows x buckets) only.

Results are exactly those of the plain join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SALT = "_salt"


def hot_keys(df: DataFrame, key: str, min_share: float = 0.02) -> list:
    """Keys holding a share of rows >= ``min_share`` (at most 1/min_share of them)."""
    s = df.select(key).where(F.col(key).isNotNull())
    counts = s.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    one = counts.agg(F.sum("n").alias("t"), F.max("n").alias("most")).first()
    if not one["t"] or one["most"] < min_share * one["t"]:
        return []
    # the shares sum to 1, so at most 1/min_share keys qualify
    return [r[key] for r in counts.where(F.col("n") >= F.lit(min_share * one["t"])).collect()]


def salted_join(big: DataFrame, small: DataFrame, key: str, hot: list, buckets: int,
                salt_cols: list[str], how: str = "inner", on=None) -> DataFrame:
    """``big JOIN small ON key`` with the rows of ``hot`` keys spread over ``buckets`` tasks.

    ``on(big, small)`` adds a condition, as an outer join needs it inside the join.
    """
    b, s = big, small
    keys = [key]
    if hot and buckets > 1:
        is_hot = F.col(key).isin(hot)
        salt = F.pmod(F.xxhash64(*[F.col(c) for c in salt_cols]), F.lit(buckets)).cast("int")
        b = big.withColumn(SALT, F.when(is_hot, salt).otherwise(F.lit(0)))
        s = small.withColumn(SALT, F.explode(
            F.when(is_hot, F.sequence(F.lit(0), F.lit(buckets - 1))).otherwise(F.array(F.lit(0)))))
        keys.append(SALT)
    if on is None:
        return b.join(s, keys, how).drop(SALT)
    # the small side's keys under names of their own, so that conditions can tell the sides apart
    s = s.withColumnsRenamed({k: f"_small_{k}" for k in keys})
    both = [b[k] == s[f"_small_{k}"] for k in keys]
    return b.join(s, [*both, on(b, s)], how).drop(*[f"_small_{k}" for k in keys], SALT)
