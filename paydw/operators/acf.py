"""Autocorrelation of keyed series.

ACF: c = y - mean(y); r_k = sum_t c_t c_{t-k} / sum_t c_t^2 (no bias
adjustment), lags 0..nlags. All lags of all series come from one window
(``lag`` columns, one sort per series) and one aggregate that reuses its
partitioning; lags are then unpivoted with ``stack``.

Band: Bartlett's variance var_k = (1 + 2 sum_{j<k} r_j^2) / n (1/n at k=1,
0 at k=0); half-width z * sqrt(var_k), z the 97.5% normal quantile. The
first lag >= 1 outside a zero-centred band is the ACF candidate.

PACF: Durbin-Levinson on the lag vector of each series (nlags+1 values,
so a group never grows with the data), written with Spark's higher-order
functions (``aggregate``/``transform``); ``durbin_levinson`` is the same
recursion in NumPy, kept as the brute-force reference for tests.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Fixed value: two-sided 95% normal quantile.
Z_975 = 1.959963984540054


def _lag_sums(x: DataFrame, keys: list[str], window, nlags: int) -> DataFrame:
    """``n`` and the sums of the products of ``_c`` with its lags, of the rows of ``x`` whose ``_own`` holds."""
    products = x.select(*keys, "_own", *[(F.col("_c") * F.lag("_c", k).over(window)).alias(f"_p{k}") for k in range(nlags + 1)])
    return products.where("_own").groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(f"_p{k}").alias(f"_s{k}") for k in range(nlags + 1)])


def _blocked_lag_sums(df: DataFrame, keys: list[str], order: str, y, nlags: int, block_rows: int) -> DataFrame:
    """``_lag_sums`` of series of any length: no task holds a whole series.

    Rows meet by (series, stretch of ``block_rows`` days or numbers of the
    order column) to be counted off; what the stretches before hold (one row a
    stretch) turns that into a place in the series. Places make blocks of
    ``block_rows``; the last ``nlags`` rows of a block also go to the next
    one, as what its first rows look back at. Block sums add up by series.
    ``block_rows`` has to be larger than ``nlags``. Rows of equal order have no fixed place.
    """
    if block_rows <= nlags:
        raise ValueError("block_rows has to be larger than nlags")
    is_day = df.schema[order].dataType.typeName() == "date"
    at = F.datediff(F.col(order), F.lit("1970-01-01").cast("date")) if is_day else F.col(order)
    x = df.select(*keys, F.col(order).alias("_t"), y.alias("_y"), F.floor(at / block_rows).alias("_stretch"))
    counts = x.groupBy(*keys, "_stretch").agg(F.count(F.lit(1)).alias("_n"), F.sum("_y").alias("_sum"), F.count("_y").alias("_with"))
    series = Window.partitionBy(*keys)
    before = counts.select(
        *keys, "_stretch", (F.sum("_n").over(series.orderBy("_stretch")) - F.col("_n")).alias("_before"),
        (F.sum("_sum").over(series) / F.sum("_with").over(series)).alias("_mean"))
    place = F.col("_before") + F.row_number().over(Window.partitionBy(*keys, "_stretch").orderBy("_t")) - 1
    x = x.join(before, [*keys, "_stretch"]).select(*keys, (F.col("_y") - F.col("_mean")).alias("_c"), place.alias("_place"))
    block, rest = F.floor(F.col("_place") / block_rows), F.col("_place") % block_rows
    x = x.select(*keys, "_c", "_place", block.alias("_block"), F.explode(F.when(
        rest >= block_rows - nlags, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("_next")) \
        .select(*keys, "_c", "_place", (F.col("_block") + F.col("_next")).alias("_block"), (F.col("_next") == 0).alias("_own"))
    by = [*keys, "_block"]
    return _lag_sums(x, by, Window.partitionBy(*by).orderBy("_place"), nlags).groupBy(*keys).agg(
        F.sum("n").alias("n"), *[F.sum(f"_s{k}").alias(f"_s{k}") for k in range(nlags + 1)])


def acf(df: DataFrame, keys: list[str], order: str, value_col: str, nlags: int = 30,
        adjusted: bool = False, alpha: float | None = 0.05, block_rows: int | None = None) -> DataFrame:
    """Rows (keys..., lag, acf, n, var_bartlett, band) for lags 0..nlags.

    A daily series fits a task, so one window holds it; for series without
    such a bound ``block_rows`` cuts them into overlapping blocks.
    """
    keys = list(keys)
    y = F.col(value_col).cast("double")
    if block_rows is None:
        part = Window.partitionBy(*keys) if keys else Window.partitionBy()
        c = y - F.avg(y).over(part)
        x = df.select(*keys, order, c.alias("_c"), F.lit(True).alias("_own"))
        sums = _lag_sums(x, keys, part.orderBy(F.col(order)), nlags)
    else:
        sums = _blocked_lag_sums(df, keys, order, y, nlags, block_rows)
    n = F.col("n").cast("double")
    ratios = {}
    for k in range(nlags + 1):
        num, den = F.col(f"_s{k}"), F.col("_s0")
        if adjusted:
            num, den = num / (n - k), den / n
        ratios[f"_r{k}"] = F.when((F.lit(k) < F.col("n")) & (den != 0),
                                  F.coalesce(num, F.lit(0.0)) / den)
    r = sums.select(*keys, "n", *[v.alias(k) for k, v in ratios.items()])
    pairs = ", ".join(f"{k}, _r{k}" for k in range(nlags + 1))
    long = r.select(*keys, "n", F.expr(f"stack({nlags + 1}, {pairs}) AS (lag, acf)"))
    wl = (Window.partitionBy(*keys) if keys else Window.partitionBy()).orderBy("lag") \
        .rowsBetween(Window.unboundedPreceding, -1)
    prev_sq = F.sum(F.when(F.col("lag") >= 1, F.col("acf") * F.col("acf")).otherwise(0.0)).over(wl)
    var = F.when(F.col("lag") == 0, F.lit(0.0)).otherwise(
        (F.lit(1.0) + 2.0 * F.coalesce(prev_sq, F.lit(0.0))) / F.col("n"))
    out = long.withColumn("var_bartlett", var)
    if alpha is not None:
        out = out.withColumn("band", F.lit(_z(alpha)) * F.sqrt(F.col("var_bartlett")))
    return out


def _z(alpha: float) -> float:
    if abs(alpha - 0.05) < 1e-12:
        return Z_975
    from statistics import NormalDist
    return NormalDist().inv_cdf(1 - alpha / 2)


def acf_first_lag(acf_df: DataFrame, keys: list[str]) -> DataFrame:
    """First lag >= 1 with |acf| above the zero-centred band (0 when none)."""
    hit = F.when((F.col("lag") >= 1) & (F.abs(F.col("acf")) > F.col("band")), F.col("lag"))
    return acf_df.groupBy(*keys).agg(F.coalesce(F.min(hit), F.lit(0)).alias("acf_first_lag"))


def durbin_levinson(r: np.ndarray) -> np.ndarray:
    """Partial autocorrelations phi_kk, k = 0..len(r)-1, from autocorrelations r_0..r_m."""
    m = len(r) - 1
    out = np.full(m + 1, np.nan)
    if m < 0:
        return out
    out[0] = 1.0
    phi = np.zeros(m + 1)
    for k in range(1, m + 1):
        if k == 1:
            pk = r[1]
        else:
            num = r[k] - np.dot(phi[1:k], r[k - 1:0:-1])
            den = 1.0 - np.dot(phi[1:k], r[1:k])
            pk = num / den if den != 0 else np.nan
        new = phi.copy()
        new[k] = pk
        for j in range(1, k):
            new[j] = phi[j] - pk * phi[k - j]
        phi = new
        out[k] = pk
    return out


# Durbin-Levinson over the lag array ``r`` (r[0] = 1), with Spark's higher-order
# functions: ``aggregate`` over k = 1..m carries phi_{k-1,1..k-1} and the pacf so far.
_SEQ = "IF(k > 1, sequence(1, k - 1), CAST(array() AS array<int>))"
_PK = (f"try_divide(r[k] - aggregate({_SEQ}, CAST(0 AS double), (s, j) -> s + acc.phi[j - 1] * r[k - j]), "
       f"1 - aggregate({_SEQ}, CAST(0 AS double), (s, j) -> s + acc.phi[j - 1] * r[j]))")
_DURBIN_LEVINSON = f"""aggregate(sequence(1, size(r) - 1),
  named_struct('phi', CAST(array() AS array<double>), 'out', array(CAST(1.0 AS double))),
  (acc, k) -> named_struct(
    'phi', concat(transform({_SEQ}, j -> acc.phi[j - 1] - {_PK} * acc.phi[k - j - 1]), array({_PK})),
    'out', concat(acc.out, array({_PK}))),
  acc -> acc.out)"""


def pacf(df: DataFrame, keys: list[str], order: str, value_col: str, nlags: int = 30,
         method: str = "ywadjusted", block_rows: int | None = None) -> DataFrame:
    """Rows (keys..., lag, pacf, n, band) by Durbin-Levinson (Yule-Walker).

    ``ywadjusted`` uses the lag-adjusted autocovariances (divisor n-k),
    ``yw`` the plain ones. ``band`` is 2/sqrt(n), the threshold of T13.
    The recursion runs in Spark's higher-order functions over the lag array
    of each series (nlags+1 values), so no Python worker is involved; the
    aggregate reuses the partitioning of the autocorrelation job.
    """
    keys = list(keys)
    a = acf(df, keys, order, value_col, nlags, adjusted=(method == "ywadjusted"), alpha=None, block_rows=block_rows)
    lags = F.array_sort(F.collect_list(F.struct(F.col("lag"), F.coalesce(F.col("acf"), F.lit(0.0)).alias("acf"))))
    grouped = a.groupBy(*keys) if keys else a.groupBy()
    per = grouped.agg(F.first("n").alias("n"), lags.alias("_lags"))
    per = per.select(*keys, "n", F.transform("_lags", lambda x: x["acf"]).alias("r"))
    out = per.select(*keys, "n", F.posexplode(F.expr(_DURBIN_LEVINSON)).alias("lag", "pacf"))
    return out.select(*keys, F.col("lag").cast("int").alias("lag"), "pacf",
                      F.col("n").cast("long").alias("n"),
                      (F.lit(2.0) / F.sqrt(F.col("n").cast("double"))).alias("band"))


def pacf_first_lag(pacf_df: DataFrame, keys: list[str]) -> DataFrame:
    """First lag >= 1 with |pacf| > 2/sqrt(n) (0 when none)."""
    hit = F.when((F.col("lag") >= 1) & (F.abs(F.col("pacf")) > F.col("band")), F.col("lag"))
    return pacf_df.groupBy(*keys).agg(F.coalesce(F.min(hit), F.lit(0)).alias("pacf_first_lag"))
