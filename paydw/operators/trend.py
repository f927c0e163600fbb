"""Linear trends for many series in one pass.

value ~ intercept + slope * x, x = days since 1970-01-01 (the reference fits
on epoch seconds; days give the same line with the slope per day).

Ordinary least squares in closed form from five sums per series:

    n, Sx, Sxx, Sy, Sxy   with y as a decimal of 10 places
    slope     = (n Sxy - Sx Sy) / (n Sxx - Sx^2)
    intercept = (Sy - slope Sx) / n

The sums are exact decimals, so the fit does not depend on how partitions are
combined; they are mergeable, so every series is fitted by one hash aggregate
with partial aggregation, or by one window when the fit is attached to the rows
(T2). ``trend_sums`` keeps them per part of a series (a month), and
``trend_from_sums`` adds up what is kept: a new month is fitted without another
look at the months before. Nothing reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

EPOCH = "1970-01-01"
# day numbers, and values with 10 decimals: their products fit 38 digits
_DAY, _VALUE = "decimal(10,0)", "decimal(27,10)"


def epoch_day(d: Column | str) -> Column:
    d = F.col(d) if isinstance(d, str) else d
    return F.datediff(d, F.lit(EPOCH).cast("date")).cast("long")


def _sums(value_col: str, date_col: str, over=None) -> dict[str, Column]:
    y, x = F.col(value_col).cast("double"), epoch_day(date_col)
    ok = y.isNotNull() & x.isNotNull()
    y, x = F.when(ok, y.cast(_VALUE)), F.when(ok, x.cast(_DAY))
    aggs = {"n": F.count(y), "_sx": F.sum(x), "_sxx": F.sum(x * x), "_sy": F.sum(y),
            "_sxy": F.sum(x * y), "_syy": F.sum(y.cast("double") * y.cast("double"))}
    if over is not None:
        aggs = {k: v.over(over) for k, v in aggs.items()}
    return aggs


def _fit_cols() -> dict[str, Column]:
    n = F.col("n").cast("double")
    sx, sxx, sy, sxy, syy = (F.col(c).cast("double") for c in ("_sx", "_sxx", "_sy", "_sxy", "_syy"))
    den = n * sxx - sx * sx
    slope = F.when(den != 0, (n * sxy - sx * sy) / den)
    syy_c = syy - sy * sy / n
    r2 = F.when((den != 0) & (syy_c != 0),
                (n * sxy - sx * sy) * (n * sxy - sx * sy) / (den * (n * syy - sy * sy)))
    return {"slope": slope, "intercept": (sy - slope * sx) / n, "r2": r2}


def trend_fit(df: DataFrame, keys: list[str], date_col: str, value_col: str) -> DataFrame:
    """One row per series: n, slope (per day), intercept (at 1970-01-01), r2."""
    s = _sums(value_col, date_col)
    g = df.groupBy(*keys).agg(*[v.alias(k) for k, v in s.items()])
    return g.select(*keys, "n", *[v.alias(k) for k, v in _fit_cols().items()])


SUMS = ("n", "_sx", "_sxx", "_sy", "_sxy", "_syy")


def trend_sums(df: DataFrame, keys: list[str], date_col: str, value_col: str) -> DataFrame:
    """The sums of each group, to be added up with those of other parts of its series."""
    return df.groupBy(*keys).agg(*[v.alias(k) for k, v in _sums(value_col, date_col).items()],
                                 F.max(date_col).alias("ultimo_dia"))


def trend_from_sums(sums: DataFrame, keys: list[str]) -> DataFrame:
    """``trend_summary`` from kept sums: n, slope, intercept, r2, rmse and the last day of each series."""
    whole = sums.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in SUMS], F.max("ultimo_dia").alias("ultimo_dia"))
    n, sx, sy, sxy, syy = (F.col(c).cast("double") for c in ("n", "_sx", "_sy", "_sxy", "_syy"))
    # sum of squared residuals: what the line leaves of the centred squares
    left = syy - sy * sy / n - F.col("slope") * (sxy - sx * sy / n)
    return whole.withColumns(_fit_cols()).withColumn(
        "rmse", F.when(F.col("slope").isNotNull(), F.sqrt(F.greatest(left, F.lit(0.0)) / n))).drop(*SUMS[1:])


def quantile_sketch(df: DataFrame, keys: list[str], value_col: str, k: int = 200) -> DataFrame:
    """One mergeable KLL sketch of each group (``esboco``); ranks are off by about 1.7 % of the rows at ``k`` = 200."""
    return df.groupBy(*keys).agg(F.kll_sketch_agg_double(value_col, F.lit(k)).alias("esboco"))


def sketched_quantiles(sketches: DataFrame, keys: list[str], ranks: tuple[float, ...] = (0.25, 0.5, 0.75)) -> DataFrame:
    """Quantiles of each series from the sketches of its parts, merged: ``(keys..., posicao, valor)``."""
    whole = sketches.groupBy(*keys).agg(F.kll_merge_agg_double("esboco").alias("esboco"))
    each = [F.struct(F.lit(r).alias("posicao"), F.kll_sketch_get_quantile_double("esboco", F.lit(r)).alias("valor")) for r in ranks]
    return whole.select(*keys, F.explode(F.array(*each)).alias("q")).select(*keys, "q.*")


def residual_summary(df: DataFrame, keys: list[str], date_col: str, value_col: str) -> DataFrame:
    """Count, mean, deviation, extremes and exact quartiles of a trend's residuals per series."""
    r = F.col("residual")
    return trend_predict(df, keys, date_col, value_col).groupBy(*keys).agg(
        F.count(r).alias("n"), F.avg(r).alias("media"), F.stddev_samp(r).alias("desvio"), F.min(r).alias("minimo"),
        *[F.percentile(r, F.lit(q / 100)).alias(f"q{q}") for q in (25, 50, 75)], F.max(r).alias("maximo"))


def trend_predict(df: DataFrame, keys: list[str], date_col: str, value_col: str) -> DataFrame:
    """Rows of ``df`` with the fit of their series, ``prediction`` and ``residual``."""
    w = Window.partitionBy(*keys) if keys else Window.partitionBy()
    s = _sums(value_col, date_col, over=w)
    fitted = df.withColumns(s).withColumns(_fit_cols()).drop(*[k for k in s if k != "n"])
    pred = F.col("intercept") + F.col("slope") * epoch_day(date_col).cast("double")
    return (fitted.withColumn("prediction", pred)
                  .withColumn("residual", F.col(value_col).cast("double") - F.col("prediction")))


def trend_summary(df: DataFrame, keys: list[str], date_col: str, value_col: str) -> DataFrame:
    """Fit per series plus in-sample RMSE (divisor n, T3).

    Predictions come from a window partitioned by the keys; the RMSE
    aggregate reuses that partitioning (no second shuffle).
    """
    p = trend_predict(df, keys, date_col, value_col)
    r = F.col("residual")
    return p.groupBy(*keys).agg(
        F.first("n").alias("n"), F.first("slope").alias("slope"),
        F.first("intercept").alias("intercept"), F.first("r2").alias("r2"),
        F.sqrt(F.avg(r * r)).alias("rmse"),
        F.max(date_col).alias("ultimo_dia"),
    )


def trend_extrapolate(fit: DataFrame, keys: list[str], last_day_col: str, days: int,
                      start_offset: int = 0, date_col: str = "data_movimentacao") -> DataFrame:
    """``days`` future days per series from last day + ``start_offset`` (T4).

    The default offset 0 repeats the last observed day first, as the
    reference does. ``fit`` needs ``slope``, ``intercept`` and the last day.
    """
    last = F.col(last_day_col)
    seq = F.sequence(F.date_add(last, start_offset), F.date_add(last, start_offset + days - 1),
                     F.expr("INTERVAL 1 DAY"))
    out = fit.select(*keys, "slope", "intercept", F.explode(seq).alias(date_col))
    return out.withColumn("prediction",
                          F.col("intercept") + F.col("slope") * epoch_day(date_col).cast("double"))
