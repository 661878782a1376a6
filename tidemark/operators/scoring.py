"""Scores of forecasts, leaderboards, calibration and distributions."""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.scalars import normal_cdf, student_t4_cdf
from tidemark.operators.selection import grouped_median


def error_rows(df: DataFrame, methods: Sequence[str], actual: str, keep: Sequence[str]) -> DataFrame:
    """One row per method: its prediction and error, where both prediction and actual are known."""
    long = df.select(*keep, actual, *methods).unpivot([*keep, actual], list(methods), "method", "prediction")
    return long.where(F.col("prediction").isNotNull() & F.col(actual).isNotNull()).withColumn("error", F.col("prediction") - F.col(actual))


def score_basic(df: DataFrame, by: Sequence[str], error: str = "error") -> DataFrame:
    e = F.col(error)
    return df.groupBy(*by).agg(
        F.count(e).alias("n"), F.avg(F.abs(e)).alias("mae"), F.sqrt(F.avg(e * e)).alias("rmse"), F.avg(e).alias("bias"), F.max(F.abs(e)).alias("worst")
    )


def score_tolerance(df: DataFrame, by: Sequence[str], limits: Mapping[str, float], error: str = "error") -> DataFrame:
    """Percent of errors within each limit (with a slack of 1e-9), and the median absolute error."""
    e = F.abs(error)
    return df.groupBy(*by).agg(*[(F.avg(F.when(e <= g + 1e-9, 1.0).otherwise(0.0)) * 100).alias(n) for n, g in limits.items()], F.median(e).alias("medae"))


def score_median(df: DataFrame, by: Sequence[str], path: str, error: str = "error") -> DataFrame:
    """The median absolute error of groups of any size; rounds of it are kept under ``path`` (see ``selection``)."""
    return grouped_median(df.withColumn("__e", F.abs(error)), by, "__e", path, "medae")


def score_exact_rounded(df: DataFrame, by: Sequence[str], prediction: str, actual: str, previous: str, digits: int = 1) -> DataFrame:
    """Share that rounds to the same value, half to even; direction only where the actual moved."""
    p, a, b = (F.bround(c, digits) for c in (prediction, actual, previous))
    moved = F.when(a != b, (F.signum(p - b) == F.signum(a - b)).cast("double"))
    return df.groupBy(*by).agg(F.avg((p == a).cast("double")).alias("exact"), F.avg(moved).alias("direction"), F.count(moved).alias("n_moved"))


def score_direction(df: DataFrame, by: Sequence[str], prediction: str, actual: str, reference: str) -> DataFrame:
    hit = (F.signum(F.col(prediction) - F.col(reference)) == F.signum(F.col(actual) - F.col(reference))).cast("double")
    return df.groupBy(*by).agg(F.avg(hit).alias("hit_rate"), F.count(hit).alias("n"))


def score_level(df: DataFrame, by: Sequence[str], log_change: str, previous: str, actual: str) -> DataFrame:
    """Errors of a predicted log change, in units of the level."""
    level = F.col(previous) * F.exp(F.col(log_change))
    return score_basic(df.withColumn("error", level - F.col(actual)), by)


def score_mape(df: DataFrame, by: Sequence[str], actual: str, error: str = "error") -> DataFrame:
    return df.groupBy(*by).agg((F.avg(F.abs(F.try_divide(F.col(error), F.col(actual)))) * 100).alias("mape"))


def leaderboard(df: DataFrame, windows: Mapping[str, Column], baseline: str) -> DataFrame:
    """method by window: n, mae, rmse, and the percent by which rmse betters the baseline's. One pass over the errors."""
    e = F.col("error")
    aggs = [a for name, w in windows.items() for a in (F.count(F.when(w, e)).alias(f"n_{name}"), F.avg(F.when(w, F.abs(e))).alias(f"mae_{name}"), F.sqrt(F.avg(F.when(w, e * e))).alias(f"rmse_{name}"))]
    wide = df.groupBy("method").agg(*aggs)
    rows = F.explode(F.array(*[F.struct(F.lit(n).alias("window"), F.col(f"n_{n}").alias("n"), F.col(f"mae_{n}").alias("mae"), F.col(f"rmse_{n}").alias("rmse")) for n in windows]))
    long = wide.select("method", rows.alias("r")).select("method", "r.*").where("n > 0")
    base = long.where(F.col("method") == baseline).select("window", F.col("rmse").alias("__base"))
    return long.join(F.broadcast(base), "window", "left").withColumn("skill_pct", (1 - F.try_divide(F.col("rmse"), F.col("__base"))) * 100).drop("__base")


def score_by_horizon(df: DataFrame, by: Sequence[str], horizon: str) -> DataFrame:
    """Metrics of each horizon, then their even mean."""
    per = score_basic(df, [*by, horizon])
    return per.groupBy(*by).agg(F.avg("mae").alias("mae"), F.avg("rmse").alias("rmse"), F.count("*").alias("horizons"))


def dm_test(df: DataFrame, by: Sequence[str], error_a: str, error_b: str, least: int = 8) -> DataFrame:
    """Diebold-Mariano statistic of squared errors at horizon 1, and its two-sided p-value by Student's t."""
    d = F.col(error_a) * F.col(error_a) - F.col(error_b) * F.col(error_b)
    out = df.groupBy(*by).agg(F.count(d).alias("n"), F.avg(d).alias("mean_d"), F.var_samp(d).alias("var_d"))
    stat = F.when((F.col("n") >= least) & (F.col("var_d") > 0), F.col("mean_d") / F.sqrt(F.col("var_d") / F.col("n")))
    return out.withColumn("dm", stat).drop("var_d")


@F.pandas_udf(T.DoubleType())
def student_p_value(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    """Two-sided p-value of a t statistic with given degrees of freedom, by quadrature of the density."""
    nodes, weights = np.polynomial.legendre.leggauss(200)
    for t, df in parts:
        out = []
        for x, k in zip(t, df, strict=True):
            if x is None or k is None or math.isnan(x) or k < 1:
                out.append(None)
                continue
            # the tail's angle: x = sqrt(k) tan(a)
            a = math.atan(abs(x) / math.sqrt(k))
            angles = (math.pi / 2 - a) / 2 * nodes + (math.pi / 2 + a) / 2
            area = ((math.pi / 2 - a) / 2 * weights * np.cos(angles) ** (k - 1)).sum()
            out.append(float(2 * area * math.exp(math.lgamma((k + 1) / 2) - math.lgamma(k / 2)) / math.sqrt(math.pi)))
        yield pd.Series(out, dtype="float64")


def brier(df: DataFrame, by: Sequence[str], p: str, outcome: str) -> DataFrame:
    base = df.groupBy(*by).agg(F.avg(F.col(outcome).cast("double")).alias("rate"), F.avg(F.pow(F.col(p) - F.col(outcome), 2)).alias("brier"), F.count("*").alias("n"))
    return base.withColumn("skill", 1 - F.try_divide(F.col("brier"), F.col("rate") * (1 - F.col("rate"))))


def reliability(df: DataFrame, p: str, outcome: str, bins: int = 10) -> DataFrame:
    slot = F.least(F.floor(F.col(p) * bins), F.lit(bins - 1)).alias("bin")
    return df.groupBy(slot).agg(F.count("*").alias("n"), F.avg(p).alias("mean_p"), F.avg(F.col(outcome).cast("double")).alias("rate"))


def rmse_sigma(df: DataFrame, by: Sequence[str], error: str, least: int, fallback: Column) -> DataFrame:
    e = F.col(error)
    return df.groupBy(*by).agg(F.count(e).alias("n"), F.when(F.count(e) >= least, F.sqrt(F.avg(e * e))).otherwise(fallback).alias("sigma"))


def split_normal_fit(df: DataFrame, low: str, point: str, high: str, z: float) -> DataFrame:
    """Scales of the two halves from an interval; rows where the point is not inside are marked."""
    ok = (F.col(low) < F.col(point)) & (F.col(point) < F.col(high))
    return df.withColumn("sigma_lo", F.when(ok, (F.col(point) - F.col(low)) / z)).withColumn("sigma_hi", F.when(ok, (F.col(high) - F.col(point)) / z)).withColumn("valid", ok)


def strike_ladder(df: DataFrame, point: str, width: int, n: int) -> DataFrame:
    """Strikes on multiples of the width, n on either side of the point."""
    middle = (F.floor(F.col(point) / width) * width).cast("long")
    return df.withColumn("strike", F.explode(F.sequence(middle - n * width, middle + n * width, F.lit(width).cast("long"))))


def p_at_least(df: DataFrame, point: str, strike: str, unit: float) -> DataFrame:
    """P(rounded outcome >= strike) under a two-piece normal with sigma_lo and sigma_hi."""
    z = (F.col(strike) - unit / 2 - F.col(point)) / F.when(F.col(strike) - unit / 2 < F.col(point), F.col("sigma_lo")).otherwise(F.col("sigma_hi"))
    return df.withColumn("p_at_least", normal_cdf(-z))


def p_bucket(df: DataFrame, keys: Sequence[str], strike: str) -> DataFrame:
    """Probability from each strike to the next; the last strike keeps what is above it."""
    run = Window.partitionBy(*keys).orderBy(strike)
    return df.withColumn("p_bucket", F.col("p_at_least") - F.coalesce(F.lead("p_at_least").over(run), F.lit(0.0)))


def band_distribution(df: DataFrame, point: str, sigma: str, width: float, span: float = 4.0, heavy: bool = False) -> DataFrame:
    """A row per band: ``band_low``, ``band_high`` and its probability under a normal distribution around the point, or with ``heavy`` under Student's t with 4
    degrees of freedom scaled to the same deviation.

    Bands lie on multiples of the width and reach ``span`` deviations to either side at least. Rows without a positive
    deviation have none.
    """
    low, high = (f((F.col(point) + sign * span * F.col(sigma)) / width).cast("long") for f, sign in ((F.floor, -1), (F.ceil, 1)))
    rows = df.where((F.col(sigma) > 0) & F.col(point).isNotNull()).withColumn("__k", F.explode(F.sequence(low, high - 1)))
    edge = lambda k: F.round(k * width, 6)
    scale = F.col(sigma) / math.sqrt(2.0) if heavy else F.col(sigma)
    cdf = lambda x: (student_t4_cdf if heavy else normal_cdf)((x - F.col(point)) / scale)
    rows = rows.withColumns({"band_low": edge(F.col("__k")), "band_high": edge(F.col("__k") + 1)})
    return rows.withColumn("p_band", cdf(F.col("band_high")) - cdf(F.col("band_low"))).drop("__k")


def live_errors(forecasts: DataFrame, actuals: DataFrame, keys: Sequence[str], made: Column, cutoff: str, forecast: str, order: str, actual: str) -> DataFrame:
    """keys, error: of each key the last forecast made up to the cutoff, less the actual."""
    latest = forecasts.where(made <= F.lit(cutoff)).groupBy(*keys).agg(F.max_by(forecast, order).alias("__f"))
    return latest.join(actuals.select(*keys, F.col(actual).alias("__a")), list(keys)).select(*keys, (F.col("__f") - F.col("__a")).alias("error"))


def freshness(df: DataFrame, day: Column, today: str, max_days: int, group: str | None = None, expected: int | None = None) -> DataFrame:
    """One row: the newest day, whether it is at most ``max_days`` before today, and whether there are as many groups as expected."""
    newest = F.max(day)
    complete = F.count_distinct(group) == expected if group else F.lit(True)
    return df.agg(newest.alias("newest"), F.coalesce(F.datediff(F.lit(today).cast("date"), newest) <= max_days, F.lit(False)).alias("fresh"), complete.alias("complete"))


def freshness_guard(df: DataFrame, day: Column, today: str, max_days: int, group: str | None = None, expected: int | None = None) -> DataFrame:
    """``df``, once it has been found fresh and complete; ValueError if it is not."""
    state = freshness(df, day, today, max_days, group, expected).first()
    if not state.fresh:
        raise ValueError(f"newest input is of {state.newest}, more than {max_days} days before {today}")
    if not state.complete:
        raise ValueError(f"{group} has not {expected} different values")
    return df


def before_release(df: DataFrame, day: Column, release: Column) -> DataFrame:
    """Rows of days before their month's release."""
    return df.where(day < release)
