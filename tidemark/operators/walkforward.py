"""Walk-forward fits: at every origin a regression on the rows before it predicts that row.

A refit per origin costs the square of a series' length. Here every origin's normal equations are running sums over the rows
before it, kept by Catalyst in one window pass; only the small solves go through Arrow, in batches of rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _finite(c: Column) -> Column:
    return c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf")))


def _sums(df: DataFrame, keys: Sequence[str], period: str, y: str, xs: Sequence[Column]) -> DataFrame:
    """Adds __x (complete regressors or null), __n, __xx and __xy: sums over the usable rows before each row."""
    complete = F.lit(True)
    for x in xs:
        complete = complete & _finite(x)
    df = df.withColumn("__x", F.when(complete, F.array(*xs)))
    usable = F.col("__x").isNotNull() & _finite(F.col(y).cast("double"))
    before = Window.partitionBy(*keys).orderBy(period).rowsBetween(Window.unboundedPreceding, -1)
    total = lambda c: F.coalesce(F.sum(F.when(usable, c)).over(before), F.lit(0.0))
    p, x, target = len(xs), F.col("__x"), F.col(y).cast("double")
    return df.withColumns(
        {
            "__n": F.count(F.when(usable, 1)).over(before),
            "__xx": F.array(*[total(x[i] * x[j]) for i in range(p) for j in range(i, p)]),
            "__xy": F.array(*[total(x[i] * target) for i in range(p)]),
        }
    )


def _symmetric(flat: np.ndarray, p: int) -> np.ndarray:
    a = np.empty((len(flat), p, p))
    i, j = np.triu_indices(p)
    a[:, i, j] = flat
    a[:, j, i] = flat
    return a


def _stack(s: pd.Series) -> np.ndarray:
    return np.stack([np.asarray(v, float) for v in s]) if len(s) else np.zeros((0, 0))


def solver(p: int, ridge: float | None = None):
    """Prediction from running sums; the first regressor of a ridge fit is the constant, which is not penalised."""

    @F.pandas_udf(T.DoubleType())
    def solve(parts: Iterator[tuple[pd.Series, pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for xx, xy, x, n in parts:
            out = np.full(len(x), np.nan)
            ready = np.flatnonzero(x.notna() & (n > 0))
            if len(ready):
                a, b, now = _symmetric(_stack(xx.iloc[ready]), p), _stack(xy.iloc[ready]), _stack(x.iloc[ready])
                if ridge is None:
                    beta = np.einsum("kij,kj->ki", np.linalg.pinv(a, rcond=1e-12, hermitian=True), b)
                    out[ready] = (beta * now).sum(axis=1)
                else:
                    count = a[:, 0, 0]
                    mean, mean_y = a[:, 0, 1:] / count[:, None], b[:, 0] / count
                    cov = a[:, 1:, 1:] - count[:, None, None] * mean[:, :, None] * mean[:, None, :]
                    sd = np.sqrt(np.maximum(np.einsum("kii->ki", cov) / count[:, None], 0))
                    sd[sd == 0] = 1.0
                    s = cov / (sd[:, :, None] * sd[:, None, :])
                    z = (b[:, 1:] - mean * b[:, :1]) / sd
                    beta = np.linalg.solve(s + ridge * np.eye(p - 1), z[:, :, None])[:, :, 0]
                    out[ready] = mean_y + (beta * (now[:, 1:] - mean) / sd).sum(axis=1)
            yield pd.Series(out)

    return solve


def wf_ols(
    df: DataFrame,
    keys: Sequence[str],
    period: str,
    y: str,
    xs: Sequence[str],
    min_train: int,
    intercept: bool = True,
    ridge: float | None = None,
    out: str = "prediction",
    only_last: bool = False,
) -> DataFrame:
    """``df`` with n_train and the prediction of each row; null with fewer than ``min_train`` usable rows or incomplete regressors.
    ``only_last``: each key's last period alone is kept, before anything is solved."""
    columns = ([F.lit(1.0)] if intercept else []) + [F.col(x).cast("double") for x in xs]
    rows = _sums(df, keys, period, y, columns)
    if only_last:
        rows = rows.withColumn("__next", F.lead(period).over(Window.partitionBy(*keys).orderBy(period))).where("__next IS NULL").drop("__next")
    ready = (F.col("__n") >= min_train) & F.col("__x").isNotNull()
    found = solver(len(columns), ridge)("__xx", "__xy", "__x", "__n")
    return rows.withColumn(out, F.when(ready, F.nanvl(found, F.lit(None).cast("double")))).withColumnRenamed("__n", "n_train").drop("__x", "__xx", "__xy")


def wf_ols_simple(df: DataFrame, keys: Sequence[str], period: str, y: str, x: str, min_train: int, out: str = "prediction") -> DataFrame:
    """One regressor and a constant, by built-in window aggregates."""
    before = Window.partitionBy(*keys).orderBy(period).rowsBetween(Window.unboundedPreceding, -1)
    both = F.col(y).isNotNull() & F.col(x).isNotNull()
    a, b = F.regr_intercept(y, x).over(before), F.regr_slope(y, x).over(before)
    n = F.count(F.when(both, 1)).over(before)
    return df.withColumn("n_train", n).withColumn(out, F.when(n >= min_train, a + b * F.col(x)))


def fit_next(df: DataFrame, keys: Sequence[str], period: str, y: str, xs: Sequence[str], min_train: int, **how) -> DataFrame:
    """Only each key's last period: the live forecast. One solve a key."""
    return wf_ols(df, keys, period, y, xs, min_train, only_last=True, **how)


#: Origins and blocks are lists that somebody states; this many are sent to the tasks at most.
MAX_STATED = 10_000


def stated(origins: DataFrame) -> DataFrame:
    """A stated list of origins, marked to be sent to every task, once its length has been checked."""
    origins = origins.select("origin").distinct()
    if origins.limit(MAX_STATED + 1).count() > MAX_STATED:
        raise ValueError(f"more than {MAX_STATED} origins")
    return F.broadcast(origins)


class RidgeSweep:
    """Standardised ridge over a growing set of rows: means and centred products are moved by one row at a time, and leave-one-out
    errors of all penalties follow from one factorisation of the products.

    With the standardised products' eigenvectors V and values d, a row's leverage under penalty a is the sum of (zV)^2 / (d + a) and its fit
    the sum of (zV) w / (d + a), so an origin costs one product of the rows with V and no solve per penalty or per row left out.
    """

    def __init__(self, width: int, alphas: np.ndarray, capacity: int):
        self.alphas, self.n = alphas, 0
        self.mean, self.products = np.zeros(width), np.zeros((width, width))
        self.mean_y, self.cross = 0.0, np.zeros(width)
        self.x, self.y = np.empty((capacity, width)), np.empty(capacity)

    def add(self, x: np.ndarray, y: float) -> None:
        self.x[self.n], self.y[self.n] = x, y
        self.n += 1
        step, step_y = x - self.mean, y - self.mean_y
        self.mean, self.mean_y = self.mean + step / self.n, self.mean_y + step_y / self.n
        self.products += np.outer(step, x - self.mean)
        self.cross += step * (y - self.mean_y)

    def predict(self, now: np.ndarray) -> tuple[float, float]:
        """(prediction, penalty of the least mean squared leave-one-out error; of equals the first)."""
        sd = np.sqrt(np.maximum(np.diag(self.products) / self.n, 0))
        sd[sd == 0] = 1.0
        d, v = np.linalg.eigh(self.products / np.outer(sd, sd))
        d = np.maximum(d, 0)
        turned = ((self.x[: self.n] - self.mean) / sd) @ v
        w = v.T @ (self.cross / sd)
        shrink = 1.0 / (d[:, None] + self.alphas[None, :])
        fits, leverage = turned @ (w[:, None] * shrink), (turned**2) @ shrink
        rest = (self.y[: self.n] - self.mean_y)[:, None] - fits
        error = rest / (1 - leverage - 1 / self.n)
        best = int(np.argmin((error**2).mean(axis=0)))
        return self.mean_y + float(((now - self.mean) / sd) @ v @ (w * shrink[:, best])), float(self.alphas[best])


def wf_ridge_cv(
    df: DataFrame, keys: Sequence[str], period: str, y: str, xs: Sequence[str], min_train: int, alphas: Sequence[float], origins: DataFrame | None = None
) -> DataFrame:
    """Standardised ridge with the penalty of least leave-one-out error, at each of a stated list of origins, or at every row.

    A group is one series, swept once: rows are shuffled once, by series, whatever the number of origins. Stated origins get a row for every series that has
    begun by then; a series without a row at an origin, with fewer than ``min_train`` complete rows before it, or with incomplete regressors at
    it, has no prediction there.
    """
    cols = [F.col(x).cast("double") for x in xs]
    rows = df.select(*keys, F.col(period).cast("date").alias("__p"), F.col(y).cast("double").alias("__y"), F.array(*cols).alias("__v"))
    listed = None if origins is None else sorted(r.origin for r in stated(origins.select(F.col("origin").cast("date"))).collect() if r.origin is not None)
    grid = np.asarray(alphas, float)

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf[pdf["__p"].notna()].sort_values("__p", kind="stable")
        x = np.array([[np.nan if e is None else e for e in v] for v in pdf["__v"]], float).reshape(len(pdf), len(xs))
        yy, days = pdf["__y"].to_numpy(float), pdf["__p"].tolist()
        good = np.isfinite(x).all(axis=1)
        sweep, at, out = RidgeSweep(len(xs), grid, len(pdf)), 0, []
        for origin in days if listed is None else listed:
            if not days or days[0] > origin:
                continue
            while at < len(days) and days[at] < origin:
                if good[at] and np.isfinite(yy[at]):
                    sweep.add(x[at], yy[at])
                at += 1
            prediction = alpha = None
            if sweep.n >= max(min_train, 1) and at < len(days) and days[at] == origin and good[at]:
                prediction, alpha = sweep.predict(x[at])
            out.append((origin, alpha, prediction, sweep.n))
        found = pd.DataFrame({k: pdf[k].iloc[:1].repeat(len(out)).to_numpy() for k in keys})
        for i, name in enumerate(("origin", "alpha", "prediction", "n_train")):
            found[name] = pd.Series([o[i] for o in out], dtype=object if i == 0 else "float64" if i < 3 else "int64")
        return found

    schema = T.StructType([df.schema[k] for k in keys] + [T.StructField("origin", T.DateType()), T.StructField("alpha", T.DoubleType()), T.StructField("prediction", T.DoubleType()), T.StructField("n_train", T.LongType())])
    out = rows.groupBy(*keys).applyInPandas(fit, schema)
    return out.withColumns({c: F.nanvl(c, F.lit(None).cast("double")) for c in ("alpha", "prediction")})


def wf_ecm(df: DataFrame, keys: Sequence[str], period: str, a: str, b: str, min_train: int) -> DataFrame:
    """Error correction, both steps re-estimated at every origin from running sums alone.

    Long run: a = alpha + beta b over the rows before. Short run: the change of a on last row's gap e = a - alpha - beta b. The
    short run's sums are polynomials in alpha and beta of sums that don't depend on the origin, so nothing is fanned out.
    """
    run = Window.partitionBy(*keys).orderBy(period)
    before = run.rowsBetween(Window.unboundedPreceding, -1)
    rows = df.withColumn("__a1", F.lag(a).over(run)).withColumn("__b1", F.lag(b).over(run)).withColumn("__d", F.col(a) - F.col("__a1"))
    ok = F.col("__d").isNotNull() & F.col("__b1").isNotNull()
    s = lambda c: F.sum(F.when(ok, c)).over(before)
    d, x, z = F.col("__d"), F.col("__a1"), F.col("__b1")
    rows = (
        rows.withColumn("alpha", F.regr_intercept(a, b).over(before))
        .withColumn("beta", F.regr_slope(a, b).over(before))
        .withColumn("__n", F.count(F.when(ok, 1)).over(before))
        .withColumn("__s", F.struct(s(d).alias("d"), s(x).alias("x"), s(z).alias("z"), s(x * x).alias("xx"), s(x * z).alias("xz"), s(z * z).alias("zz"), s(d * x).alias("dx"), s(d * z).alias("dz")))
    )
    al, be, n, t = F.col("alpha"), F.col("beta"), F.col("__n"), F.col("__s")
    se = t["x"] - al * n - be * t["z"]
    see = t["xx"] + al * al * n + be * be * t["zz"] - 2 * al * t["x"] - 2 * be * t["xz"] + 2 * al * be * t["z"]
    sde = t["dx"] - al * t["d"] - be * t["dz"]
    gamma = F.try_divide(sde - se * t["d"] / n, see - se * se / n)
    const = t["d"] / n - gamma * se / n
    gap = x - al - be * z
    return rows.select(*df.columns, "alpha", "beta", n.alias("n_train"), gamma.alias("gamma"), gap.alias("gap"), F.when(n >= min_train, const + gamma * gap).alias("prediction"))


def ecm_next_step(df: DataFrame, gamma: str, gap: str, days: int) -> DataFrame:
    """The step a day that closes the gap at its speed."""
    return df.withColumn("daily_step", F.col(gamma) * F.col(gap) / days)


def baselines(df: DataFrame, keys: Sequence[str], period: str, y: str, masked: Column | None = None) -> DataFrame:
    """Random walk, seasonal naive (else random walk), mean of 3, long-run mean, zero, drift; masked rows teach nothing."""
    run = Window.partitionBy(*keys).orderBy(period)
    before, last3 = run.rowsBetween(Window.unboundedPreceding, -1), run.rowsBetween(-3, -1)
    known = F.col(y) if masked is None else F.when(~masked, F.col(y))
    walk = F.last(known, ignorenulls=True).over(before)
    season = F.lag(known, 12).over(run)
    first, n = F.first(known, ignorenulls=True).over(before), F.count(known).over(before)
    return (
        df.withColumn("rw", walk)
        .withColumn("seasonal", F.coalesce(season, walk))
        .withColumn("mean3", F.avg(known).over(last3))
        .withColumn("long_run", F.avg(known).over(before))
        .withColumn("zero", F.lit(0.0))
        .withColumn("drift", F.when(n >= 2, walk + (walk - first) / (n - 1)))
    )


def seasonal_drift(df: DataFrame, keys: Sequence[str], period: str, y: str, masked: Column | None = None, out: str = "seasonal_drift") -> DataFrame:
    """``df`` (a month a row, without gaps) with last month's value, carried on by the mean log change into this calendar month over the unmasked rows
    before; null where last month has no positive value or there is no such change yet."""
    run = Window.partitionBy(*keys).orderBy(period)
    month = Window.partitionBy(*keys, F.month(period)).orderBy(period).rowsBetween(Window.unboundedPreceding, -1)
    log = F.when(F.col(y) > 0, F.ln(F.when(F.col(y) > 0, F.col(y))))
    rows = df.withColumn("__log", log)
    last = F.lag("__log").over(run)
    step = F.col("__log") - last
    rows = rows.withColumns({"__last": last, "__step": step if masked is None else F.when(~masked, step)})
    return rows.withColumn(out, F.exp(F.col("__last") + F.avg("__step").over(month))).drop("__log", "__last", "__step")


def multi_horizon_naive(df: DataFrame, origins: DataFrame, keys: Sequence[str], period: str, y: str, horizons: int) -> DataFrame:
    """Grid of origins and horizons: the random walk from the origin, and the value a year before the target."""
    grid = df.select(*keys).distinct().join(stated(origins)).withColumn("horizon", F.explode(F.sequence(F.lit(1), F.lit(horizons))))
    grid = grid.withColumn("target", F.add_months("origin", F.col("horizon")))
    at_origin = df.select(*keys, F.col(period).alias("origin"), F.col(y).alias("rw"))
    year_before = df.select(*keys, F.add_months(period, 12).alias("target"), F.col(y).alias("seasonal"))
    return grid.join(at_origin, [*keys, "origin"], "left").join(year_before, [*keys, "target"], "left")


def shrunk_ratio(
    df: DataFrame,
    keys: Sequence[str],
    y: str,
    x: str,
    prior: float,
    strength: float,
    low: float,
    high: float,
    completeness: str | None = None,
    leave_one_out: bool = False,
    counts: Column | None = None,
) -> DataFrame:
    """``raw_ratio``: sum of y over sum of x, over a key's rows for which ``counts`` holds (say, from a floor month on and with enough of
    the month seen); ``ratio``: the same shrunk to a prior by a pseudo-count (less of it the more complete the row) and clipped.

    Left out: the ratio of a row is that of all rows of its key but itself.
    """
    whole = Window.partitionBy(*keys)
    real = F.col(y).isNotNull() & F.col(x).isNotNull()
    taken = F.coalesce(real if counts is None else real & counts, F.lit(False))
    own = lambda c: F.when(taken, F.col(c)).otherwise(F.lit(0)) if leave_one_out else F.lit(0)
    total = lambda c: F.coalesce(F.sum(F.when(taken, F.col(c))).over(whole), F.lit(0)) - own(c)
    k = F.lit(strength) * (1 - F.col(completeness)) if completeness else F.lit(strength)
    ratio = F.try_divide(total(y) + k * prior, total(x) + k)
    return df.withColumns({"raw_ratio": F.try_divide(total(y), total(x)), "ratio": F.greatest(F.least(ratio, F.lit(high)), F.lit(low))})


def maturity_blend(df: DataFrame, signal: str, prior: str, completeness: str, gamma: float) -> DataFrame:
    w = F.pow(F.col(completeness), F.lit(gamma))
    blended = w * F.col(signal) + (1 - w) * F.col(prior)
    return df.withColumn("blend", F.when((F.col(completeness) > 0) & F.col(signal).isNotNull(), blended).otherwise(F.col(prior)))


def ensemble_mean(df: DataFrame, members: Sequence[str], log_space: bool = False) -> DataFrame:
    """Mean of the members there are, and which they were."""
    values = F.array(*[F.when(F.col(m).isNotNull(), F.ln(m) if log_space else F.col(m)) for m in members])
    kept = F.filter(values, lambda v: v.isNotNull())
    mean = F.aggregate(kept, F.lit(0.0), lambda a, v: a + v) / F.size(kept)
    names = F.concat_ws("+", *[F.when(F.col(m).isNotNull(), F.lit(m)) for m in members])
    return df.withColumn("ensemble", F.when(F.size(kept) > 0, F.exp(mean) if log_space else mean)).withColumn("method", names)


def bottom_up(df: DataFrame, keys: Sequence[str], period: str, name: str, value: str, predicted: Mapping[str, str]) -> DataFrame:
    """Total's log change when named parts are forecast apart and the rest is carried: keys, period, total_dlog.

    ``df`` is long (keys, period, name, value) with a prediction column; ``predicted`` maps the parts' names to that column's output
    names. The rest is the total of the period before less the parts' values then.
    """
    total = df.groupBy(*keys, period).agg(F.sum(value).alias("__total"))
    parts = df.groupBy(*keys, period).pivot(name, list(predicted)).agg(F.first("prediction").alias("p"), F.first(value).alias("v"))
    run = Window.partitionBy(*keys).orderBy(period)
    rows = total.join(parts, [*keys, period])
    last = F.lag("__total").over(run)
    new = last
    for part in predicted:
        new = new + F.col(f"`{part}_p`") - F.lag(F.col(f"`{part}_v`")).over(run)
    rows = rows.withColumns({"__new": new, "__last": last})
    return rows.select(*keys, period, F.when((F.col("__new") > 0) & (F.col("__last") > 0), F.ln("__new") - F.ln("__last")).alias("total_dlog"))


def platt_scaling(
    df: DataFrame, p: str, label: str, period: str, blocks: Sequence[str], least: int = 30, low: float = 0.05, high: float = 0.95
) -> DataFrame:
    """``df`` with ``calibrated``: at the start of each block (a stated list of dates) a logistic regression of the label on logit(p) over
    the labelled rows of all periods before it, applied to the block's rows. p clipped before the first block and where those rows are
    few or of one class."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.functions import array_to_vector

    bounded = F.greatest(F.least(F.col(p), F.lit(1 - 1e-6)), F.lit(1e-6))
    rows = df.withColumn("__z", F.ln(bounded / (1 - bounded)))
    known = rows.where(F.col(label).isNotNull() & F.col("__z").isNotNull())
    clipped = lambda c: F.greatest(F.least(c, F.lit(high)), F.lit(low))
    calibrated = clipped(F.col(p))
    for start in sorted(blocks):
        day = F.lit(start).cast("date")
        before = known.where(F.col(period) < day)
        n, classes = before.agg(F.count("*"), F.count_distinct(label)).first()
        z = F.col(p)
        if n >= least and classes == 2:
            data = before.select(array_to_vector(F.array("__z")).alias("features"), F.col(label).cast("double").alias("label"))
            m = LogisticRegression(regParam=1e-6).fit(data)
            z = 1 / (1 + F.exp(-(F.lit(float(m.intercept)) + F.lit(float(m.coefficients[0])) * F.col("__z"))))
        calibrated = F.when(F.col(period) >= day, clipped(z)).otherwise(calibrated)
    return rows.withColumn("calibrated", calibrated).drop("__z")
