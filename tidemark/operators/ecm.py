"""Error correction in full, re-estimated at every origin: lags, a gap split by sign, and gaps centred on their calendar month.

At origin p the long run y = alpha + beta x is fitted to all rows up to p. A row's gap is y - alpha - beta x, less the mean gap of its
calendar month up to p if gaps are centred. The short run regresses the next change of y on a constant, lagged changes and the gap
(or its positive and negative parts), over the rows whose next change is known at p, and predicts the level after p.

All gaps change with each origin. Products of regressors don't have to be summed anew for that: a gap is a combination of y, x and the
constant whose coefficients depend on the origin and month alone, so sums by month of products of (lags, y, x, next change) give all
products with gaps. The split needs those sums over the rows of positive gap too. Between two origins the coefficients
move little: only rows whose gap was nearer to zero than the largest possible move can change sides. They are found by
binary search in the gaps as they were last sorted; when they become many, the gaps are sorted again.

A series is swept once, in one group of ``applyInPandas``: the shuffle deals out by series and is as long as the table, whatever the
number of origins. A task holds one series, so a series must fit it: a hundred years of days are 36,500 rows.

Defined cases: rows without y or x have no gap and teach nothing; lags count rows, so a missing row in between leaves null lags
near it. A calendar month of fewer than ``least_month`` gaps has no centre, and its rows teach nothing and get no prediction. Rank-deficient
regressors give the solution of least norm. A series shorter than the warm-up gives no rows; an empty table none.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class EcmSpec:
    """Lags of the changes of x, of y and of further columns; ``gap``: "none", "plain" or "split" by sign."""

    x_lags: tuple[int, ...] = (0, 1, 2, 3)
    y_lags: tuple[int, ...] = (1,)
    other_lags: tuple[tuple[str, tuple[int, ...]], ...] = ()
    gap: str = "plain"
    split_x: bool = False
    by_month: bool = False
    least_month: int = 3

    def __post_init__(self):
        if self.gap not in ("none", "plain", "split"):
            raise ValueError(f"no such gap: {self.gap}")

    @property
    def longest(self) -> int:
        return max((*self.x_lags, *self.y_lags, *(k for _, lags in self.other_lags for k in lags), 1))

    @property
    def gaps(self) -> int:
        return {"none": 0, "plain": 1, "split": 2}[self.gap]


def _change(v: np.ndarray) -> np.ndarray:
    return np.concatenate([[np.nan], np.diff(v)]) if len(v) else v


def _lagged(v: np.ndarray, k: int) -> np.ndarray:
    return np.concatenate([np.full(min(k, len(v)), np.nan), v[: max(len(v) - k, 0)]])


def fixed_regressors(spec: EcmSpec, y: np.ndarray, x: np.ndarray, others: dict[str, np.ndarray]) -> np.ndarray:
    """The constant and what doesn't depend on the origin, a row per row."""
    dx = _change(x)
    out = [np.ones(len(y))]
    out += [_lagged(dx, k) for k in spec.x_lags if k or not spec.split_x]
    out += [_lagged(_change(y), k) for k in spec.y_lags]
    out += [_lagged(_change(others[name]), k) for name, lags in spec.other_lags for k in lags]
    if spec.split_x:
        out += [np.maximum(dx, 0), np.minimum(dx, 0)]
    return np.column_stack(out)


class SignedSums:
    """Sums by class of products of rows, over all rows and over those of positive gap, while the gap's coefficients move."""

    def __init__(self, rows: np.ndarray, y: np.ndarray, x: np.ndarray, classes: np.ndarray, n_classes: int):
        self.rows, self.y, self.x, self.classes = rows, y, x, classes
        width = rows.shape[1]
        self.all, self.positive = np.zeros((n_classes, width, width)), np.zeros((n_classes, width, width))
        self.above = np.zeros(len(rows), bool)
        self.taken: list[int] = []  # rows added since gaps were last sorted
        self.sorted_rows, self.sorted_gaps = np.zeros(0, np.int64), np.zeros(0)
        self.offset, self.slope = np.zeros(n_classes), 0.0  # as they were then
        self.reach = self.farthest = 0.0
        #: Rows looked at, and sorts.
        self.looked = self.sorts = 0

    def add(self, i: int) -> None:
        self.all[self.classes[i]] += np.outer(self.rows[i], self.rows[i])
        self.taken.append(i)
        self.reach = max(self.reach, abs(self.x[i]))

    def _gaps(self, which: np.ndarray, offset: np.ndarray, slope: float) -> np.ndarray:
        return self.y[which] - offset[self.classes[which]] - slope * self.x[which]

    def move(self, offset: np.ndarray, slope: float) -> None:
        """Let the gap be y - offset[class] - slope x from now on."""
        most = float(np.abs(offset - self.offset).max()) + abs(slope - self.slope) * self.reach
        # rows that changed sides on an earlier, farther move may have to change back
        most = self.farthest = max(self.farthest, most + 1e-9 * (1.0 + most))
        low, high = int(np.searchsorted(self.sorted_gaps, -most, side="left")), int(np.searchsorted(self.sorted_gaps, most, side="right"))
        again = high - low + len(self.taken) > 32 + 2 * int(np.sqrt(len(self.sorted_rows) + len(self.taken)))
        near = self.sorted_rows if again else self.sorted_rows[low:high]
        which = np.concatenate([near, np.array(self.taken, np.int64)])
        gaps = self._gaps(which, offset, slope)
        for i in which[(gaps > 0) != self.above[which]].tolist():
            sign = -1.0 if self.above[i] else 1.0
            self.positive[self.classes[i]] += sign * np.outer(self.rows[i], self.rows[i])
            self.above[i] = not self.above[i]
        self.looked += len(which)
        if again:
            order = np.argsort(gaps, kind="stable")
            self.sorted_rows, self.sorted_gaps, self.taken = which[order], gaps[order], []
            self.offset, self.slope, self.farthest, self.sorts = offset.copy(), slope, 0.0, self.sorts + 1


def _solve(gram: np.ndarray, right: np.ndarray) -> np.ndarray:
    scale = np.sqrt(np.maximum(np.diag(gram), 0))
    scale[scale == 0] = 1.0
    return np.linalg.pinv(gram / np.outer(scale, scale), rcond=1e-12, hermitian=True) @ (right / scale) / scale


def sweep(spec: EcmSpec, y: np.ndarray, x: np.ndarray, months: np.ndarray, others: dict[str, np.ndarray], first: int, spare: int) -> list[tuple]:
    """(row, n_train, alpha, beta, gap, predicted change) of each origin from row ``first`` on that has a prediction."""
    n = len(y)
    known = np.isfinite(y) & np.isfinite(x)
    if not known.any():
        return []
    # sums are taken around the first known values, which leaves gaps as they are
    y0, x0 = y[known][0], x[known][0]
    fixed = fixed_regressors(spec, y, x, others)
    target = np.concatenate([np.diff(y), [np.nan]])
    yc, xc = np.where(known, y - y0, 0.0), np.where(known, x - x0, 0.0)
    rows = np.column_stack([fixed, yc, xc, np.nan_to_num(target)])
    complete = np.isfinite(fixed).all(axis=1) & (known | (spec.gap == "none"))
    teaches = complete & np.isfinite(target)
    k = fixed.shape[1]
    classes = (months - 1) if spec.by_month else np.zeros(n, np.int64)
    n_classes = 12 if spec.by_month else 1
    sums = SignedSums(np.where(complete[:, None], rows, 0.0), yc, xc, classes, n_classes)
    count, sy, sx = np.zeros(n_classes), np.zeros(n_classes), np.zeros(n_classes)
    mean_y = mean_x = sxx = sxy = seen = 0.0
    warm, out = spec.longest + 1, []
    for p in range(n):
        if known[p]:
            seen += 1
            dx, dy = xc[p] - mean_x, yc[p] - mean_y
            mean_x, mean_y = mean_x + dx / seen, mean_y + dy / seen
            sxx, sxy = sxx + dx * (xc[p] - mean_x), sxy + dx * (yc[p] - mean_y)
            c = classes[p]
            count[c], sy[c], sx[c] = count[c] + 1, sy[c] + yc[p], sx[c] + xc[p]
        if p - 1 >= warm and teaches[p - 1]:
            sums.add(p - 1)
        if p < first or not complete[p] or seen < 1:
            continue
        beta = sxy / sxx if sxx > 0 else 0.0
        alpha = mean_y - beta * mean_x
        offset, held = np.full(n_classes, alpha), np.ones(n_classes, bool)
        if spec.by_month and spec.gap != "none":
            held = count >= spec.least_month
            offset = np.where(held, (sy - beta * sx) / np.maximum(count, 1), alpha)
        if spec.gap == "split":
            sums.move(offset, beta)
        used = np.flatnonzero(held)
        n_train = int(round(sums.all[used, 0, 0].sum()))
        if n_train < k + spec.gaps + spare or not held[classes[p]]:
            continue
        # columns: fixed regressors, gap, next change
        turn = np.zeros((n_classes, k + 3, k + 2))
        turn[:, :k, :k] = np.eye(k)
        turn[:, 0, k], turn[:, k, k], turn[:, k + 1, k], turn[:, k + 2, k + 1] = -offset, 1.0, -beta, 1.0
        whole = np.einsum("cij,cil,clm->jm", turn[used], sums.all[used], turn[used], optimize=True)
        gap = yc[p] - offset[classes[p]] - beta * xc[p]
        if spec.gap == "none":
            gram, right, now = whole[:k, :k], whole[:k, k + 1], fixed[p]
        elif spec.gap == "plain":
            gram, right, now = whole[: k + 1, : k + 1], whole[: k + 1, k + 1], np.append(fixed[p], gap)
        else:
            up = np.einsum("cij,cil,clm->jm", turn[used], sums.positive[used], turn[used], optimize=True)
            down = whole - up
            gram = np.zeros((k + 2, k + 2))
            gram[:k, :k] = whole[:k, :k]
            for at, part in ((k, up), (k + 1, down)):
                gram[at, :k] = gram[:k, at] = part[:k, k]
                gram[at, at] = part[k, k]
            right = np.concatenate([whole[:k, k + 1], [up[k, k + 1], down[k, k + 1]]])
            now = np.concatenate([fixed[p], [max(gap, 0.0), min(gap, 0.0)]])
        out.append((p, n_train, alpha + y0 - beta * x0, beta, gap, float(now @ _solve(gram, right))))
    return out


def walk_forward_ecm(
    df: DataFrame, keys: Sequence[str], period: str, y: str, x: str, spec: EcmSpec, start: str | None = None, burn_in: int = 30, spare: int = 5
) -> DataFrame:
    """One row per series and origin that has a prediction: keys, ``origin``, ``target`` (the next row's period; null after the last
    row, whose prediction is the live one), n_train, alpha, beta, gap, prediction (a level) and actual.

    Origins begin at the first period from ``start`` on, yet ``burn_in`` rows after the lags are full, and need ``spare`` training rows
    more than regressors. Repeated periods of a series count as rows of their own, in the order of their values.
    """
    others = [name for name, _ in spec.other_lags]
    columns = list(dict.fromkeys([y, x, *others]))
    read = df.select(*keys, F.col(period).cast("date").alias("__p"), *[F.col(c).cast("double").alias(f"__c{i}") for i, c in enumerate(columns)])
    at = {c: f"__c{i}" for i, c in enumerate(columns)}
    begin = pd.Timestamp(start) if start else None

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf[pdf["__p"].notna()].sort_values(["__p", *at.values()], kind="stable")
        days = pd.to_datetime(pdf["__p"])
        value = {c: pdf[name].to_numpy(float) for c, name in at.items()}
        first = spec.longest + 1 + burn_in
        if begin is not None:
            first = max(first, int(days.searchsorted(begin)))
        found = sweep(spec, value[y], value[x], days.dt.month.to_numpy(), {c: value[c] for c in others}, first, spare)
        n, p = len(pdf), np.array([f[0] for f in found], np.int64)
        periods = pdf["__p"].to_numpy(object)
        after = [periods[i + 1] if i + 1 < n else None for i in p]
        out = pd.DataFrame({key: pdf[key].iloc[:1].repeat(len(p)).to_numpy() for key in keys})
        out["origin"], out["target"] = periods[p], pd.Series(after, dtype=object)
        for i, name in enumerate(("n_train", "alpha", "beta", "gap"), 1):
            out[name] = [f[i] for f in found]
        out["prediction"] = [value[y][f[0]] + f[5] for f in found]
        out["actual"] = [value[y][i + 1] if i + 1 < n else np.nan for i in p]
        return out

    double = lambda name: T.StructField(name, T.DoubleType())
    schema = T.StructType(
        [df.schema[k] for k in keys]
        + [T.StructField("origin", T.DateType()), T.StructField("target", T.DateType()), T.StructField("n_train", T.LongType())]
        + [double(c) for c in ("alpha", "beta", "gap", "prediction", "actual")]
    )
    out = read.groupBy(*keys).applyInPandas(fit, schema)
    return out.withColumn("actual", F.nanvl("actual", F.lit(None).cast("double")))
