"""Boosted trees at every origin of many series, fitted anew every few rows.

A series is one group: rows are shuffled once, by series. Within it the fits of all refit points grow together: a tree's level takes
one histogram of gradients by (fit, node, regressor, bin) over the training rows of all fits, and one choice of the best split per node. Fits
are taken so many at a time that their training rows stay under ``AT_ONCE``, so memory is bounded by a series' length and that.

Bins are quantiles of a fit's own training rows. A split maximises the sum over its sides of (sum of gradients)^2 / (sum of curvatures);
of equals the first regressor and lowest bin wins. A node that no split betters stays a leaf. Labels train by the logistic loss, values by the squared.

Defined cases: rows with an incomplete regressor get no prediction and teach nothing; rows without a target teach nothing but are predicted. Origins with fewer
than ``min_train`` complete rows before them have no prediction. Labels of one class predict that class's share. Rows of one period are taken
in the order of their values, so that reruns agree. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Training rows, summed over fits, that grow trees together.
AT_ONCE = 1_000_000


@dataclass(frozen=True)
class TreeSpec:
    trees: int = 100
    depth: int = 3
    rate: float = 0.05
    least_leaf: int = 5
    bins: int = 32
    classify: bool = False


def edges(values: np.ndarray, bins: int) -> np.ndarray:
    """Upper bounds of all bins but the last."""
    distinct = np.unique(values)
    if len(distinct) > bins:
        distinct = np.unique(np.quantile(values, np.arange(1, bins) / bins))
        return distinct
    return distinct[:-1]


def _binned(x: np.ndarray, bounds: list[np.ndarray]) -> np.ndarray:
    return np.column_stack([np.searchsorted(b, x[:, k], side="left") for k, b in enumerate(bounds)])


def best_splits(g: np.ndarray, h: np.ndarray, n: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """(regressor, bin) per node, from sums by node, regressor and bin; rows up to the bin go left. The last bin: no split."""
    nodes, k, b = g.shape
    left = [np.cumsum(a, axis=2) for a in (g, h, n)]
    whole = [a[:, :, -1:] for a in left]
    right = [w - a for w, a in zip(whole, left, strict=True)]
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = left[0] ** 2 / left[1] + right[0] ** 2 / right[1] - whole[0] ** 2 / whole[1]
    gain[~((left[2] >= least) & (right[2] >= least) & np.isfinite(gain))] = -np.inf
    flat = gain.reshape(nodes, k * b)
    # sums of equal splits differ by rounding; the first within it counts
    top = flat.max(axis=1, keepdims=True)
    pick = np.argmax(flat >= top - 1e-9 * np.maximum(1.0, np.abs(top)), axis=1)
    feature, at = pick // b, pick % b
    none = ~(top[:, 0] > 1e-9 * np.maximum(1.0, np.abs(whole[0][:, 0, 0])))
    return np.where(none, 0, feature), np.where(none, b - 1, at)


def boosted(spec: TreeSpec, trains: list[tuple[np.ndarray, np.ndarray]], asks: list[np.ndarray]) -> list[np.ndarray]:
    """Predictions for each fit's rows: ``trains`` are (regressors, target) of each fit, ``asks`` the regressors to predict for."""
    m, width = len(trains), trains[0][0].shape[1]
    bounds = [[edges(x[:, k], spec.bins) for k in range(width)] for x, _ in trains]
    b = max([len(e) + 1 for own in bounds for e in own], default=1)
    xs, ask = (np.concatenate([_binned(x, own) for x, own in zip(rows, bounds, strict=True)]) for rows in ([x for x, _ in trains], asks))
    y = np.concatenate([t for _, t in trains]).astype(float)
    fit, fit_ask = (np.repeat(np.arange(m), [len(r) for r in rows]) for rows in ([t for _, t in trains], asks))
    start = np.bincount(fit, y, m) / np.maximum(np.bincount(fit, minlength=m), 1)
    pure = (start <= 0) | (start >= 1) if spec.classify else np.zeros(m, bool)
    level0 = np.log(np.clip(start, 1e-6, 1 - 1e-6) / (1 - np.clip(start, 1e-6, 1 - 1e-6))) if spec.classify else start
    now, now_ask = level0[fit], level0[fit_ask]
    column = np.arange(width)[None, :] * b
    for _ in range(spec.trees):
        p = 1 / (1 + np.exp(-now)) if spec.classify else now
        g, h = y - p, p * (1 - p) if spec.classify else np.ones(len(y))
        node, node_ask = fit.copy(), fit_ask.copy()
        for level in range(spec.depth):
            size = m << level
            where = (node[:, None] * (width * b) + column + xs).ravel()
            hist = [np.bincount(where, np.repeat(v, width) if v is not None else None, size * width * b).reshape(size, width, b) for v in (g, h, None)]
            feature, at = best_splits(*hist, spec.least_leaf)
            node = node * 2 + (xs[np.arange(len(xs)), feature[node]] > at[node])
            node_ask = node_ask * 2 + (ask[np.arange(len(ask)), feature[node_ask]] > at[node_ask])
        size = m << spec.depth
        sums, weight = np.bincount(node, g, size), np.bincount(node, h, size)
        leaf = spec.rate * np.divide(sums, weight, out=np.zeros(size), where=weight > 0)
        now, now_ask = now + leaf[node], now_ask + leaf[node_ask]
    if spec.classify:
        now_ask = np.where(pure[fit_ask], start[fit_ask], 1 / (1 + np.exp(-now_ask)))
    return np.split(now_ask, np.cumsum([len(a) for a in asks])[:-1])


def refits(ready: np.ndarray, teaches: np.ndarray, min_train: int, every: int) -> list[tuple[int, list[int]]]:
    """(row at which a fit is made, rows it predicts): the first row with enough before it, then rows whose number ``every`` divides."""
    before, out = np.concatenate([[0], np.cumsum(teaches)]), []
    for i in np.flatnonzero(ready).tolist():
        if before[i] < min_train:
            continue
        if not out or i % every == 0:
            out.append((i, []))
        out[-1][1].append(i)
    return out


def _chunks(points: list[tuple[int, list[int]]]) -> Iterator[list[tuple[int, list[int]]]]:
    held, total = [], 0
    for point in points:
        if held and total + point[0] > AT_ONCE:
            yield held
            held, total = [], 0
        held.append(point)
        total += point[0]
    if held:
        yield held


def wf_trees(df: DataFrame, keys: Sequence[str], period: str, y: str, xs: Sequence[str], spec: TreeSpec, min_train: int = 50, refit_every: int = 12) -> DataFrame:
    """keys, period, n_train, ``fitted`` (the row's period at which its trees were fitted) and prediction, for every row that has one."""
    cols = [F.col(x).cast("double") for x in xs]
    read = df.select(*keys, F.col(period).cast("date").alias("__p"), F.col(y).cast("double").alias("__y"), F.array(*cols).alias("__v"))

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf[pdf["__p"].notna()]
        x = np.array([[np.nan if e is None else e for e in v] for v in pdf["__v"]], float).reshape(len(pdf), len(xs))
        t, days = pdf["__y"].to_numpy(float), pdf["__p"].to_numpy(object)
        order = np.lexsort([t, *x.T[::-1], np.array([d.toordinal() for d in days], np.int64)]) if len(pdf) else np.zeros(0, np.int64)
        x, t, days = x[order], t[order], days[order]
        ready = np.isfinite(x).all(axis=1)
        teaches = ready & np.isfinite(t)
        rows, at, n, out = [], [], [], []
        for points in _chunks(refits(ready, teaches, min_train, refit_every)):
            own = [np.flatnonzero(teaches[:i]) for i, _ in points]
            found = boosted(spec, [(x[r], t[r]) for r in own], [x[asked] for _, asked in points])
            for (i, asked), r, p in zip(points, own, found, strict=True):
                rows, at, n, out = rows + asked, at + [i] * len(asked), n + [len(r)] * len(asked), out + p.tolist()
        made = pd.DataFrame({k: pdf[k].iloc[:1].repeat(len(rows)).to_numpy() for k in keys})
        made[period], made["n_train"], made["fitted"], made["prediction"] = days[np.array(rows, int)], np.array(n, np.int64), days[np.array(at, int)], np.array(out, float)
        return made

    schema = [df.schema[k] for k in keys] + [T.StructField(period, T.DateType()), T.StructField("n_train", T.LongType()), T.StructField("fitted", T.DateType())]
    return read.groupBy(*keys).applyInPandas(fit, T.StructType([*schema, T.StructField("prediction", T.DoubleType())]))
