"""Ridge with a chosen penalty and boosted trees, over many series and origins, against plain refits."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import trees as T
from tidemark.operators import walkforward as M


def months(n, start=2000):
    return [dt.date(start + i // 12, i % 12 + 1, 1) for i in range(n)]


def panel(seed, n=70, width=3):
    r = np.random.default_rng(seed)
    x = r.normal(size=(n, width)) * [1.0, 20.0, 0.1][:width] + [0, 5, -3][:width]
    y = x @ np.array([1.0, 0.05, -4.0])[:width] + r.normal(size=n)
    return x, y


def ridge_by_hand(x, y, now, alphas):
    """Scaled on all rows; every row is left out and refitted."""
    mean, sd = x.mean(axis=0), x.std(axis=0)
    sd[sd == 0] = 1
    z = (x - mean) / sd
    def fit(z, y, a):  # noqa: E306
        zc = z - z.mean(axis=0)
        beta = np.linalg.solve(zc.T @ zc + a * np.eye(z.shape[1]), zc.T @ (y - y.mean()))
        return beta, y.mean() - z.mean(axis=0) @ beta
    best = None
    for a in alphas:
        errors = []
        for i in range(len(y)):
            keep = np.arange(len(y)) != i
            beta, const = fit(z[keep], y[keep], a)
            errors.append(y[i] - const - z[i] @ beta)
        loss = np.mean(np.square(errors))
        if best is None or loss < best[0]:
            beta, const = fit(z, y, a)
            best = (loss, a, const + (now - mean) / sd @ beta)
    return best[1], best[2]


def test_ridge_cv_leaves_out_every_row_at_every_origin(spark):
    days, alphas, rows, want = months(70), [0.1, 1.0, 10.0, 100.0], [], {}
    for s in range(3):
        x, y = panel(s)
        if s == 1:
            x[10, 1], y[20] = np.nan, np.nan
        rows += [(f"s{s}", d, None if np.isnan(v) else float(v), *(None if np.isnan(e) else float(e) for e in row)) for d, v, row in zip(days, y, x, strict=True)]
        for t in range(70):
            good = np.isfinite(x[:t]).all(axis=1) & np.isfinite(y[:t])
            if good.sum() >= 24 and np.isfinite(x[t]).all():
                want[f"s{s}", days[t]] = (int(good.sum()), *ridge_by_hand(x[:t][good], y[:t][good], x[t], alphas))
    df = spark.createDataFrame(rows, "series string, day date, y double, a double, b double, c double")
    out = M.wf_ridge_cv(df, ["series"], "day", "y", ["a", "b", "c"], 24, alphas)
    got = {(r.series, r.origin): (r.n_train, r.alpha, r.prediction) for r in out.where("prediction IS NOT NULL").collect()}
    assert got.keys() == want.keys()
    for k, w in want.items():
        assert got[k][:2] == w[:2] and got[k][2] == pytest.approx(w[2], rel=1e-9)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("Exchange") == 1
    # a stated list: a row for each series that has begun, also where it has no row of that day
    asked = spark.createDataFrame([(days[40],), (days[40],), (dt.date(2003, 5, 9),), (dt.date(1999, 1, 1),), (None,)], "origin date")
    some = {(r.series, r.origin): (r.n_train, r.prediction) for r in M.wf_ridge_cv(df, ["series"], "day", "y", ["a", "b", "c"], 24, alphas, asked).collect()}
    assert len(some) == 6 and some["s0", days[40]] == (40, pytest.approx(want["s0", days[40]][2])) and some["s0", dt.date(2003, 5, 9)] == (41, None)
    assert M.wf_ridge_cv(df.where("false"), ["series"], "day", "y", ["a"], 24, alphas).count() == 0


def tree_by_hand(spec, x, y, ask):
    """One fit, a node at a time over its own rows."""
    bounds = [T.edges(x[:, k], spec.bins) for k in range(x.shape[1])]
    p0 = y.mean()
    if spec.classify and p0 in (0, 1):
        return np.full(len(ask), p0)
    start = np.log(p0 / (1 - p0)) if spec.classify else p0
    now, out = np.full(len(y), start), np.full(len(ask), start)

    def grow(rows, asked, depth, g, h):
        best = None
        if depth:
            for k, own in enumerate(bounds):
                for e in own:
                    left = x[rows, k] <= e
                    if left.sum() < spec.least_leaf or (~left).sum() < spec.least_leaf:
                        continue
                    a, b = rows[left], rows[~left]
                    gain = g[a].sum() ** 2 / h[a].sum() + g[b].sum() ** 2 / h[b].sum() - g[rows].sum() ** 2 / h[rows].sum()
                    if gain > 1e-9 and (best is None or gain > best[0] + 1e-9):
                        best = (gain, k, e)
        if best is None:
            now[rows] += spec.rate * g[rows].sum() / h[rows].sum()
            out[asked] += spec.rate * g[rows].sum() / h[rows].sum()
            return
        _, k, e = best
        for side in (True, False):
            grow(rows[(x[rows, k] <= e) == side], asked[(ask[asked, k] <= e) == side], depth - 1, g, h)

    for _ in range(spec.trees):
        p = 1 / (1 + np.exp(-now)) if spec.classify else now
        grow(np.arange(len(y)), np.arange(len(ask)), spec.depth, y - p, p * (1 - p) if spec.classify else np.ones(len(y)))
    return 1 / (1 + np.exp(-out)) if spec.classify else out


@pytest.mark.parametrize("classify", [False, True])
def test_fits_grown_together_equal_fits_grown_alone(classify):
    spec = T.TreeSpec(trees=6, depth=3, rate=0.3, least_leaf=4, bins=9, classify=classify)
    trains, asks = [], []
    for seed, n in enumerate((30, 55, 80, 12)):
        x, y = panel(seed, n)
        trains.append((np.round(x, 1), (y > y.mean() if classify else y).astype(float)))
        asks.append(np.round(panel(seed + 50, 7)[0], 1))
    for got, (x, y), ask in zip(T.boosted(spec, trains, asks), trains, asks, strict=True):
        assert np.allclose(got, tree_by_hand(spec, x, y, ask), rtol=1e-9)


@pytest.mark.parametrize("at_once", [T.AT_ONCE, 100])
def test_trees_are_refitted_every_few_rows(spark, monkeypatch, at_once):
    monkeypatch.setattr(T, "AT_ONCE", at_once)
    spec, days, rows, want = T.TreeSpec(trees=4, least_leaf=3), months(90), [], {}
    for s in range(2):
        x, y = panel(s + 5, 90)
        y[89], x[30, 0] = np.nan, np.nan
        rows += [(f"s{s}", d, None if np.isnan(v) else float(v), *(None if np.isnan(e) else float(e) for e in row)) for d, v, row in zip(days, y, x, strict=True)]
        teaches, fitted = np.isfinite(x).all(axis=1) & np.isfinite(y), None
        for i in range(90):
            if not np.isfinite(x[i]).all() or teaches[:i].sum() < 20:
                continue
            if fitted is None or i % 12 == 0:
                fitted = i
            own = np.flatnonzero(teaches[:fitted])
            want[f"s{s}", days[i]] = (len(own), days[fitted], tree_by_hand(spec, x[own], y[own], x[i : i + 1])[0])
    df = spark.createDataFrame([*rows, (None, None, 1.0, 1.0, 1.0, 1.0)], "series string, day date, y double, a double, b double, c double").repartition(3)
    got = {(r.series, r.day): (r.n_train, r.fitted, r.prediction) for r in T.wf_trees(df.withColumn("prediction", F.lit(0)), ["series"], "day", "y", ["a", "b", "c"], spec, 20).collect()}
    assert got.keys() == want.keys()
    for k, w in want.items():
        assert got[k][:2] == w[:2] and got[k][2] == pytest.approx(w[2], rel=1e-9)


def test_direction_needs_fifty_rows_and_keeps_blocks_of_one_class(spark):
    days = months(70)
    rows = [("a", d, 1, float(i)) for i, d in enumerate(days)] + [("b", d, i % 2, float(i)) for i, d in enumerate(days)]
    df = spark.createDataFrame(rows, "series string, day date, up int, x double")
    got = T.wf_trees(df, ["series"], "day", "up", ["x"], T.TreeSpec(trees=2, classify=True), refit_every=1).collect()
    assert {r.day for r in got if r.series == "b"} == set(days[50:]) and all(r.fitted == r.day and r.n_train >= 50 for r in got)
    assert {r.prediction for r in got if r.series == "a"} == {1.0} and len(got) == 40
    assert T.wf_trees(df.where("false"), ["series"], "day", "up", ["x"], T.TreeSpec()).count() == 0
