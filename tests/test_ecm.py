"""Error correction in full against a plain refit at every origin."""

import datetime

import numpy as np
import pytest

from tidemark.operators import ecm as E

SPECS = {
    "lags": E.EcmSpec(),
    "split": E.EcmSpec(gap="split", split_x=True),
    "all": E.EcmSpec(gap="split", by_month=True, other_lags=(("z", (0, 1)),)),
    "by_month": E.EcmSpec(by_month=True),
    "no gap": E.EcmSpec(gap="none", x_lags=()),
    "no lags": E.EcmSpec(x_lags=(), y_lags=(), gap="split"),
}


def plain(spec, y, x, months, others, first, spare):
    """The same by least squares over all rows before each origin."""
    n, out = len(y), []
    change = lambda v: np.r_[np.nan, np.diff(v)]
    lag = lambda v, k: np.array([v[i - k] if i >= k else np.nan for i in range(n)])
    for p in range(first, n):
        ok = np.isfinite(y[: p + 1]) & np.isfinite(x[: p + 1])
        if ok.sum() < 2:
            continue
        a, b = np.linalg.lstsq(np.c_[np.ones(ok.sum()), x[: p + 1][ok]], y[: p + 1][ok], rcond=None)[0]
        gap = y - a - b * x
        if spec.by_month:
            centred = np.full(n, np.nan)
            for m in range(1, 13):
                so_far = (months == m) & (np.arange(n) <= p) & np.isfinite(gap)
                if so_far.sum() >= spec.least_month:
                    centred[months == m] = gap[months == m] - gap[so_far].mean()
            gap = centred
        cols = [np.ones(n)] + [lag(change(x), k) for k in spec.x_lags if k or not spec.split_x] + [lag(change(y), k) for k in spec.y_lags]
        cols += [lag(change(others[name]), k) for name, lags in spec.other_lags for k in lags]
        cols += {"none": [], "plain": [gap], "split": [np.clip(gap, 0, None), np.clip(gap, None, 0)]}[spec.gap]
        if spec.split_x:
            cols += [np.clip(change(x), 0, None), np.clip(change(x), None, 0)]
        design, target = np.column_stack(cols), np.r_[np.diff(y), np.nan]
        rows = np.arange(spec.longest + 1, p)
        rows = rows[np.isfinite(design[rows]).all(axis=1) & np.isfinite(target[rows])]
        if len(rows) < design.shape[1] + spare or not np.isfinite(design[p]).all():
            continue
        beta = np.linalg.lstsq(design[rows], target[rows], rcond=None)[0]
        out.append((p, len(rows), a, b, gap[p], float(design[p] @ beta)))
    return out


def walk(seed, n=150, holes=False):
    r = np.random.default_rng(seed)
    x = np.cumsum(r.normal(size=n)) + 100
    y = 1.3 * x + 20 + 3 * np.sin(np.arange(n) * np.pi / 6) + 2 * r.normal(size=n)
    if holes:
        y[r.integers(0, n, 5)] = np.nan
        x[r.integers(0, n, 3)] = np.nan
    return y, x, r.normal(size=n), np.arange(n) % 12 + 1


@pytest.mark.parametrize("name", SPECS)
@pytest.mark.parametrize("holes", [False, True])
def test_sweep_equals_a_refit_at_every_origin(name, holes):
    spec = SPECS[name]
    for seed in range(4):
        y, x, z, months = walk(seed, holes=holes)
        got, expected = E.sweep(spec, y, x, months, {"z": z}, 10, 5), plain(spec, y, x, months, {"z": z}, 10, 5)
        assert [g[:2] for g in got] == [e[:2] for e in expected]
        at = (2, 3, 5) if spec.gap == "none" else (2, 3, 4, 5)
        assert np.allclose([[g[i] for i in at] for g in got], [[e[i] for i in at] for e in expected], rtol=1e-6, atol=1e-7)


def test_moves_look_at_few_rows():
    y, x, _, _ = walk(3, n=4000)
    fixed = E.fixed_regressors(E.EcmSpec(), y, x, {})
    sums = E.SignedSums(np.column_stack([np.nan_to_num(fixed), y, x, y]), y, x, np.zeros(len(y), np.int64), 1)
    for i in range(len(y)):
        sums.add(i)
        if i > 10:
            slope, offset = np.polyfit(x[: i + 1], y[: i + 1], 1)
            sums.move(np.array([offset]), slope)
    above = y - offset - slope * x > 0
    assert (sums.above == above).all()
    rows = sums.rows[above]
    assert np.allclose(sums.positive[0], rows.T @ rows, rtol=1e-6)
    assert sums.looked < len(y) ** 2 / 20


def test_walk_forward_ecm_over_many_series(spark):
    rows, expected = [], {}
    for s in range(3):
        y, x, z, _ = walk(10 + s, n=90, holes=s == 1)
        days = [datetime.date(2000 + i // 12, i % 12 + 1, 1) for i in range(90)]
        rows += [(f"s{s}", d, *(None if np.isnan(v) else float(v) for v in row)) for d, row in zip(days, zip(y, x, z, strict=True), strict=True)]
        months = np.array([d.month for d in days])
        for p, n, a, b, gap, step in plain(SPECS["all"], y, x, months, {"z": z}, SPECS["all"].longest + 31, 5):
            expected[f"s{s}", days[p]] = (n, a, b, gap, y[p] + step, days[p + 1] if p < 89 else None)
    rows += [("one", datetime.date(2000, 1, 1), 1.0, 1.0, 1.0), (None, None, 1.0, 2.0, 3.0)]
    df = spark.createDataFrame(rows, "series string, day date, y double, x double, z double").repartition(4)
    out = E.walk_forward_ecm(df.withColumn("prediction", df.y * 0), ["series"], "day", "y", "x", SPECS["all"])
    got = {(r.series, r.origin): (r.n_train, r.alpha, r.beta, r.gap, r.prediction, r.target) for r in out.collect()}
    assert got.keys() == expected.keys() and len(got) > 60
    for k, e in expected.items():
        assert got[k][0] == e[0] and got[k][5] == e[5]
        assert np.allclose(got[k][1:5], e[1:5], rtol=1e-6)
    again = E.walk_forward_ecm(spark.createDataFrame(rows, df.schema), ["series"], "day", "y", "x", SPECS["all"])
    plan = again._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("Exchange") == 1


def test_ecm_of_an_empty_table(spark):
    df = spark.createDataFrame([], "series string, day date, y double, x double")
    assert E.walk_forward_ecm(df, ["series"], "day", "y", "x", E.EcmSpec(), start="2001-01-01").count() == 0
    with pytest.raises(ValueError):
        E.EcmSpec(gap="other")
