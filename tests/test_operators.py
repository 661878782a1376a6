"""Small fixtures worked out by hand or by numpy."""

import datetime as dt
import importlib.util
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.functions import scalars as S
from tidemark.operators import features, intervals, reshape, scoring, vintage, walkforward
from tidemark.plans import jobs
from tidemark.sources import tables

D = dt.date


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def test_as_of_takes_latest_known_else_earliest(spark):
    rows = [("a", D(2020, 1, 1), D(2020, 2, 1), 1.0), ("a", D(2020, 1, 1), D(2020, 3, 1), 2.0), ("a", D(2020, 2, 1), D(2020, 6, 1), 3.0), ("a", D(2020, 2, 1), D(2020, 7, 1), 4.0)]
    df = frame(spark, rows, "s string, p date, v date, x double")
    got = {r.p: r.x for r in vintage.as_of(df, "2020-02-15", ["s", "p"], "p", "v").collect()}
    assert got == {D(2020, 1, 1): 1.0, D(2020, 2, 1): 3.0}
    far = {(r.p, r.x) for r in vintage.as_of(df, "2030-01-01", ["s", "p"], "p", "v").collect()}
    assert far == {(r.p, r.x) for r in vintage.latest_vintage(df, ["s", "p"], ["v"]).collect()}


def test_upsert_null_keys_and_idempotence(spark):
    target = frame(spark, [(1, None, "a"), (2, "x", "b"), (3, "", "c")], "k int, g string, v string")
    staged = frame(spark, [(1, None, "A"), (4, "y", "d"), (3, None, "e")], "k int, g string, v string")
    once = tables.upsert(target, staged, ["k", "g"])
    assert sorted(map(str, once.collect())) == sorted(map(str, frame(spark, [(2, "x", "b"), (3, "", "c"), (1, None, "A"), (4, "y", "d"), (3, None, "e")], target.schema).collect()))
    twice = tables.upsert(once, staged, ["k", "g"])
    assert sorted(map(str, once.collect())) == sorted(map(str, twice.collect()))


def test_conform_rejects_unknown_and_null(spark):
    from pyspark.sql.types import StructType

    spec = tables.TableSpec("t", StructType.fromDDL("k bigint not null, v double"))
    with pytest.raises(ValueError):
        tables.conform(frame(spark, [(1, 2)], "k int, z int"), spec)
    with pytest.raises(Exception, match="k is null"):
        tables.conform(frame(spark, [(None, 2.0)], "k int, v double"), spec).collect()


def test_densify_lag_respects_gaps(spark):
    df = frame(spark, [("a", D(2020, 1, 1), 1.0), ("a", D(2020, 4, 1), 4.0)], "s string, p date, x double")
    s = features.Series(["s"], "p")
    rows = reshape.densify(df, ["s"], "p").withColumn("l", s.lag(F.col("x"))).orderBy("p").collect()
    assert [r.x for r in rows] == [1.0, None, None, 4.0] and rows[3].l is None


def test_asof_last_within_age(spark):
    left = frame(spark, [("a", D(2020, 1, 31)), ("a", D(2020, 2, 29)), ("b", D(2020, 1, 31))], "s string, at date")
    right = frame(spark, [("a", D(2020, 1, 28), 1.0), ("a", D(2020, 1, 31), None), ("b", D(2020, 2, 1), 5.0)], "s string, d date, x double")
    got = {(r.s, r.at): r.asof_value for r in reshape.join_asof_last(left, right, ["s"], "at", "d", "x", 6).collect()}
    assert got == {("a", D(2020, 1, 31)): 1.0, ("a", D(2020, 2, 29)): None, ("b", D(2020, 1, 31)): None}


def panel(spark, n=60, seed=0):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 2))
    y = 1 + x @ [2.0, -1.0] + 0.1 * rng.normal(size=n)
    rows = [("a", i, float(y[i]), *map(float, x[i])) for i in range(n)]
    rows[10] = ("a", 10, rows[10][2], float("nan"), rows[10][4])
    rows[20] = ("a", 20, None, *rows[20][3:])
    return frame(spark, rows, "s string, t int, y double, x1 double, x2 double"), rows


def test_wf_ols_matches_lstsq(spark):
    df, rows = panel(spark)
    got = {r.t: (r.n_train, r.prediction) for r in walkforward.wf_ols(df, ["s"], "t", "y", ["x1", "x2"], 24).collect()}
    for i, (_, _, _, a, b) in enumerate(rows):
        past = [r for r in rows[:i] if r[2] is not None and math.isfinite(r[3])]
        assert got[i][0] == len(past)
        if len(past) < 24 or not math.isfinite(a):
            assert got[i][1] is None
            continue
        beta = np.linalg.lstsq(np.array([[1, r[3], r[4]] for r in past]), np.array([r[2] for r in past]), rcond=None)[0]
        assert got[i][1] == pytest.approx(float(beta @ [1, a, b]), rel=1e-8)


def test_no_leak(spark):
    df, rows = panel(spark)
    changed = df.withColumn("y", F.when(F.col("t") >= 40, 99.0).otherwise(F.col("y"))).withColumn("x1", F.when(F.col("t") > 40, -5.0).otherwise(F.col("x1")))
    a = {r.t: r.prediction for r in walkforward.wf_ols(df, ["s"], "t", "y", ["x1", "x2"], 24).collect()}
    b = {r.t: r.prediction for r in walkforward.wf_ols(changed, ["s"], "t", "y", ["x1", "x2"], 24).collect()}
    assert all(a[t] == b[t] for t in range(41))


def test_collinear_regressor_gives_minimum_norm(spark):
    df, rows = panel(spark)
    out = walkforward.wf_ols(df.withColumn("x3", F.col("x1") * 2), ["s"], "t", "y", ["x1", "x2", "x3"], 24)
    plain = {r.t: r.prediction for r in walkforward.wf_ols(df, ["s"], "t", "y", ["x1", "x2"], 24).collect()}
    for r in out.collect():
        assert r.prediction == (None if plain[r.t] is None else pytest.approx(plain[r.t], rel=1e-6))


def test_ridge_matches_numpy(spark):
    df, rows = panel(spark)
    got = {r.t: r.prediction for r in walkforward.wf_ols(df, ["s"], "t", "y", ["x1", "x2"], 24, ridge=5.0).collect()}
    past = [r for r in rows[:50] if r[2] is not None and math.isfinite(r[3])]
    x, y = np.array([r[3:] for r in past]), np.array([r[2] for r in past])
    z = (x - x.mean(0)) / x.std(0)
    beta = np.linalg.solve(z.T @ z + 5 * np.eye(2), z.T @ (y - y.mean()))
    assert got[50] == pytest.approx(float(y.mean() + ((np.array(rows[50][3:]) - x.mean(0)) / x.std(0)) @ beta), rel=1e-8)


def test_ecm_matches_two_step(spark):
    rng = np.random.default_rng(1)
    b = np.cumsum(rng.normal(size=80)) + 20
    a = 3 + 0.5 * b + rng.normal(size=80) * 0.2
    df = frame(spark, [("s", i, float(a[i]), float(b[i])) for i in range(80)], "s string, t int, a double, b double")
    got = {r.t: r for r in walkforward.wf_ecm(df, ["s"], "t", "a", "b", 24).collect()}
    i = 70
    beta, alpha = np.polyfit(b[:i], a[:i], 1)
    gap, d = a[: i - 1] - alpha - beta * b[: i - 1], np.diff(a[:i])
    gamma, const = np.polyfit(gap, d, 1)
    assert got[i].gamma == pytest.approx(gamma, rel=1e-6)
    assert got[i].prediction == pytest.approx(const + gamma * (a[i - 1] - alpha - beta * b[i - 1]), rel=1e-6)


def test_distributions(spark):
    row = spark.range(1).select(S.student_t4_cdf(F.lit(2.1318467863)).alias("t"), S.normal_cdf(F.lit(1.959963984540054)).alias("z"), scoring.student_p_value(F.lit(2.228), F.lit(10.0)).alias("p")).first()
    assert row.t == pytest.approx(0.95, abs=1e-8) and row.z == pytest.approx(0.975, abs=1e-9) and row.p == pytest.approx(0.05, abs=1e-4)


def test_buckets_sum_to_the_ends(spark):
    df = frame(spark, [(1, 90.0, 100.0, 120.0), (2, 100.0, 100.0, 120.0)], "k int, lo double, pt double, hi double")
    fitted = scoring.split_normal_fit(df, "lo", "pt", "hi", 1.28)
    assert {r.k: r.valid for r in fitted.collect()} == {1: True, 2: False}
    out = scoring.p_bucket(scoring.p_at_least(scoring.strike_ladder(fitted.where("valid"), "pt", 10, 3), "pt", "strike", 1.0), ["k"], "strike").collect()
    assert sum(r.p_bucket for r in out) == pytest.approx(max(r.p_at_least for r in out))


def test_rounding_and_weekdays(spark):
    row = spark.range(1).select(S.round_half_even(F.lit(0.25), 1).alias("a"), S.nth_weekday(F.lit("2024-03-10").cast("date"), "FRI").alias("f"), S.reference_week_tuesday(F.lit("2024-03-01").cast("date")).alias("t"), S.parse_date(F.lit("2020M13")).alias("m"), S.parse_double(F.lit("1,234.5")).alias("x")).first()
    assert (row.a, row.f, row.t, row.m, row.x) == (0.2, D(2024, 3, 1), D(2024, 3, 12), None, 1234.5)


def test_specs_refuse_what_is_not_published(spark):
    spec = jobs.JobSpec("x", "y", "diff", (jobs.Term("a", "late", "diff", 0),), 24, {"late": 1})
    with pytest.raises(ValueError):
        spec.check()
    for s in jobs.SPECS.values():
        s.check()


def history(spark, n=3000, seed=0):
    rng = np.random.default_rng(seed)
    base = D(2020, 1, 1)
    rows = []
    for i in range(n):
        month = int(rng.integers(0, 24))
        period = D(2020 + month // 12, month % 12 + 1, 1)
        late = None if rng.random() < 0.01 else period + dt.timedelta(days=int(rng.integers(0, 120)))
        rows.append(("hot" if rng.random() < 0.5 else f"s{rng.integers(0, 5)}", period, late, float(i), int(rng.integers(0, 3)), i))
    return frame(spark, rows, "s string, p date, v date, x double, t1 int, t2 int"), rows, base


def as_of_by_hand(rows, origins, ahead=0):
    want = {}
    for o in origins:
        last = o.year * 12 + o.month - 1 + ahead
        for s, p, v, x, a, b in rows:
            months = p.year * 12 + p.month - 1
            if v is None or not (months < last or (months == last and (ahead or p <= o) and (p.day <= o.day or not ahead))):
                continue
            rank = (1, v.toordinal(), a, b) if v <= o else (0, -v.toordinal(), -a, -b)
            if (o, s, p) not in want or rank > want[o, s, p][0]:
                want[o, s, p] = (rank, x)
    return {k: x for k, (_, x) in want.items()}


@pytest.mark.parametrize("max_sent", [10_000, 0])
@pytest.mark.parametrize("ahead", [0, 3])
def test_as_of_many_against_brute_force(spark, max_sent, ahead):
    df, rows, base = history(spark)
    days = [base + dt.timedelta(days=k) for k in (0, 14, 31, 100, 101, 365, 500, 900, 4000)]
    origins = frame(spark, [(x,) for x in [*days, days[2], None]], "origin date")
    out = vintage.as_of_many(df, origins, ["s", "p"], "p", "v", ["t1", "t2"], ahead_months=ahead, max_sent=max_sent).collect()
    got = {(r.origin, r.s, r.p): r.x for r in out}
    assert len(out) == len(got) and got == as_of_by_hand(rows, days, ahead)


def test_normal_distribution_in_built_in_expressions(spark):
    zs = [x / 64 for x in range(-640, 641)] + [-37.0, -26.0, 26.0, 38.5, 0.0, -0.0, 1e-9, 0.66291, 5.65685424949238, -5.656854249492381, float("inf"), float("-inf")]
    df = frame(spark, [(z,) for z in zs] + [(None,), (float("nan"),)], "z double").select("z", S.normal_cdf(F.col("z")).alias("p"))
    assert "Python" not in plan_of(df)
    for z, p in df.collect():
        if z is None or math.isnan(z):
            assert p is None if z is None else math.isnan(p)
            continue
        want = 0.5 * math.erfc(-z / math.sqrt(2))
        assert p == pytest.approx(want, rel=1e-13, abs=1e-300), z


@pytest.mark.parametrize("heavy", [False, True])
def test_bands_lie_on_a_grid_and_cover_the_distribution(spark, heavy):
    df = frame(spark, [("a", 3.4071, 0.02), ("b", -1.0, 0.013), ("c", 1.0, 0.0), ("d", None, 1.0), ("e", 1.0, None)], "k string, pt double, sd double")
    out = scoring.band_distribution(df, "pt", "sd", 0.005, heavy=heavy).collect()
    assert {r.k for r in out} == {"a", "b"}
    for k in "ab":
        rows = sorted((r for r in out if r.k == k), key=lambda r: r.band_low)
        assert all(r.band_high == pytest.approx(s.band_low, abs=1e-9) for r, s in zip(rows, rows[1:]))
        assert all(abs(r.band_low / 0.005 - round(r.band_low / 0.005)) < 1e-6 for r in rows)
        assert rows[0].band_low <= rows[0].pt - 4 * rows[0].sd + 1e-9 and rows[-1].band_high >= rows[0].pt + 4 * rows[0].sd - 1e-9
        assert sum(r.p_band for r in rows) == pytest.approx(1, abs=0.006 if heavy else 1e-4)
        mean = sum((r.band_low + 0.0025) * r.p_band for r in rows) / sum(r.p_band for r in rows)
        assert mean == pytest.approx(rows[0].pt, abs=0.002)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["as_of_many", "known_ahead", "leaderboard_vintage_baselines"])
def test_history_is_never_broadcast(spark, small, name):
    from tidemark.catalog import QUERIES

    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        lines = plan_of(QUERIES[name](spark, small)).split("\n")
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    depth = lambda x: len(x) - len(x.lstrip(" :+-*()0123456789"))
    for i, line in enumerate(lines):
        if "BroadcastExchange" in line:
            for below in lines[i + 1 :]:
                if depth(below) <= depth(line):
                    break
                assert "lineitem" not in below


@pytest.mark.parametrize("name", ["as_of_many", "known_ahead", "leaderboard_vintage_baselines"])
def test_as_of_reads_need_no_nested_loop(spark, small, name):
    from tidemark.catalog import QUERIES

    plan = plan_of(QUERIES[name](spark, small))
    lines = [x for x in plan.split("\n") if "NestedLoop" in x or "Cartesian" in x]
    assert not lines if name != "leaderboard_vintage_baselines" else all("Cross" in x or "Inner" in x for x in lines)


def test_as_of_many_for_every_day(spark):
    df, rows, base = history(spark)
    days = [base + dt.timedelta(days=k) for k in range(-40, 700)]
    origins = frame(spark, [(x,) for x in days], "origin date")
    out = vintage.as_of_many(df, origins, ["s", "p"], "p", "v", ["t1", "t2"], ahead_months=1).collect()
    got = {(r.origin, r.s, r.p): r.x for r in out}
    assert len(out) == len(got) and got == as_of_by_hand(rows, days, 1)


def test_blocks_of_spans_meet_each_day_once(spark):
    n = 23
    depth = intervals.levels(n)
    spans = spark.range(n * n).select((F.col("id") % n).alias("a"), F.floor(F.col("id") / n).alias("b")).where("a <= b")
    blocks = spans.select("a", "b", F.explode(intervals.blocks_of_span(F.col("a"), F.col("b"), depth)).alias("k"))
    assert blocks.groupBy("a", "b").count().agg(F.max("count")).first()[0] <= 2 * depth - 2
    met = blocks.join(spark.range(n).select(F.col("id").alias("day"), F.explode(intervals.blocks_of_day(F.col("id"), depth)).alias("k")), "k")
    assert sorted((r.a, r.b, r.day) for r in met.collect()) == [(a, b, d) for a in range(n) for b in range(a, n) for d in range(a, b + 1)]


def test_asof_top_k_reaches_back_over_months(spark):
    weeks = [D(2020, 1, 4) + dt.timedelta(days=7 * k) for k in range(20) if k not in (9, 10, 11, 12, 13)]
    rows = [("a", w, float(i)) for i, w in enumerate(weeks)] + [("a", D(2020, 1, 7), None), ("b", D(2020, 5, 2), 1.0)]
    got = {(r.s, r.period): [r[f"v{i}"] for i in range(6)] for r in reshape.asof_top_k(frame(spark, rows, "s string, w date, x double"), ["s"], "w", "x", 6).collect()}
    for m in range(1, 6):
        end = D(2020, m + 1, 1)
        past = [float(i) for i, w in enumerate(weeks) if w < end][::-1][:6]
        assert got["a", D(2020, m, 1)] == (past if len(past) == 6 else [None] * 6)
    assert got["b", D(2020, 5, 1)] == [None] * 6 and len(got) == 6


def test_last_values_skip_what_is_unknown(spark):
    xs = [1.0, None, 2.0, 3.0, None, None, 4.0, 5.0]
    df = frame(spark, [("a", i, x) for i, x in enumerate(xs)] + [("b", 0, 9.0), ("b", 1, None)], "s string, t int, x double")
    got = {(r.s, r.t): r["last"] for r in features.Series(["s"], "t").last_values(df, F.col("x"), 3).collect()}
    for i in range(len(xs)):
        past = [x for x in xs[:i] if x is not None][::-1]
        assert got["a", i] == (past[:3] if len(past) >= 3 else None)
    assert got["b", 0] is None and got["b", 1] is None


def test_freshest_lag_can_be_required(spark):
    df = frame(spark, [("a", i, None if i == 3 else float(i)) for i in range(8)], "s string, t int, x double")
    s = features.Series(["s"], "t")
    got = [r.k for r in df.withColumn("k", s.freshest_lag(F.col("x"), [1, 2])).orderBy("t").collect()]
    assert got == [None, None, 1, 1, 2, None, 1, 1]
    with pytest.raises(Exception, match="no lag of"):
        df.withColumn("k", s.freshest_lag(F.col("x"), [1, 2], required=True)).collect()


def test_member_offsets_pool_what_is_left(spark):
    rows = [(m, d, 10.0 * m + d % 3) for m in (1, 2) for d in range(5)]
    truth = frame(spark, [(d, 10.0) for d in range(5)], "d int, y double")
    df = frame(spark, rows, "m int, d int, x double")
    e = {m: [x - 10 for k, _, x in rows if k == m] for m in (1, 2)}
    left = [x - np.mean(v) for v in e.values() for x in v]
    got = {r.m: r for r in features.member_offsets(df, truth, "m", "d", "x", "y").collect()}
    assert all(got[m].offset == pytest.approx(np.mean(e[m])) and got[m].residual_sd == pytest.approx(np.std(left)) for m in e)
    small = features.member_offsets(df.where("d < 2"), truth, "m", "d", "x", "y").first()
    assert small.residual_sd == 1.0  # too few to say
    flat = features.member_offsets(df.withColumn("x", F.lit(11.0)), truth, "m", "d", "x", "y").first()
    assert flat.residual_sd == 0.3


def test_shrunk_ratio_counts_only_covered_months(spark):
    rows = [("a", i, 10.0 + i, 5.0, 0.5 if i == 3 else 1.0) for i in range(6)] + [("a", 6, None, 5.0, 1.0)]
    df = frame(spark, rows, "s string, t int, y double, x double, c double")
    counts = (F.col("t") >= 1) & (F.col("c") >= 0.75)
    got = {r.t: r for r in walkforward.shrunk_ratio(df, ["s"], "y", "x", 2.0, 4.0, 0.1, 9.0, completeness="c", leave_one_out=True, counts=counts).collect()}
    for t in range(7):
        y, x = sum(r[2] for r in rows if r[1] in (1, 2, 4, 5) and r[1] != t), 5.0 * sum(k != t for k in (1, 2, 4, 5))
        k = 4.0 * (1 - rows[t][4])
        assert got[t].raw_ratio == pytest.approx(y / x) and got[t].ratio == pytest.approx((y + k * 2.0) / (x + k))


def test_platt_scaling_uses_earlier_labels_only(spark):
    rng = np.random.default_rng(2)
    rows = []
    for i in range(400):
        p = float(rng.uniform(0.05, 0.95))
        rows.append((i, D(2024, 1, 1) + dt.timedelta(days=i // 10), p, int(rng.random() < 0.5 * p)))
    df = frame(spark, rows, "i int, d date, p double, y int")
    blocks = ["2024-01-03", "2024-01-11", "2024-01-25"]
    cal = lambda x: {r.i: r.calibrated for r in walkforward.platt_scaling(x, "p", "y", "d", blocks).collect()}
    got = cal(df)
    # labels from a day on change nothing before the next block
    other = cal(df.withColumn("y", F.when(F.col("d") >= "2024-01-20", 1 - F.col("y")).otherwise(F.col("y"))))
    assert all(got[i] == other[i] for i, d, *_ in rows if d < D(2024, 1, 25)) and got != other
    # no block, or fewer than 30 rows before it: p itself, clipped
    assert all(got[i] == pytest.approx(min(max(p, 0.05), 0.95)) for i, d, p, _ in rows if d < D(2024, 1, 11))
    past = [r for r in rows if r[1] < D(2024, 1, 25)]
    a = b = 0.0
    z, y = np.log([r[2] / (1 - r[2]) for r in past]), np.array([r[3] for r in past])
    for _ in range(60):  # Newton steps of the same likelihood
        q = 1 / (1 + np.exp(-(a + b * z)))
        w = q * (1 - q)
        h = np.array([[w.sum(), (w * z).sum()], [(w * z).sum(), (w * z * z).sum()]])
        a, b = np.array([a, b]) + np.linalg.solve(h, [(y - q).sum(), ((y - q) * z).sum()])
    for i, d, p, _ in rows:
        if d >= D(2024, 1, 25):
            assert got[i] == pytest.approx(min(max(1 / (1 + math.exp(-(a + b * math.log(p / (1 - p))))), 0.05), 0.95), abs=2e-3)


def test_fit_next_solves_the_last_row_only(spark):
    df, rows = panel(spark)
    more = df.unionByName(df.withColumn("s", F.lit("b")).where("t < 50"))
    whole = {(r.s, r.t): r.prediction for r in walkforward.wf_ols(more, ["s"], "t", "y", ["x1", "x2"], 24).collect()}
    last = walkforward.fit_next(more, ["s"], "t", "y", ["x1", "x2"], 24)
    assert {(r.s, r.t): r.prediction for r in last.collect()} == {("a", 59): whole["a", 59], ("b", 49): whole["b", 49]}
    plan = plan_of(last).split("== Initial Plan ==")[-1]
    # the solve stands above the filter, and the panel (two frames here) is read once
    assert plan.index("ArrowEvalPython") < plan.index("isnull(__next") and plan.count("Scan") == 2


def test_guards_fail(spark):
    df = frame(spark, [("a", D(2024, 1, 5)), ("b", D(2024, 1, 7))], "g string, d date")
    assert scoring.freshness_guard(df, F.col("d"), "2024-01-10", 3, "g", 2).count() == 2
    with pytest.raises(ValueError, match="newest input"):
        scoring.freshness_guard(df, F.col("d"), "2024-01-11", 3)
    with pytest.raises(ValueError, match="different values"):
        scoring.freshness_guard(df, F.col("d"), "2024-01-10", 3, "g", 3)
    with pytest.raises(ValueError, match="newest input"):
        scoring.freshness_guard(df.where("false"), F.col("d"), "2024-01-10", 3)
    with pytest.raises(ValueError, match="over 1"):
        reshape.collect_snapshot(df.unionByName(df), "d", ["g"], most=1)
    with pytest.raises(ValueError, match="origins"):
        walkforward.stated(spark.range(walkforward.MAX_STATED + 1).select(F.col("id").alias("origin")))


def test_duplicate_staged_and_patch_keys(spark):
    target = frame(spark, [(1, "a", 1.0), (2, "b", 2.0), (None, "n", 3.0)], "k int, g string, v double")
    staged = frame(spark, [(1, "x", 5.0), (1, "y", 4.0), (None, "m", 7.0), (None, "l", 8.0)], "k int, g string, v double")
    assert sorted(map(tuple, tables.upsert(target, staged, ["k"]).collect()), key=str) == sorted([(1, "y", 4.0), (2, "b", 2.0), (None, "m", 7.0)], key=str)
    assert sorted(map(tuple, tables.upsert(target, staged, ["k"], ["v"]).collect()), key=str) == sorted([(1, "x", 5.0), (2, "b", 2.0), (None, "l", 8.0)], key=str)
    patched = tables.update_columns(target, staged, ["k"], ["v"], ["v"])
    assert sorted(map(tuple, patched.collect()), key=str) == sorted([(1, "a", 5.0), (2, "b", 2.0), (None, "n", 8.0)], key=str)


def test_nested_points(spark):
    doc = '{"series": [{"id": "u", "points": [{"period": "2024-01-01", "value": 1.5}, {"period": null, "value": 2}, {"period": "2024-02-01", "value": null}]}, {"id": "w", "points": []}, {"id": "z", "points": [{"period": "2024-03-01", "value": 3}]}]}'
    df = frame(spark, [(1, doc), (2, None), (3, "no json"), (4, '{"series": []}')], "k int, body string")
    meta = frame(spark, [("u", "units")], "series_id string, title string")
    want = {(1, "u", D(2024, 1, 1), 1.5, "units"), (1, "u", D(2024, 2, 1), None, "units"), (1, "z", D(2024, 3, 1), 3.0, None)}
    for most in (10, 0):
        got = tables.nested_points(df, ["k"], "body", meta, most).select("k", "series_id", "period", "value", "title").collect()
        assert {tuple(r) for r in got} == want and len(got) == 3


def job_inputs(names, n=170, seed=3):
    rng = np.random.default_rng(seed)
    months = [D(2000 + k // 12, k % 12 + 1, 1) for k in range(n)]
    return months, {x: np.exp(np.cumsum(rng.normal(size=n) * 0.03)) * 60 + 3 * np.sin(np.arange(n) * 0.52) for x in names}


def season(v):
    out = np.full(len(v), np.nan)
    for i in range(len(v)):
        past = v[i % 12 : i : 12]
        past = past[np.isfinite(past)]
        out[i] = past.mean() if len(past) else np.nan
    return out


def shift(v, k=1):
    out = np.full(len(v), np.nan)
    out[k:] = v[: len(v) - k]
    return out


def dlog(v):
    return np.log(v) - np.log(shift(v))


#: Each job's target and regressors written out.
BY_HAND = {
    "eggs_job": lambda x: (dlog(x["ap"]), [shift(dlog(x["ap"])), *[shift(dlog(x["ppi"]), k) for k in (1, 2, 3)], season(dlog(x["ap"]))]),
    "gasoline_job": lambda x: (dlog(x["cpi"]), [dlog(x["eia"]), season(dlog(x["cpi"]) - dlog(x["eia"]))]),
    "electricity_job": lambda x: (dlog(x["ap"]), [shift(dlog(x["ap"])), shift(dlog(x["ap"]), 12), season(dlog(x["ap"]))]),
    "airfares_job": lambda x: (dlog(x["ap"]), [shift(dlog(x["ap"])), shift(dlog(x["ap"]), 2), dlog(x["wti"]), shift(dlog(x["wti"])), shift(dlog(x["wti"]), 2)]),
    "ppi_job": lambda x: (dlog(x["nsa"]), [dlog(x["gas_mid"]), dlog(x["diesel_mid"]), (x["ism"] - 50) / 100, season(dlog(x["nsa"])), shift(dlog(x["sa"]))]),
    "pce_job": lambda x: (dlog(x["pce"]), [dlog(x["ccpi"]), dlog(x["air"])]),
    "retail_job": lambda x: (dlog(x["rs"]), [dlog(x["gas"]), shift(dlog(x["rs"])), shift(dlog(x["rs"]), 2)]),
    "ism_job": lambda x: (x["pmi"] - shift(x["pmi"]), [x["flash"] - shift(x["pmi"]), np.mean([x[k] for k in ("empire", "philly", "richmond", "dallas")], axis=0) - shift(x["pmi"]), shift(x["pmi"] - shift(x["pmi"]))]),
    "construction_job": lambda x: (dlog(x["starts"]), [shift(np.log(x["permits"] / x["starts"])), shift(dlog(x["starts"])), x["hmi"] - shift(x["hmi"]), x["tavg"] - season(x["tavg"]), shift(x["tavg"] - season(x["tavg"]))]),
    "permits_job": lambda x: (dlog(x["permits"]), [shift(dlog(x["single"])), shift(dlog(x["multi"]))]),
    "home_sales_job": lambda x: (dlog(x["sales"]), [dlog(x["permits"]), np.log(x["permits"]) - shift(np.log(x["sales"])), shift(dlog(x["sales"]))]),
    "sentiment_job": lambda x: (x["prelim"] - shift(x["final"]), [(x["gas_sw"] / shift(x["gas_sw"]) - 1) * 100, (x["sp_sw"] / shift(x["sp_sw"]) - 1) * 100]),
    "sentiment_final_job": lambda x: (x["final"] - x["prelim"], [(x["gas_late"] / x["gas_sw"] - 1) * 100, (x["sp_late"] / x["sp_sw"] - 1) * 100]),
}


def level_by_hand(name, x, i, p):
    spec = jobs.SPECS[name]
    t = x[spec.target]
    if spec.target_transform == "dlog":
        return t[i - 1] * math.exp(p)
    return {"ism_job": lambda: t[i - 1] + p, "sentiment_job": lambda: x["final"][i - 1] + p, "sentiment_final_job": lambda: x["prelim"][i] + p}[name]()


@pytest.mark.parametrize("name", sorted(jobs.SPECS))
def test_job_matches_numpy_at_its_own_least_training_rows(spark, name):
    spec = jobs.SPECS[name]
    assert set(BY_HAND) == set(jobs.SPECS)
    months, x = job_inputs(spec.inputs())
    rows = [(s, m, *[float(x[k][i]) for k in x]) for s in ("a", "b") for i, m in enumerate(months)]
    df = frame(spark, rows, "s string, t date, " + ", ".join(f"{k} double" for k in x))
    got = {(r.s, r.t): r for r in jobs.run_job(df, spec, ["s"], "t").collect()}
    y, xs = BY_HAND[name](x)
    design = np.column_stack([np.ones(len(y)), *xs])
    usable = np.isfinite(design).all(axis=1) & np.isfinite(y)
    first = next(i for i in range(len(y)) if usable[:i].sum() >= spec.min_train and np.isfinite(design[i]).all())
    for i in (first - 1, first, first + 7, len(y) - 1):
        r = got["b", months[i]]
        assert r.n_train == usable[:i].sum()
        if i < first:
            assert r.prediction is None
            continue
        beta = np.linalg.lstsq(design[:i][usable[:i]], y[:i][usable[:i]], rcond=None)[0]
        assert r.prediction == pytest.approx(float(design[i] @ beta), rel=1e-5, abs=1e-8)
        assert r.level == pytest.approx(level_by_hand(name, x, i, r.prediction), rel=1e-9)


def test_ridge_ensemble_by_available_members(spark):
    spec = jobs.ENSEMBLES["challenger_job"]
    months, x = job_inputs(spec.inputs(), 90)
    gaps = {"cb": range(80, 85), "ism_emp": range(83, 87)}
    x = {k: np.where([i in gaps.get(k, ()) for i in range(90)], np.nan, v) for k, v in x.items()}
    rows = [("a", m, *[None if np.isnan(x[k][i]) else float(x[k][i]) for k in x]) for i, m in enumerate(months)]
    got = [r for r in jobs.run_ensemble(frame(spark, rows, "s string, t date, " + ", ".join(f"{k} double" for k in x)), spec, ["s"], "t").orderBy("t").collect()]
    y = np.log(x["cuts"])
    base = [shift(y), *[np.array([float(m.month == k) for m in months]) for k in range(2, 13)]]
    ism = [*base, 50 - x["ism_emp"]]
    yoy = np.log(x["claims"]) - np.log(shift(x["claims"], 12))
    designs = {"ism": (np.column_stack(ism), 5.0), "allind": (np.column_stack([*ism, yoy, x["cb"], x["mich"]]), 15.0), "base": (np.column_stack(base), 1e-6)}

    def ridge(name, i):
        d, penalty = designs[name]
        ok = np.isfinite(d[:i]).all(axis=1) & np.isfinite(y[:i])
        if not np.isfinite(d[i]).all() or ok.sum() < spec.min_train:
            return None
        z, t = d[:i][ok], y[:i][ok]
        sd = np.where(z.std(0) == 0, 1, z.std(0))
        c = (z - z.mean(0)) / sd
        return float(t.mean() + ((d[i] - z.mean(0)) / sd) @ np.linalg.solve(c.T @ c + penalty * np.eye(c.shape[1]), c.T @ (t - t.mean()))), int(ok.sum())

    seen = set()
    for i in range(90):
        found = {k: ridge(k, i) for k in ("ism", "allind")}
        there = [k for k in found if found[k]]
        method = "ensemble" if len(there) == 2 else f"{there[0]}_only" if there else "fallback" if ridge("base", i) else None
        used = [found[k] for k in there] or ([ridge("base", i)] if method else [])
        assert got[i].method == method
        seen.add(method)
        if used:
            assert got[i].prediction == pytest.approx(np.mean([p for p, _ in used]), rel=1e-6) and got[i].n_train == min(n for _, n in used)
            assert got[i].level == pytest.approx(math.exp(got[i].prediction))
    assert seen == {None, "ensemble", "ism_only", "fallback"}


def test_daily_windows(spark):
    days = [D(2024, 1, 1) + dt.timedelta(days=k) for k in range(120) if not 38 <= k <= 46]
    rows = [("a", d, float(i)) for i, d in enumerate(days)]
    got = {r.period: r for r in jobs.daily_windows(frame(spark, rows, "s string, d date, x double"), ["s"], "d", "x", "g").collect()}
    value = dict((d, x) for _, d, x in rows)
    for m, at in ((1, D(2024, 1, 9)), (2, D(2024, 2, 13)), (3, D(2024, 3, 12)), (4, D(2024, 4, 9))):
        near = [d for d in days if at - dt.timedelta(days=6) <= d <= at]
        assert got[D(2024, m, 1)].g_mid == (value[near[-1]] if near else None)
        before = D(2024, m, 1) - dt.timedelta(days=1)
        own = [x for d, x in value.items() if (d.year, d.month) == (2024, m) and d.day <= 7 or (d.year, d.month) == (before.year, before.month) and d.day >= 25]
        late = [x for d, x in value.items() if (d.year, d.month) == (2024, m) and 8 <= d.day <= 21]
        assert got[D(2024, m, 1)].g_sw == pytest.approx(np.mean(own)) and got[D(2024, m, 1)].g_late == pytest.approx(np.mean(late))


def test_stream_upsert_rewrites_touched_parts_only(spark, tmp_path):
    from tidemark.streaming import streams

    schema = "k int, g string, t int, v double"
    source, base, checkpoint = (f"file://{tmp_path}/{n}" for n in ("in", "out", "checkpoint"))
    want, written = {}, []
    for number, rows in enumerate(([(i, "x", 0, float(i)) for i in range(40)] + [(None, "n", 0, 1.0)], [(3, "x", 1, -3.0), (3, "x", 2, -4.0)], [(3, "x", 3, 9.0), (None, "n", 1, 2.0)], [])):
        frame(spark, rows, schema).coalesce(1).write.mode("append").parquet(source)
        streams.stream_upsert(spark.readStream.schema(schema).parquet(source), base, checkpoint, ["k", "g"], ["t"], parts=8).awaitTermination()
        for k, g, t, v in sorted(rows, key=lambda r: r[2]):
            want[k, g] = (t, v)
        got = streams.current_snapshot(spark, base).collect()
        assert {(r.k, r.g): (r.t, r.v) for r in got} == want and len(got) == len(want)
        written.append(streams._versions(spark, base))
    assert sum(len(v) for v in written[0].values()) == len(written[0]) == 8
    assert max(len(v) for v in written[2].values()) == 2  # of the part written three times two versions are left
    assert sum(v[0] > 0 for v in written[2].values()) <= 2 and written[2] == written[3]


def test_entry_without_training_data_operators(monkeypatch, spark, small):
    import __spark_entry__ as entry

    real = importlib.util.find_spec
    monkeypatch.setattr(importlib.util, "find_spec", lambda n, *a: None if n.startswith("tidemark.llm") or n == "corpus_pipeline" else real(n, *a))
    found = entry.queries()
    assert found and not any(n.startswith("op") and n[2].isdigit() for n in found)
    assert set(entry.oracle_sql()) <= set(found)
    assert entry.entry(spark).count() > 0


def test_queries_are_listed_without_a_session():
    import subprocess
    import sys
    from pathlib import Path

    code = "import __spark_entry__ as e; assert e.queries() and set(e.oracle_sql()) <= set(e.queries())"
    subprocess.run([sys.executable, "-c", code], cwd=Path(__file__).resolve().parent.parent, check=True, timeout=120)
