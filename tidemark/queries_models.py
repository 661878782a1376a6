"""Queries of baselines, walk-forward fits, scores, distributions, streams and prebuilt jobs."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import ecm as E
from tidemark.operators import reshape as R
from tidemark.operators import scoring as C
from tidemark.operators import trees
from tidemark.operators import vintage as V
from tidemark.operators import walkforward as M
from tidemark.operators.features import Series
from tidemark.plans import jobs
from tidemark.plans.fixtures import BT_SQL, MP_SQL, SG_SQL, TIE, bitemporal, monthly_panel, segment_days, segment_panel, table, vintages
from tidemark.queries import _origins_sql as origins_sql
from tidemark.queries import origins_table, query, scratch_path
from tidemark.sources.versioned import VersionedTable
from tidemark.streaming import first_print, streams

_W = "(PARTITION BY series ORDER BY period"
_B = f"OVER {_W} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
BL_SQL = MP_SQL + f""", bl AS (SELECT series, period, value, last_value(value IGNORE NULLS) {_B} AS rw, coalesce(lag(value, 12) OVER {_W}), last_value(value IGNORE NULLS) {_B}) AS seasonal,
  avg(value) OVER {_W} ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING) AS mean3, avg(value) {_B} AS long_run, 0.0::DOUBLE AS zero,
  CASE WHEN count(value) {_B} >= 2 THEN last_value(value IGNORE NULLS) {_B} + (last_value(value IGNORE NULLS) {_B} - first_value(value IGNORE NULLS) {_B}) / (count(value) {_B} - 1) END AS drift FROM mp)"""
METHODS = ["rw", "seasonal", "mean3", "long_run", "zero", "drift"]
ER_SQL = BL_SQL + ", er AS (SELECT series, period, value, method, prediction, prediction - value AS error FROM (" + " UNION ALL ".join(f"SELECT series, period, value, '{m}' AS method, {m} AS prediction FROM bl" for m in METHODS) + ") WHERE prediction IS NOT NULL AND value IS NOT NULL)"


def based(spark, d):
    return M.baselines(monthly_panel(spark, d).select("series", "period", "value"), ["series"], "period", "value")


def errors(spark, d):
    return C.error_rows(based(spark, d), METHODS, "value", ["series", "period"])


def rounded(df, keep, digits=6):
    return df.select(*keep, *[F.round(c, digits).alias(c) for c in df.columns if c not in keep])


@query("baselines", f"WITH {BL_SQL} SELECT series, period, " + ", ".join(f"round({m}, 9) AS {m}" for m in METHODS) + " FROM bl")
def baselines(spark, d):
    return rounded(based(spark, d).drop("value"), ["series", "period"], 9)


@query("score_basic", f"WITH {ER_SQL} SELECT method, count(*) AS n, round(avg(abs(error)), 6) AS mae, round(sqrt(avg(error * error)), 6) AS rmse, round(avg(error), 6) AS bias, round(max(abs(error)), 6) AS worst FROM er GROUP BY method")
def score_basic(spark, d):
    return rounded(C.score_basic(errors(spark, d), ["method"]), ["method", "n"])


@query("score_tolerance", f"WITH {ER_SQL} SELECT method, round(avg(CASE WHEN abs(error) <= 0.5 + 1e-9 THEN 1.0 ELSE 0.0 END) * 100, 6)::DOUBLE AS within_half, round(avg(CASE WHEN abs(error) <= 2 + 1e-9 THEN 1.0 ELSE 0.0 END) * 100, 6)::DOUBLE AS within_two, round(median(abs(error)), 6) AS medae FROM er GROUP BY method")
def score_tolerance(spark, d):
    return rounded(C.score_tolerance(errors(spark, d), ["method"], {"within_half": 0.5, "within_two": 2.0}), ["method"])


@query("score_exact_rounded", f"""WITH {BL_SQL}, x AS (SELECT series, round_even(mean3, 0) AS p, round_even(value, 0) AS a, round_even(rw, 0) AS b FROM bl)
  SELECT series, round(avg(CASE WHEN p = a THEN 1.0 WHEN p <> a THEN 0.0 END), 6)::DOUBLE AS exact, round(avg(CASE WHEN a <> b THEN CASE WHEN sign(p - b) = sign(a - b) THEN 1.0 ELSE 0.0 END END), 6)::DOUBLE AS direction, count(CASE WHEN a <> b AND p IS NOT NULL THEN 1 END) AS n_moved FROM x GROUP BY series""")
def score_exact_rounded(spark, d):
    return rounded(C.score_exact_rounded(based(spark, d), ["series"], "mean3", "value", "rw", 0), ["series", "n_moved"])


@query("score_direction", f"WITH {BL_SQL} SELECT series, round(avg(CASE WHEN sign(mean3 - rw) = sign(value - rw) THEN 1.0 WHEN sign(mean3 - rw) <> sign(value - rw) THEN 0.0 END), 6)::DOUBLE AS hit_rate, count(sign(mean3 - rw) = sign(value - rw)) AS n FROM bl GROUP BY series")
def score_direction(spark, d):
    return rounded(C.score_direction(based(spark, d), ["series"], "mean3", "value", "rw"), ["series", "n"])


@query("score_level", f"WITH {BL_SQL}, x AS (SELECT series, rw * exp(0.01) - value AS error FROM bl) SELECT series, count(error) AS n, round(avg(abs(error)), 6) AS mae, round(sqrt(avg(error * error)), 6) AS rmse, round(avg(error), 6) AS bias, round(max(abs(error)), 6) AS worst FROM x GROUP BY series")
def score_level(spark, d):
    return rounded(C.score_level(based(spark, d).withColumn("g", F.lit(0.01)), ["series"], "g", "rw", "value"), ["series", "n"])


@query("score_mape", f"WITH {ER_SQL} SELECT method, round(avg(abs(error / value)) * 100, 6) AS mape FROM er GROUP BY method")
def score_mape(spark, d):
    return rounded(C.score_mape(errors(spark, d), ["method"], "value"), ["method"])


_LB = """, w AS (SELECT method, 'all' AS "window", count(*) AS n, avg(abs(error)) AS mae, sqrt(avg(error * error)) AS rmse FROM er GROUP BY method
  UNION ALL SELECT method, 'late', count(*), avg(abs(error)), sqrt(avg(error * error)) FROM er WHERE period >= DATE '1998-01-01' GROUP BY method)
  SELECT a."window", a.method, a.n, round(a.mae, 6) AS mae, round(a.rmse, 6) AS rmse, round((1 - a.rmse / b.rmse) * 100, 6) AS skill_pct FROM w a LEFT JOIN w b ON a."window" = b."window" AND b.method = 'rw'"""


@query("leaderboard", f"WITH {ER_SQL}{_LB}")
def leaderboard(spark, d):
    windows = {"all": F.lit(True), "late": F.col("period") >= F.lit("1998-01-01").cast("date")}
    return rounded(C.leaderboard(errors(spark, d), windows, "rw"), ["window", "method", "n"])


_VLB = ", ".join(f"CASE WHEN vintage <= origin THEN {c} ELSE -{c} END DESC" for c in TIE)


@query(
    "leaderboard_vintage_baselines",
    f"""WITH {BT_SQL}, {origins_sql()}, seen AS (SELECT origin, series, period, value / 1009 AS value FROM bt JOIN origins ON period <= origin
    QUALIFY row_number() OVER (PARTITION BY origin, series, period ORDER BY vintage <= origin DESC,
      CASE WHEN vintage <= origin THEN date_diff('day', DATE '1970-01-01', vintage) ELSE -date_diff('day', DATE '1970-01-01', vintage) END DESC, {_VLB}) = 1),
  grid AS (SELECT origin, series, CAST(unnest(generate_series(min(period), max(period), INTERVAL 1 MONTH)) AS DATE) AS period FROM seen GROUP BY origin, series),
  dense AS (SELECT grid.*, seen.value FROM grid LEFT JOIN seen ON grid.origin = seen.origin AND grid.series = seen.series AND grid.period = seen.period),
  p AS (SELECT origin, series, period, value, lag(value) OVER w AS rw, coalesce(lag(value, 12) OVER w, lag(value) OVER w) AS seasonal, CASE WHEN count(value) OVER (w ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING) >= 2
    THEN avg(value) OVER (w ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING) END AS mean3 FROM dense WINDOW w AS (PARTITION BY origin, series ORDER BY period)),
  e AS (SELECT origin, 'rw' AS method, rw - value AS error FROM p UNION ALL SELECT origin, 'seasonal', seasonal - value FROM p UNION ALL SELECT origin, 'mean3', mean3 - value FROM p)
  SELECT origin, method, count(error) AS n, round(avg(abs(error)), 6) AS mae, round(sqrt(avg(error * error)), 6) AS rmse, round(avg(error), 6) AS bias, round(max(abs(error)), 6) AS worst FROM e GROUP BY origin, method""",
)
def leaderboard_vintage_baselines(spark, d):
    """As known at each origin, on a dense calendar: naive forecasts scored per origin and method."""
    seen = V.as_of_many(bitemporal(spark, d), origins_table(spark), ["series", "period"], "period", "vintage", TIE)
    seen = seen.select("origin", "series", "period", (F.col("value") / 1009).alias("value"))
    dense = R.densify(seen, ["origin", "series"], "period")
    s = Series(["origin", "series"], "period")
    v = F.col("value")
    rows = dense.withColumns({"rw": s.lag(v), "seasonal": F.coalesce(s.lag(v, 12), s.lag(v)), "mean3": s.rolling_mean(v, 3, 2)})
    return rounded(C.score_basic(C.error_rows(rows, ["rw", "seasonal", "mean3"], "value", ["origin"]), ["origin", "method"]), ["origin", "method", "n"], 6)


@query("common_origins", f"WITH {ER_SQL} SELECT series, period, method, round(error, 9) AS error FROM er WHERE (series, period) IN (SELECT (series, period) FROM er GROUP BY series, period HAVING count(DISTINCT method) = 6)")
def common_origins(spark, d):
    return rounded(R.intersect_origins(errors(spark, d), ["series", "period"], "method", 6).select("series", "period", "method", "error"), ["series", "period", "method"], 9)


MH_SQL = MP_SQL + f""", {origins_sql(["1998-01-01", "1998-07-01", "1999-01-01", "2000-01-01"])}, g AS (SELECT s.series, origin, h AS horizon, CAST(origin + h * INTERVAL 1 MONTH AS DATE) AS target FROM (SELECT DISTINCT series FROM mp) s, origins, (SELECT CAST(range AS INTEGER) AS h FROM range(1, 14))),
  mh AS (SELECT g.series, g.origin, g.horizon, g.target, a.value AS rw, b.value AS seasonal FROM g LEFT JOIN mp a ON a.series = g.series AND a.period = g.origin LEFT JOIN mp b ON b.series = g.series AND b.period = g.target - INTERVAL 12 MONTH)"""


def horizons(spark, d):
    origins = origins_table(spark, ["1998-01-01", "1998-07-01", "1999-01-01", "2000-01-01"])
    return M.multi_horizon_naive(monthly_panel(spark, d), origins, ["series"], "period", "value", 13)


@query("multi_horizon_naive", f"WITH {MH_SQL} SELECT series, origin, horizon, target, rw, seasonal FROM mh")
def multi_horizon_naive(spark, d):
    return horizons(spark, d).select("series", "origin", "horizon", "target", "rw", "seasonal")


@query("score_by_horizon", f"""WITH {MH_SQL}, e AS (SELECT mh.series, horizon, rw - value AS error FROM mh JOIN mp ON mp.series = mh.series AND mp.period = mh.target),
  h AS (SELECT series, horizon, avg(abs(error)) AS mae, sqrt(avg(error * error)) AS rmse FROM e GROUP BY ALL) SELECT series, round(avg(mae), 6) AS mae, round(avg(rmse), 6) AS rmse, count(*) AS horizons FROM h GROUP BY series""")
def score_by_horizon(spark, d):
    actual = monthly_panel(spark, d).select("series", F.col("period").alias("target"), "value")
    rows = horizons(spark, d).join(actual, ["series", "target"]).withColumn("error", F.col("rw") - F.col("value"))
    return rounded(C.score_by_horizon(rows, ["series"], "horizon"), ["series", "horizons"])


DM_SQL = BL_SQL + ", dm AS (SELECT series, pow(rw - value, 2) - pow(mean3 - value, 2) AS d FROM bl)"


def dm(spark, d):
    rows = based(spark, d).select("series", (F.col("rw") - F.col("value")).alias("a"), (F.col("mean3") - F.col("value")).alias("b"))
    return C.dm_test(rows, ["series"], "a", "b")


@query("dm_test", f"WITH {DM_SQL} SELECT series, count(d) AS n, round(avg(d), 6) AS mean_d, round(avg(d) / sqrt(var_samp(d) / count(d)), 6) AS dm FROM dm GROUP BY series")
def dm_test(spark, d):
    return rounded(dm(spark, d), ["series", "n"])


@query("dm_test_p_value")
def dm_test_p_value(spark, d):
    return dm(spark, d).withColumn("p_value", C.student_p_value("dm", (F.col("n") - 1).cast("double")))


BR_SQL = "br AS (SELECT user_id % 5 AS series, least(greatest(value / 60, 0.01), 0.99) AS p, CASE WHEN event_id % 3 = 0 THEN 1 ELSE 0 END AS y FROM events)"


def outcomes(spark, d):
    p = F.least(F.greatest(F.col("value") / 60, F.lit(0.01)), F.lit(0.99))
    return table(spark, d, "events").select((F.col("user_id") % 5).alias("series"), p.alias("p"), F.when(F.col("event_id") % 3 == 0, 1).otherwise(0).alias("y"), F.to_date("ts").alias("day"))


@query("brier", f"WITH {BR_SQL} SELECT series, round(avg(y), 6) AS rate, round(avg(pow(p - y, 2)), 6) AS brier, count(*) AS n, round(1 - avg(pow(p - y, 2)) / (avg(y) * (1 - avg(y))), 6) AS skill FROM br GROUP BY series")
def brier(spark, d):
    return rounded(C.brier(outcomes(spark, d), ["series"], "p", "y"), ["series", "n"])


@query("reliability", f"WITH {BR_SQL} SELECT CAST(least(floor(p * 10), 9) AS BIGINT) AS bin, count(*) AS n, round(avg(p), 6) AS mean_p, round(avg(y), 6) AS rate FROM br GROUP BY 1")
def reliability(spark, d):
    return rounded(C.reliability(outcomes(spark, d), "p", "y"), ["bin", "n"])


@query("live_errors", """WITH f AS (SELECT o_orderpriority AS target, CAST(o_orderdate AS DATE) AS day, arg_max(o_totalprice, o_orderkey) AS forecast FROM orders WHERE o_orderdate <= TIMESTAMP '1999-01-01' GROUP BY ALL),
  a AS (SELECT o_orderpriority AS target, CAST(o_orderdate AS DATE) AS day, max(o_totalprice) AS actual FROM orders GROUP BY ALL) SELECT f.target, f.day, forecast - actual AS error FROM f JOIN a ON f.target = a.target AND f.day = a.day""")
def live_errors(spark, d):
    o = table(spark, d, "orders").select(F.col("o_orderpriority").alias("target"), F.to_date("o_orderdate").alias("day"), "o_orderdate", "o_orderkey", "o_totalprice")
    actuals = o.groupBy("target", "day").agg(F.max("o_totalprice").alias("actual"))
    return C.live_errors(o, actuals, ["target", "day"], F.col("o_orderdate"), "1999-01-01 00:00:00", "o_totalprice", "o_orderkey", "actual")


@query("rmse_sigma", f"WITH {ER_SQL} SELECT method, series, count(error) AS n, round(CASE WHEN count(error) >= 70 THEN sqrt(avg(error * error)) ELSE stddev_samp(error) / sqrt(5) END, 6) AS sigma FROM er GROUP BY ALL")
def rmse_sigma(spark, d):
    return rounded(C.rmse_sigma(errors(spark, d), ["method", "series"], "error", 70, F.stddev_samp("error") / F.sqrt(F.lit(5.0))), ["method", "series", "n"])


def intervals(spark, d):
    rows = table(spark, d, "customer").select("c_custkey", (F.col("c_acctbal") + 10000).alias("point"), (F.col("c_custkey") % 7 * 100.0).alias("w"))
    return C.split_normal_fit(rows.withColumn("low", F.col("point") - F.col("w")).withColumn("high", F.col("point") + 2 * F.col("w")), "low", "point", "high", 1.25)


@query("split_normal_fit", "SELECT c_custkey, CASE WHEN ok THEN (point - low) / 1.25 END AS sigma_lo, CASE WHEN ok THEN (high - point) / 1.25 END AS sigma_hi, ok AS valid FROM (SELECT *, low < point AND point < high AS ok FROM (SELECT c_custkey, c_acctbal + 10000 AS point, (c_acctbal + 10000) - c_custkey % 7 * 100.0::DOUBLE AS low, (c_acctbal + 10000) + 2 * (c_custkey % 7 * 100.0::DOUBLE) AS high FROM customer))")
def split_normal_fit(spark, d):
    return intervals(spark, d).select("c_custkey", "sigma_lo", "sigma_hi", "valid")


@query("strike_ladder", "SELECT c_custkey, CAST(floor((c_acctbal + 10000) / 500) AS BIGINT) * 500 + k * 500 AS strike FROM customer, (SELECT range AS k FROM range(-3, 4))")
def strike_ladder(spark, d):
    return C.strike_ladder(intervals(spark, d), "point", 500, 3).select("c_custkey", "strike")


def _normal_sql(z: str) -> str:
    """The distribution function by its series z + z^3 / 3 + z^5 / (3 * 5) + ...: another formula than the library's."""
    x = f"greatest(least(abs({z}), 9.0::DOUBLE), 1e-300::DOUBLE)"
    terms = f"list_sum(list_transform(range(0, 200), lambda k: exp((2 * k + 1) * ln({x}) - (k + 1) * ln(2::DOUBLE) - lgamma(k + 1.5::DOUBLE) + 0.5 * ln(pi()) - {x} * {x} / 2)))"
    return f"(0.5 + CASE WHEN {z} < 0 THEN -1 ELSE 1 END * {terms} / sqrt(2 * pi()))"


_LADDER_SQL = f"""WITH iv AS (SELECT c_custkey, c_acctbal + 10000 AS point, c_custkey % 7 * 100.0::DOUBLE AS w FROM customer WHERE c_custkey % 7 > 0),
  l AS (SELECT c_custkey, point, CAST(floor(point / 500) AS BIGINT) * 500 + k * 500 AS strike, w / 1.25 AS lo, 2 * w / 1.25 AS hi FROM iv, (SELECT range AS k FROM range(-3, 4))),
  z AS (SELECT c_custkey, strike, (strike - 0.5 - point) / CASE WHEN strike - 0.5 < point THEN lo ELSE hi END AS z FROM l),
  p AS (SELECT c_custkey, strike, 1 - {_normal_sql("z")} AS p FROM z)
  SELECT c_custkey, strike, round(p, 9) + 0.0 AS p_at_least, round(p - coalesce(lead(p) OVER (PARTITION BY c_custkey ORDER BY strike), 0), 9) + 0.0 AS p_bucket FROM p"""


@query("p_at_least_bucket", _LADDER_SQL)
def p_at_least_bucket(spark, d):
    rows = C.strike_ladder(intervals(spark, d).where("valid"), "point", 500, 3)
    out = C.p_bucket(C.p_at_least(rows, "point", "strike", 1.0), ["c_custkey"], "strike")
    return out.select("c_custkey", "strike", (F.round("p_at_least", 9) + 0.0).alias("p_at_least"), (F.round("p_bucket", 9) + 0.0).alias("p_bucket"))


_T4 = "0.5 + 0.375 * ({t} / sqrt(1 + {t} * {t} / 4)) * (1 - {t} * {t} / (12 * (1 + {t} * {t} / 4)))"


def _bands_sql(cdf: str, scale: str) -> str:
    edges = "floor((c_acctbal - 4 * 80.0::DOUBLE) / 50), ceil((c_acctbal + 4 * 80.0::DOUBLE) / 50)"
    return f"""WITH b AS (SELECT c_custkey, c_acctbal AS point, unnest(range(CAST({edges.split(", ")[0]} AS BIGINT), CAST({edges.split(", ")[1]} AS BIGINT))) AS k FROM customer),
  x AS (SELECT c_custkey, k * 50.0::DOUBLE AS band_low, k * 50.0::DOUBLE + 50 AS band_high, (k * 50 - point) / {scale} AS lo, (k * 50 + 50 - point) / {scale} AS hi FROM b)
  SELECT c_custkey, band_low, band_high, round(({cdf.format(t="hi")}) - ({cdf.format(t="lo")}), 9) AS p_band FROM x"""


def _bands(spark, d, **how):
    rows = table(spark, d, "customer").select("c_custkey", "c_acctbal", F.lit(80.0).alias("sigma"))
    return C.band_distribution(rows, "c_acctbal", "sigma", 50.0, **how).select("c_custkey", "band_low", "band_high", F.round("p_band", 9).alias("p_band"))


@query("band_distribution", _bands_sql(_T4, "(80 / sqrt(2::DOUBLE))"))
def band_distribution(spark, d):
    return _bands(spark, d, heavy=True)


@query("band_distribution_normal", _bands_sql(_normal_sql("{t}"), "80.0::DOUBLE"))
def band_distribution_normal(spark, d):
    return _bands(spark, d)


@query("freshness_guard", "SELECT max(CAST(o_orderdate AS DATE)) AS newest, date_diff('day', max(CAST(o_orderdate AS DATE)), DATE '2001-12-31') <= 400 AS fresh, count(DISTINCT o_orderpriority) = 5 AS complete FROM orders")
def freshness_guard(spark, d):
    """What the guard looks at; the guard itself raises."""
    rows = table(spark, d, "orders")
    day = F.to_date("o_orderdate")
    C.freshness_guard(rows, day, "2001-12-31", 400, "o_orderpriority", 5)
    return C.freshness(rows, day, "2001-12-31", 400, "o_orderpriority", 5)


@query("window_gate", "SELECT DISTINCT CAST(o_orderdate AS DATE) AS day FROM orders WHERE CAST(o_orderdate AS DATE) < CAST(date_trunc('month', o_orderdate) AS DATE) + CAST((12 - dayofweek(date_trunc('month', o_orderdate))) % 7 AS INTEGER)")
def window_gate(spark, d):
    """Days before their month's first Friday."""
    from tidemark.functions.scalars import nth_weekday

    days = table(spark, d, "orders").select(F.to_date("o_orderdate").alias("day")).distinct()
    return C.before_release(days, F.col("day"), nth_weekday(F.col("day"), "FRI"))


@query("missing_features_report", f"WITH {BL_SQL} SELECT series, period, concat_ws(',', CASE WHEN rw IS NULL THEN 'rw' END, CASE WHEN mean3 IS NULL THEN 'mean3' END, CASE WHEN drift IS NULL THEN 'drift' END) AS missing FROM bl")
def missing_features_report(spark, d):
    from tidemark.functions.scalars import missing_names

    rows = based(spark, d)
    return rows.select("series", "period", F.array_join(missing_names(rows, ["rw", "mean3", "drift"]), ",").alias("missing"))


@query("seasonal_drift", f"""WITH {SG_SQL}, l AS (SELECT series, period, a, CASE WHEN a > 0 THEN ln(CASE WHEN a > 0 THEN a END) END AS v FROM sg),
  s AS (SELECT series, period, lag(v) OVER {_W}) AS last, v - lag(v) OVER {_W}) AS step, period BETWEEN DATE '1998-03-01' AND DATE '1998-08-01' AS masked FROM l)
  SELECT series, period, round(exp(last + avg(CASE WHEN NOT masked THEN step END) OVER (PARTITION BY series, month(period) ORDER BY period ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)), 6) AS seasonal_drift FROM s""")
def seasonal_drift(spark, d):
    """Half a year is masked: it teaches no seasonal step."""
    masked = F.col("period").between(F.lit("1998-03-01").cast("date"), F.lit("1998-08-01").cast("date"))
    rows = M.seasonal_drift(segment_panel(spark, d), ["series"], "period", "a", masked)
    return rows.select("series", "period", F.round("seasonal_drift", 6).alias("seasonal_drift"))


# --- fits


def regressors(spark, d):
    s, v, n = Series(["series"], "period"), F.col("value"), F.col("n")
    return monthly_panel(spark, d).select("series", "period", "value", s.lag(v).alias("x1"), s.lag(v, 2).alias("x2"), s.lag(n).cast("double").alias("x3"))


@query("wf_ols_one", f"WITH {MP_SQL}, x AS (SELECT series, period, value, lag(value) OVER {_W}) AS x1 FROM mp) SELECT series, period, count(x1) {_B} AS n_train, round(CASE WHEN count(x1) {_B} >= 24 THEN regr_intercept(value, x1) {_B} + regr_slope(value, x1) {_B} * x1 END, 5) AS prediction FROM x")
def wf_ols_one(spark, d):
    out = M.wf_ols_simple(regressors(spark, d), ["series"], "period", "value", "x1", 24)
    return out.select("series", "period", "n_train", F.round("prediction", 5).alias("prediction"))


@query("wf_ols")
def wf_ols(spark, d):
    return M.wf_ols(regressors(spark, d), ["series"], "period", "value", ["x1", "x2", "x3"], 24).select("series", "period", "n_train", "prediction")


@query("wf_ols_no_intercept", f"WITH {MP_SQL}, x AS (SELECT series, period, value, lag(value) OVER {_W}) AS x1 FROM mp) SELECT series, period, count(x1) {_B} AS n_train, round(CASE WHEN count(x1) {_B} >= 24 THEN sum(value * x1) {_B} / sum(x1 * x1) {_B} * x1 END, 6) AS prediction FROM x")
def wf_ols_no_intercept(spark, d):
    out = M.wf_ols(regressors(spark, d), ["series"], "period", "value", ["x1"], 24, intercept=False)
    return out.select("series", "period", "n_train", F.round("prediction", 6).alias("prediction"))


@query("fit_next")
def fit_next(spark, d):
    return M.fit_next(regressors(spark, d), ["series"], "period", "value", ["x1", "x2"], 24).select("series", "period", "n_train", "prediction")


@query("wf_ridge_fixed")
def wf_ridge_fixed(spark, d):
    return M.wf_ols(regressors(spark, d), ["series"], "period", "value", ["x1", "x2", "x3"], 24, ridge=5.0).select("series", "period", "n_train", "prediction")


@query("wf_ridge_cv")
def wf_ridge_cv(spark, d):
    origins = origins_table(spark, [f"{y}-{m:02d}-01" for y in (1999, 2000) for m in (1, 4, 7, 10)])
    return M.wf_ridge_cv(regressors(spark, d), ["series"], "period", "value", ["x1", "x2", "x3"], 24, [0.1, 1.0, 10.0, 100.0], origins)


# error correction by running sums in SQL: the gap is taken with the coefficients of each origin
_ECM_SQL = f"""WITH {SG_SQL}, x AS (SELECT *, lag(a) OVER w AS a1, lag(b) OVER w AS b1, a - lag(a) OVER w AS dy FROM sg WINDOW w AS (PARTITION BY series ORDER BY period)),
  c AS (SELECT series, period, a1, b1, dy, regr_intercept(a, b) OVER w AS alpha, regr_slope(a, b) OVER w AS beta FROM x WINDOW w AS (PARTITION BY series ORDER BY period ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
  f AS (SELECT o.series, o.period, o.a1 - o.alpha - o.beta * o.b1 AS gap, count(h.dy) AS n, regr_slope(h.dy, h.a1 - o.alpha - o.beta * h.b1) AS gamma, regr_intercept(h.dy, h.a1 - o.alpha - o.beta * h.b1) AS const
    FROM c o LEFT JOIN c h ON h.series = o.series AND h.period < o.period AND h.dy IS NOT NULL AND h.b1 IS NOT NULL GROUP BY ALL)"""


@query("wf_ecm", _ECM_SQL + " SELECT series, period, n AS n_train, CASE WHEN n >= 24 THEN round(gamma, 5) END AS gamma, CASE WHEN n >= 24 THEN round(gap, 6) END AS gap, CASE WHEN n >= 24 THEN round(const + gamma * gap, 5) END AS prediction FROM f")
def wf_ecm(spark, d):
    rows = M.wf_ecm(segment_panel(spark, d), ["series"], "period", "a", "b", 24)
    enough = F.col("n_train") >= 24
    return rows.select("series", "period", "n_train", *[F.when(enough, F.round(c, n)).alias(c) for c, n in (("gamma", 5), ("gap", 6), ("prediction", 5))])


@query("ecm_next_step", _ECM_SQL + " SELECT series, period, CASE WHEN n >= 24 THEN round(gamma * gap / 30, 6) END AS daily_step FROM f")
def ecm_next_step(spark, d):
    rows = M.ecm_next_step(M.wf_ecm(segment_panel(spark, d), ["series"], "period", "a", "b", 24), "gamma", "gap", 30)
    return rows.select("series", "period", F.when(F.col("n_train") >= 24, F.round("daily_step", 6)).alias("daily_step"))


def _ecm_full_sql(by_month: bool) -> str:
    """Every origin meets all rows before it: the gap split by sign, or centred on its month; no lags, so that two regressors are the most."""
    gap = "r - alpha - beta * x"
    centred = f"""k AS (SELECT o.series, o.s AS p, month(h.period) AS m, avg(h.r - o.alpha - o.beta * h.x) AS mu FROM c o JOIN c h ON h.series = o.series AND h.s <= o.s
    WHERE h.r IS NOT NULL AND h.x IS NOT NULL GROUP BY ALL HAVING count(*) >= 3),
  e AS (SELECT c.*, {gap} - mu AS now FROM c JOIN k ON k.series = c.series AND k.p = c.s AND k.m = month(c.period)),
  q AS (SELECT o.series, o.s, h.y, h.r - o.alpha - o.beta * h.x - k.mu AS e FROM e o JOIN c h ON h.series = o.series AND h.s BETWEEN 2 AND o.s - 1
    JOIN k ON k.series = o.series AND k.p = o.s AND k.m = month(h.period) WHERE h.y IS NOT NULL),
  f AS (SELECT series, s, count(e) AS n, regr_intercept(y, e) AS const, regr_slope(y, e) AS b1, 0.0::DOUBLE AS b2 FROM q WHERE e IS NOT NULL GROUP BY ALL)"""
    split = f"""e AS (SELECT c.*, {gap} AS now FROM c),
  q AS (SELECT o.series, o.s, h.y, greatest(h.r - o.alpha - o.beta * h.x, 0) AS u, least(h.r - o.alpha - o.beta * h.x, 0) AS d FROM e o
    JOIN c h ON h.series = o.series AND h.s BETWEEN 2 AND o.s - 1 WHERE h.y IS NOT NULL AND h.r IS NOT NULL AND h.x IS NOT NULL),
  g AS (SELECT series, s, count(*) AS n, avg(u) AS mu, avg(d) AS md, avg(y) AS my, var_pop(u) AS uu, var_pop(d) AS dd, covar_pop(u, d) AS ud, covar_pop(u, y) AS uy, covar_pop(d, y) AS dy FROM q GROUP BY ALL),
  b AS (SELECT *, (uy * dd - dy * ud) / (uu * dd - ud * ud) AS b1, (dy * uu - uy * ud) / (uu * dd - ud * ud) AS b2 FROM g WHERE n >= 24),
  f AS (SELECT series, s, n, b1, b2, my - b1 * mu - b2 * md AS const FROM b)"""
    least = 24
    return f"""WITH {SG_SQL}, c AS (SELECT series, period, a AS r, b AS x, lead(a) OVER w - a AS y, lead(period) OVER w AS target, lead(a) OVER w AS actual, row_number() OVER w - 1 AS s,
    regr_intercept(a, b) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS alpha, regr_slope(a, b) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS beta
    FROM sg WINDOW w AS (PARTITION BY series ORDER BY period)),
  {centred if by_month else split}
  SELECT e.series, e.period AS origin, e.target, n AS n_train, round(e.now, 6) AS gap, round(e.r + const + b1 * {"e.now" if by_month else "greatest(e.now, 0)"} + b2 * least(e.now, 0), 5) AS prediction, round(e.actual, 6) AS actual
  FROM e JOIN f ON f.series = e.series AND f.s = e.s WHERE e.now IS NOT NULL AND n >= {least}"""


def _full_ecm(spark, d, spec, spare):
    out = E.walk_forward_ecm(segment_panel(spark, d), ["series"], "period", "a", "b", spec, burn_in=0, spare=spare)
    return out.select("series", "origin", "target", "n_train", *[F.round(c, k).alias(c) for c, k in (("gap", 6), ("prediction", 5), ("actual", 6))])


@query("wf_ecm_split", _ecm_full_sql(False))
def wf_ecm_split(spark, d):
    """Gaps above and below the long run close at speeds of their own."""
    return _full_ecm(spark, d, E.EcmSpec(x_lags=(), y_lags=(), gap="split"), 21)


@query("wf_ecm_by_month", _ecm_full_sql(True))
def wf_ecm_by_month(spark, d):
    """Gaps centred on the mean gap of their calendar month so far."""
    return _full_ecm(spark, d, E.EcmSpec(x_lags=(), y_lags=(), by_month=True), 22)


@query("wf_ecm_full")
def wf_ecm_full(spark, d):
    """All at once: lags of three series, the split of gaps and of the current change, and centring; a month without orders is a sum of none."""
    spec = E.EcmSpec(other_lags=(("c", (0, 1)),), gap="split", split_x=True, by_month=True)
    rows = segment_panel(spark, d).select("series", "period", *[F.coalesce(c, F.lit(0.0)).alias(c) for c in "abc"])
    return E.walk_forward_ecm(rows, ["series"], "period", "a", "b", spec)


_LONG_SQL = f"""WITH {SG_SQL}, l AS (SELECT series, period, 'a' AS part, coalesce(a, 0.0) AS v FROM sg UNION ALL SELECT series, period, 'b', coalesce(b, 0.0) FROM sg UNION ALL SELECT series, period, 'c', coalesce(c, 0.0) FROM sg),
  x AS (SELECT *, lag(v) OVER w AS x1 FROM l WINDOW w AS (PARTITION BY series, part ORDER BY period)),
  f AS (SELECT series, period, part, v, x1, CASE WHEN count(x1) OVER w >= 24 THEN regr_intercept(v, x1) OVER w + regr_slope(v, x1) OVER w * x1 END AS p FROM x WINDOW w AS (PARTITION BY series, part ORDER BY period ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
  t AS (SELECT series, period, sum(v) AS total, max(CASE WHEN part = 'a' THEN p END) + max(CASE WHEN part = 'b' THEN p END) AS p, max(CASE WHEN part = 'a' THEN x1 END) + max(CASE WHEN part = 'b' THEN x1 END) AS x1 FROM f GROUP BY ALL),
  y AS (SELECT series, period, p - x1 + lag(total) OVER w AS new, lag(total) OVER w AS old FROM t WINDOW w AS (PARTITION BY series ORDER BY period))"""


@query("bottom_up", _LONG_SQL + " SELECT series, period, round(CASE WHEN new > 0 AND old > 0 THEN ln(new) - ln(old) END, 6) AS total_dlog FROM y")
def bottom_up(spark, d):
    """Two parts of each segment forecast apart, the rest carried, and the total's log change from their sum."""
    long = segment_panel(spark, d).select("series", "period", *[F.coalesce(c, F.lit(0.0)).alias(c) for c in "abc"]).unpivot(["series", "period"], ["a", "b", "c"], "part", "v")
    rows = long.withColumn("x1", Series(["series", "part"], "period").lag(F.col("v")))
    fits = M.wf_ols_simple(rows, ["series", "part"], "period", "v", "x1", 24)
    out = M.bottom_up(fits, ["series"], "period", "part", "v", {"a": "a", "b": "b"})
    return out.select("series", "period", F.round("total_dlog", 6).alias("total_dlog"))


@query("ensemble_mean", f"WITH {BL_SQL} SELECT series, period, round(list_avg([rw, seasonal, mean3]), 9) AS ensemble, concat_ws('+', CASE WHEN rw IS NOT NULL THEN 'rw' END, CASE WHEN seasonal IS NOT NULL THEN 'seasonal' END, CASE WHEN mean3 IS NOT NULL THEN 'mean3' END) AS method FROM bl")
def ensemble_mean(spark, d):
    return M.ensemble_mean(based(spark, d), ["rw", "seasonal", "mean3"]).select("series", "period", F.round("ensemble", 9).alias("ensemble"), "method")


@query("linear_blend", f"WITH {BL_SQL} SELECT series, period, round(0.6 * rw + 0.4 * mean3, 9)::DOUBLE AS blend FROM bl")
def linear_blend(spark, d):
    return based(spark, d).select("series", "period", F.round(0.6 * F.col("rw") + 0.4 * F.col("mean3"), 9).alias("blend"))


@query("shrunk_ratio", f"WITH {MP_SQL} SELECT series, period, round(greatest(least((sum(value) OVER (PARTITION BY series) + 20 * 0.2::DOUBLE) / (sum(n) OVER (PARTITION BY series) + 20), 0.3::DOUBLE), 0.05::DOUBLE), 9) AS ratio FROM mp")
def shrunk_ratio(spark, d):
    return M.shrunk_ratio(monthly_panel(spark, d), ["series"], "value", "n", 0.2, 20.0, 0.05, 0.3).select("series", "period", F.round("ratio", 9).alias("ratio"))


@query("leave_one_out_ratio", f"WITH {MP_SQL} SELECT series, period, round(greatest(least((sum(value) OVER (PARTITION BY series) - value + 20 * 0.2::DOUBLE) / (sum(n) OVER (PARTITION BY series) - n + 20), 0.3::DOUBLE), 0.05::DOUBLE), 9) AS ratio FROM mp")
def leave_one_out_ratio(spark, d):
    return M.shrunk_ratio(monthly_panel(spark, d), ["series"], "value", "n", 0.2, 20.0, 0.05, 0.3, leave_one_out=True).select("series", "period", F.round("ratio", 9).alias("ratio"))


@query("maturity_blend", f"WITH {BL_SQL}, x AS (SELECT *, (month(period) - 1) / 11.0::DOUBLE AS c FROM bl) SELECT series, period, round(CASE WHEN c > 0 AND mean3 IS NOT NULL THEN pow(c, 0.5::DOUBLE) * mean3 + (1 - pow(c, 0.5::DOUBLE)) * rw ELSE rw END, 9) AS blend FROM x")
def maturity_blend(spark, d):
    rows = based(spark, d).withColumn("c", (F.month("period") - 1) / 11.0)
    return M.maturity_blend(rows, "mean3", "rw", "c", 0.5).select("series", "period", F.round("blend", 9).alias("blend"))


_TUESDAYS = [f"1998-{m:02d}-{day:02d}" for m, day in ((3, 3), (3, 10), (3, 17), (3, 24), (3, 31), (4, 7), (4, 14), (4, 21), (4, 28))]
_KNOWN_DESC = ", ".join(f"{c} DESC" for c in ["vintage", *TIE])


@query("revision_trajectory", f"""WITH {BT_SQL}, {origins_sql(_TUESDAYS)}, r AS (SELECT origin, series, period, value FROM bt JOIN origins ON period <= origin AND vintage <= origin
    QUALIFY row_number() OVER (PARTITION BY origin, series, period ORDER BY {_KNOWN_DESC}) = 1),
  g AS (SELECT origin, series, max(CASE WHEN period = DATE '1998-03-01' THEN value END) AS signal, arg_max(value, period) FILTER (WHERE period < DATE '1998-03-01') AS prior,
    greatest(least(date_diff('day', DATE '1998-03-01', origin) / 60.0::DOUBLE, 1.0), 0.0) AS c FROM r GROUP BY origin, series)
  SELECT origin, series, round(CASE WHEN c > 0 AND signal IS NOT NULL THEN pow(c, 0.5::DOUBLE) * signal + (1 - pow(c, 0.5::DOUBLE)) * prior ELSE prior END, 6) AS blend FROM g""")
def revision_trajectory(spark, d):
    """The blend as it would have been on each Tuesday before the release."""
    seen = V.as_of_many(bitemporal(spark, d), origins_table(spark, _TUESDAYS), ["series", "period"], "period", "vintage", TIE).where("vintage <= origin")
    rows = V.revision_trajectory(seen, ["series"], "period", "value", "1998-03-01")
    rows = rows.withColumn("c", F.greatest(F.least(F.datediff("origin", F.lit("1998-03-01").cast("date")) / 60, F.lit(1.0)), F.lit(0.0)))
    return M.maturity_blend(rows, "signal", "prior", "c", 0.5).select("origin", "series", F.round("blend", 6).alias("blend"))


@query("platt_scaling")
def platt_scaling(spark, d):
    """Calibrated day by day's block on the days before it."""
    return M.platt_scaling(outcomes(spark, d), "p", "y", "day", ["2024-01-08", "2024-01-15", "2024-01-22"]).select("series", "day", "p", "y", "calibrated")


@query("wf_gbt")
def wf_gbt(spark, d):
    """Every origin of every series from 24 rows on, fitted anew every 12 rows."""
    return trees.wf_trees(regressors(spark, d), ["series"], "period", "value", ["x1", "x2", "x3"], trees.TreeSpec(trees=30), min_train=24)


@query("wf_gbt_direction")
def wf_gbt_direction(spark, d):
    """The probability of a rise, from 50 labelled rows on, fitted at every row."""
    rows = regressors(spark, d).withColumn("up", F.when(F.col("x1").isNotNull(), (F.col("value") > F.col("x1")).cast("int")))
    return trees.wf_trees(rows, ["series"], "period", "up", ["x1", "x2", "x3"], trees.TreeSpec(trees=20, classify=True), refit_every=1)


_WINDOWS = {"gas": "1-URGENT", "diesel": "2-HIGH", "sp": "2-HIGH"}


def _columns(spec) -> dict[str, str]:
    """The panel column of each input: a window of daily data by its own name, the others by priorities in order of first mention."""
    plain = [x for x in spec.inputs() if x.split("_")[-1] not in ("mid", "sw", "late")]
    return {x: x for x in spec.inputs() if x not in plain} | {x: "abcef"[i % 5] for i, x in enumerate(plain)}


def job_panel(spark, d, spec):
    """The spec's inputs for every market segment."""
    panel, found = segment_panel(spark, d), _columns(spec)
    for name in dict.fromkeys(x.split("_")[0] for x in found if found[x] == x):
        days = segment_days(spark, d).where(F.col("kind") == _WINDOWS[name]).select("series", "day", (F.col("cents") / F.lit(100000007.0)).alias("value"))
        panel = panel.join(jobs.daily_windows(days, ["series"], "day", "value", name), ["series", "period"], "left")
    return panel.select("series", "period", *[F.col(c).alias(x) for x, c in found.items()])


def _windows_sql(name: str) -> str:
    kind = _WINDOWS[name]
    return f"""{name}_d AS (SELECT series, day, cents / 100000007.0 AS v, CAST(date_trunc('month', day) AS DATE) AS m FROM od WHERE kind = '{kind}'),
  {name}_t AS (SELECT DISTINCT series, m AS period, m + 14 - CAST(dayofweek(m + 12) AS INTEGER) AS at FROM {name}_d),
  {name}_w AS (SELECT t.series, t.period, (SELECT arg_max(v, day) FROM {name}_d x WHERE x.series = t.series AND x.day BETWEEN t.at - 6 AND t.at) AS {name}_mid,
    (SELECT avg(v) FROM {name}_d x WHERE x.series = t.series AND x.day BETWEEN CAST(t.period - INTERVAL 1 MONTH AS DATE) + 24 AND t.period + 6) AS {name}_sw,
    (SELECT avg(v) FROM {name}_d x WHERE x.series = t.series AND x.day BETWEEN t.period + 7 AND t.period + 20) AS {name}_late FROM {name}_t t)"""


def features_sql(spec: jobs.JobSpec) -> str:
    """The spec's features in SQL, written from its transforms."""
    found = _columns(spec)
    windows = list(dict.fromkeys(x.split("_")[0] for x in found if found[x] == x))
    joins = "".join(f" LEFT JOIN {n}_w ON {n}_w.series = sg.series AND {n}_w.period = sg.period" for n in windows)
    lag = lambda x, k=1: f"lag({x}, {k}) OVER w"

    def expression(kind, x, o):
        return {
            "level": x, "log": f"ln({x})", "diff": f"{x} - {lag(x)}", "dlog": f"ln({x}) - ln({lag(x)})", "pct": f"({x} / {lag(x)} - 1) * 100",
            "yoy_log": f"ln({x}) - ln({lag(x, 12)})", "centred": f"({x} - 50) / 100", "shortfall": f"50 - {x}", "deviation": f"{x} - avg({x}) OVER s",
            "gap": f"{x} - {o}", "log_gap": f"ln({x}) - ln({o})", "pct_of": f"({x} / {o} - 1) * 100", "gap_to_prior": f"{x} - {lag(o)}",
            "log_gap_to_prior": f"ln({x}) - ln({lag(o)})",
        }[kind]

    column = lambda n: f"list_avg([{', '.join(found[x] for x in n.split('+'))}])" if "+" in n else found.get(n)
    y = expression(spec.target_transform, found[spec.target], found.get(spec.target_other))
    first, second = [f"{y} AS y"], ["y"]
    for t in spec.terms:
        if t.transform == "month_dummies":
            second += [f"CASE WHEN month(period) = {i} THEN 1.0 ELSE 0.0 END::DOUBLE AS m_{i}" for i in range(2, 13)]
        elif t.transform == "seasonal":
            second.append(f"avg(y) OVER s AS {t.name}")
        elif t.transform == "seasonal_gap":
            first.append(f"({y}) - ({expression('dlog', column(t.input), None)}) AS t_{t.name}")
            second.append(f"avg(t_{t.name}) OVER s AS {t.name}")
        else:
            first.append(f"{expression(t.transform, column(t.input), found.get(t.other))} AS t_{t.name}")
            second.append((f"{lag('t_' + t.name, t.lag)}" if t.lag else f"t_{t.name}") + f" AS {t.name}")
    over = "WINDOW w AS (PARTITION BY series ORDER BY period), s AS (PARTITION BY series, month(period) ORDER BY period ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    names = ["y", *jobs.feature_names(spec.terms)]
    return f"""WITH {SG_SQL}{"".join(", " + _windows_sql(n) for n in windows)}, p AS (SELECT sg.*{"".join(f", {n}_mid, {n}_sw, {n}_late" for n in windows)} FROM sg{joins}),
  one AS (SELECT series, period, {", ".join(first)} FROM p {over}), two AS (SELECT series, period, {", ".join(second)} FROM one {over})
  SELECT series, period, {", ".join(f"round({n}, 6) AS {n}" for n in names)} FROM two"""


def _features(spark, d, spec):
    rows = jobs.build_features(job_panel(spark, d, spec), spec, ["series"], "period")
    return rows.select("series", "period", *[F.round(n, 6).alias(n) for n in ("y", *jobs.feature_names(spec.terms))])


def _job(name: str):
    spec = jobs.SPECS[name]

    @query(f"{name}_features", features_sql(spec))
    def features(spark, d):
        """The job's target and regressors for every market segment, whose priorities' monthly values stand for its inputs."""
        return _features(spark, d, spec)

    @query(name)
    def run(spark, d):
        """The job at every month of every market segment; the tables hold 80 months, so 24 rows are enough to train on here."""
        return jobs.run_job(job_panel(spark, d, spec), spec, ["series"], "period", min_train=24)


for _name in jobs.SPECS:
    _job(_name)

_CHALLENGER = jobs.ENSEMBLES["challenger_job"]
_CHALLENGER_TERMS = jobs.JobSpec("challenger_job", "cuts", "log", tuple({t.name: t for m in _CHALLENGER.members for t in m.terms}.values()), 48)


@query("challenger_job_features", features_sql(_CHALLENGER_TERMS))
def challenger_job_features(spark, d):
    return _features(spark, d, _CHALLENGER_TERMS)


@query("challenger_job")
def challenger_job(spark, d):
    """The ridge ensemble over every market segment."""
    return jobs.run_ensemble(job_panel(spark, d, _CHALLENGER), _CHALLENGER, ["series"], "period", min_train=36)


@query("shelter_job", f"WITH {MP_SQL} SELECT series, period, round(CASE WHEN count(g) OVER (w ROWS BETWEEN 6 PRECEDING AND 1 PRECEDING) >= 4 THEN avg(g) OVER (w ROWS BETWEEN 6 PRECEDING AND 1 PRECEDING) END, 6) AS prediction FROM (SELECT series, period, (value / lag(value) OVER {_W}) - 1) * 100 AS g FROM mp) WINDOW w AS (PARTITION BY series ORDER BY period)")
def shelter_job(spark, d):
    """Trailing mean of six monthly changes."""
    s = Series(["series"], "period")
    rows = monthly_panel(spark, d).withColumn("g", s.pct_change(F.col("value")))
    return rows.select("series", "period", F.round(s.rolling_mean(F.col("g"), 6, 4), 6).alias("prediction"))


# --- streams over the events table


def _stream(spark, d):
    schema = spark.read.parquet(f"{d}/events.parquet").schema
    rows = spark.readStream.schema(schema).parquet(f"{d}/events.parquet*")
    return rows.withColumn("ts", F.col("ts").cast("timestamp"))


@query("stream_append", "SELECT event_id, event_type, value FROM events WHERE event_type = 'click'")
def stream_append(spark, d):
    path = scratch_path(spark, "stream")
    streams.stream_append(_stream(spark, d).where("event_type = 'click'").select("event_id", "event_type", "value"), f"{path}/out", f"{path}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{path}/out")


@query("stream_upsert", "SELECT user_id, arg_max(event_id, row(ts, event_id)) AS event_id, arg_max(value, row(ts, event_id)) AS value FROM events GROUP BY user_id")
def stream_upsert(spark, d):
    path = scratch_path(spark, "stream")
    q = streams.stream_upsert(_stream(spark, d).select("user_id", "ts", "event_id", "value"), f"{path}/out", f"{path}/checkpoint", ["user_id"], ["ts", "event_id"])
    q.awaitTermination()
    return streams.current_snapshot(spark, f"{path}/out").select("user_id", "event_id", "value")


@query("stream_latest", "SELECT event_type, arg_max(value, row(ts, event_id)) AS value FROM events GROUP BY event_type")
def stream_latest(spark, d):
    path = scratch_path(spark, "stream")
    rows = streams.latest_values(_stream(spark, d).select("event_type", "ts", "event_id", "value"), ["event_type"], ["ts", "event_id"])
    streams.run_to_end(rows.select("event_type", "value"), f"{path}/out", f"{path}/checkpoint", "complete")
    return spark.read.parquet(f"{path}/out")


@query("stream_bucket_mean", "SELECT event_type, CAST(time_bucket(INTERVAL 7 DAY, ts, TIMESTAMP '1970-01-01 00:00:00') AS TIMESTAMP) AS start, CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) / 100.0 / count(*) AS mean, count(*) AS n FROM events GROUP BY ALL")
def stream_bucket_mean(spark, d):
    path = scratch_path(spark, "stream")
    rows = streams.bucket_means(_stream(spark, d), ["event_type"], "ts", "value", "7 days", "1 day")
    streams.run_to_end(rows, f"{path}/out", f"{path}/checkpoint", "complete")
    return spark.read.parquet(f"{path}/out")


@query("stream_first_vintage", f"WITH {BT_SQL} SELECT series, period, arg_min(vintage, row(vintage, {', '.join(TIE)})) AS vintage, arg_min(value, row(vintage, {', '.join(TIE)})) AS value FROM bt GROUP BY series, period")
def stream_first_vintage(spark, d):
    """First prints by vintage, whatever the order of arrival, kept in a table that corrections change in place."""
    path = scratch_path(spark, "stream")
    schema = spark.read.parquet(f"{d}/lineitem.parquet").schema
    arrivals = spark.readStream.schema(schema).parquet(f"{d}/lineitem.parquet*")
    rows = vintages(arrivals).withColumn("arrival", F.col("l_shipdate").cast("timestamp")).drop("source", "l_shipdate")
    prints = first_print.first_prints(rows, ["series", "period"], ["vintage", *TIE], "arrival", "3650 days", 3650)
    held = VersionedTable.create(spark, f"{path}/table", prints.drop("corrections").schema, ["series", "period"], 8)
    first_print.publish_first_prints(prints, held, ["series", "period"], ["vintage", *TIE], f"{path}/checkpoint").awaitTermination()
    return held.read().select("series", "period", "vintage", "value")


@query("stream_first_print")
def stream_first_print(spark, d):
    path = scratch_path(spark, "stream")
    rows = streams.first_arrivals(_stream(spark, d).select("user_id", "event_type", "ts", "event_id"), ["user_id", "event_type"], "ts", "60 days")
    streams.run_to_end(rows, f"{path}/out", f"{path}/checkpoint", "append")
    return spark.read.parquet(f"{path}/out")
