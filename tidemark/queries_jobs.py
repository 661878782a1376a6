"""Queries of composed jobs, of the SQL function surface, and of composite scores."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.scalars import row_mean
from tidemark.operators import features as P
from tidemark.operators import reshape as R
from tidemark.operators import scoring as C
from tidemark.operators import vintage as V
from tidemark.operators import walkforward as M
from tidemark.operators.features import Series
from tidemark.plans.fixtures import (
    BT_SQL, MP_SQL, SG_SQL, SN_SQL, TIE, bitemporal, daily_series, monthly_panel, segment_days, segment_panel, snapshots, table,
)
from tidemark.plans import scripts
from tidemark.queries import _origins_sql as origins_sql
from tidemark.queries import origins_table, query, scratch_path

_KNOWN = ", ".join(f"CASE WHEN vintage <= DATE '1998-01-15' THEN {c} ELSE -{c} END DESC" for c in TIE)


@query(
    "as_of_sql_function",
    f"""WITH {BT_SQL} SELECT series, period, value FROM bt WHERE period <= DATE '1998-03-01' QUALIFY row_number() OVER (PARTITION BY series, period ORDER BY vintage <= DATE '1998-01-15' DESC,
    CASE WHEN vintage <= DATE '1998-01-15' THEN date_diff('day', DATE '1970-01-01', vintage) ELSE -date_diff('day', DATE '1970-01-01', vintage) END DESC, {_KNOWN}) = 1""",
)
def as_of_sql_function(spark, d):
    """The as-of read as a SQL table function with parameters, called by a parameterised query."""
    bitemporal(spark, d).createOrReplaceTempView("obs_vintage")
    ties = ", ".join(f"IF(known, {c}, -{c}) DESC" for c in TIE)
    spark.sql(f"""
      CREATE OR REPLACE TEMPORARY FUNCTION as_of_read(origin DATE, max_period DATE, use_vintages BOOLEAN) RETURNS TABLE (series STRING, period DATE, value DOUBLE)
      RETURN SELECT series, period, value FROM (
        SELECT *, row_number() OVER (PARTITION BY series, period ORDER BY known DESC, IF(known, datediff(vintage, DATE'1970-01-01'), -datediff(vintage, DATE'1970-01-01')) DESC, {ties}) AS n
        FROM (SELECT *, NOT as_of_read.use_vintages OR vintage <= as_of_read.origin AS known FROM obs_vintage WHERE period <= as_of_read.max_period)) WHERE n = 1""")
    return spark.sql("SELECT * FROM as_of_read(CAST(:origin AS DATE), CAST(:last AS DATE), true)", args={"origin": "1998-01-15", "last": "1998-03-01"})


@query("zscore_composite", f"WITH {SG_SQL} SELECT series, period, round(list_avg([(a - avg(a) OVER w) / stddev_pop(a) OVER w, (b - avg(b) OVER w) / stddev_pop(b) OVER w, (f - avg(f) OVER w) / stddev_pop(f) OVER w]), 6) AS composite FROM sg WINDOW w AS (PARTITION BY series)")
def zscore_composite(spark, d):
    s = Series(["series"], "period")
    return segment_panel(spark, d).select("series", "period", F.round(row_mean([s.zscore(F.col(c)) for c in "abf"]), 6).alias("composite"))


@query(
    "vintage_panel_job",
    f"""WITH {BT_SQL}, l AS (SELECT series, period, value / 1009 AS value FROM bt QUALIFY row_number() OVER (PARTITION BY series, period ORDER BY {", ".join(f"{c} DESC" for c in ["vintage", *TIE])}) = 1),
    g AS (SELECT series, CAST(unnest(generate_series(min(period), max(period), INTERVAL 1 MONTH)) AS DATE) AS period FROM l GROUP BY series), x AS (SELECT g.series, g.period, value FROM g LEFT JOIN l ON g.series = l.series AND g.period = l.period)
    SELECT series, period, round(value, 9) AS value, round(lag(value) OVER w, 9) AS lag1, round(CASE WHEN count(value) OVER (w ROWS BETWEEN 12 PRECEDING AND 1 PRECEDING) >= 9 THEN avg(value) OVER (w ROWS BETWEEN 12 PRECEDING AND 1 PRECEDING) END, 9) AS mean12,
      round(avg(value) OVER (PARTITION BY series, month(period) ORDER BY period ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 9) AS seasonal FROM x WINDOW w AS (PARTITION BY series ORDER BY period)""",
)
def vintage_panel_job(spark, d):
    """Latest vintages on a dense calendar with their features: one lazy plan."""
    latest = V.latest_vintage(bitemporal(spark, d), ["series", "period"], ["vintage", *TIE]).select("series", "period", (F.col("value") / 1009).alias("value"))
    s, v = Series(["series"], "period"), F.col("value")
    out = R.densify(latest, ["series"], "period").withColumns({"lag1": s.lag(v), "mean12": s.rolling_mean(v, 12, 9), "seasonal": s.seasonal_mean(v)})
    return out.select("series", "period", *[F.round(c, 9).alias(c) for c in ("value", "lag1", "mean12", "seasonal")])


@query(
    "cpi_bottom_up_job",
    f"""WITH {MP_SQL}, base AS (SELECT series, value AS b FROM mp WHERE period = DATE '1997-01-01'),
    m AS (SELECT mp.series, mp.period, mp.value / lag(mp.value) OVER w - 1 AS g, lag(mp.value) OVER w / b AS wt FROM mp JOIN base ON mp.series = base.series WINDOW w AS (PARTITION BY mp.series ORDER BY mp.period)),
    n AS (SELECT series, period, wt, g, CASE WHEN count(g) OVER (w ROWS BETWEEN 12 PRECEDING AND 1 PRECEDING) >= 9 THEN avg(g) OVER (w ROWS BETWEEN 12 PRECEDING AND 1 PRECEDING) END AS nowcast FROM m WINDOW w AS (PARTITION BY series ORDER BY period)),
    s AS (SELECT *, wt / sum(wt) OVER (PARTITION BY period) AS share FROM n)
    SELECT period, round(sum(share * nowcast) * 100, 6) AS predicted, round(sum(share * g) * 100, 6) AS actual FROM s GROUP BY period""",
)
def cpi_bottom_up_job(spark, d):
    """Components' trailing means, weighted by price-updated shares, against the weighted actual change."""
    s = Series(["series"], "period")
    rows = P.price_updated_weights(monthly_panel(spark, d).withColumn("weight", F.lit(1.0)), "series", "period", "value", "weight", "1997-01-01")
    rows = rows.withColumn("g", F.col("value") / s.lag(F.col("value")) - 1).withColumn("nowcast", s.rolling_mean(F.col("g"), 12, 9))
    return rows.groupBy("period").agg(F.round(F.sum(F.col("share") * F.col("nowcast")) * 100, 6).alias("predicted"), F.round(F.sum(F.col("share") * F.col("g")) * 100, 6).alias("actual"))


def employment_panel(spark, d):
    """Per market segment: monthly change, its momentum, the mean of weekly counts and a composite of surveys; masked months teach nothing."""
    s = Series(["series"], "period")
    weeks = segment_days(spark, d).groupBy("series", F.date_add(F.trunc("day", "WEEK"), 5).alias("week")).agg(F.count("*").alias("claims"))
    claims = weeks.groupBy("series", F.trunc("week", "MM").alias("period")).agg(F.avg("claims").alias("claims"))
    panel = segment_panel(spark, d).join(claims, ["series", "period"], "left").withColumn("y", s.diff(F.col("a")))
    panel = panel.withColumns({"mom1": s.lag(F.col("y")), "mom3": s.rolling_mean(F.col("y"), 3, 3), "claims1": s.lag(F.col("claims")), "survey": row_mean([s.zscore(F.col(c), True) for c in "bf"])})
    masked = F.col("period").between(F.lit("1997-03-01").cast("date"), F.lit("1997-06-01").cast("date"))
    return panel.withColumn("y", F.when(~masked, F.col("y")))


_PRIOR = "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"


@query("employment_panel", f"""WITH {SG_SQL}, wk AS (SELECT series, CAST(date_trunc('week', day) AS DATE) + 5 AS week, count(*) AS n FROM od GROUP BY ALL), cl AS (SELECT series, CAST(date_trunc('month', week) AS DATE) AS period, avg(n) AS claims FROM wk GROUP BY ALL),
  p AS (SELECT sg.*, claims, a - lag(a) OVER (PARTITION BY sg.series ORDER BY sg.period) AS y FROM sg LEFT JOIN cl ON cl.series = sg.series AND cl.period = sg.period)
  SELECT series, period, round(CASE WHEN period NOT BETWEEN DATE '1997-03-01' AND DATE '1997-06-01' THEN y END, 6) AS y, round(lag(y) OVER w, 6) AS mom1,
    round(CASE WHEN count(y) OVER (w ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING) >= 3 THEN avg(y) OVER (w ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING) END, 6) AS mom3, round(lag(claims) OVER w, 6) AS claims1,
    round(list_avg([CASE WHEN stddev_pop(b) OVER (w {_PRIOR}) > 0 THEN (b - avg(b) OVER (w {_PRIOR})) / stddev_pop(b) OVER (w {_PRIOR}) END, CASE WHEN stddev_pop(f) OVER (w {_PRIOR}) > 0 THEN (f - avg(f) OVER (w {_PRIOR})) / stddev_pop(f) OVER (w {_PRIOR}) END]), 6) AS survey
  FROM p WINDOW w AS (PARTITION BY series ORDER BY period)""")
def employment_panel_query(spark, d):
    return employment_panel(spark, d).select("series", "period", *[F.round(c, 6).alias(c) for c in ("y", "mom1", "mom3", "claims1", "survey")])


@query("employment_panel_job")
def employment_panel_job(spark, d):
    """Ridge at every origin of every market segment."""
    return M.wf_ols(employment_panel(spark, d), ["series"], "period", "y", ["mom1", "mom3", "claims1", "survey"], 24, ridge=5.0).select("series", "period", "y", "n_train", "prediction")


def rate_panel(spark, d):
    s = Series(["series"], "period")
    panel = segment_panel(spark, d).withColumn("rate", F.col("a") / (F.col("a") + F.col("b")) * 100)
    return panel.withColumn("y", s.diff(F.col("rate"))).withColumns({"y1": s.lag(F.col("y")), "y2": s.lag(F.col("y"), 2), "ratio": s.lag(F.ln(F.col("f")) - F.ln(F.col("b")))})


@query("rate_panel", f"""WITH {SG_SQL}, p AS (SELECT *, a / (a + b) * 100 AS rate FROM sg), q AS (SELECT *, rate - lag(rate) OVER w AS y FROM p WINDOW w AS (PARTITION BY series ORDER BY period))
  SELECT series, period, round(rate, 6) AS rate, round(y, 6) AS y, round(lag(y) OVER w, 6) AS y1, round(lag(y, 2) OVER w, 6) AS y2, round(lag(ln(f) - ln(b)) OVER w, 6) AS ratio FROM q WINDOW w AS (PARTITION BY series ORDER BY period)""")
def rate_panel_query(spark, d):
    return rate_panel(spark, d).select("series", "period", *[F.round(c, 6).alias(c) for c in ("rate", "y", "y1", "y2", "ratio")])


@query("rate_panel_job")
def rate_panel_job(spark, d):
    """Change of a rate on its own lags and a claims ratio, in every market segment; the level is rounded half to even."""
    s = Series(["series"], "period")
    out = M.wf_ols(rate_panel(spark, d), ["series"], "period", "y", ["y1", "y2", "ratio"], 24, ridge=1.0)
    return out.select("series", "period", "n_train", "prediction", F.bround(s.lag(F.col("rate")) + F.col("prediction"), 1).alias("rounded_rate"))


@query("pump_price_job")
def pump_price_job(spark, d):
    """Next day's value from the last changes, blended with a carry, in bands of Student's t."""
    s, v = Series(["series"], "day"), F.col("value")
    rows = daily_series(spark, d).select("series", "day", "value").withColumn("change", s.gap_aware_diff(v, 3))
    rows = rows.withColumns({"c1": s.lag(F.col("change")), "c2": s.lag(F.col("change"), 2), "last": s.lag(v)})
    fit = M.wf_ols(rows, ["series"], "day", "change", ["c1", "c2"], 8, intercept=False)
    point = F.coalesce(0.75 * (F.col("last") + F.col("prediction")) + 0.25 * F.col("last"), F.col("last"))
    fit = fit.withColumn("point", point).withColumn("error", F.col("point") - v)
    sigma = C.rmse_sigma(fit, ["series"], "error", 20, F.stddev_samp("error") / F.sqrt(F.lit(5.0))).select("series", "sigma")
    live = fit.join(sigma, "series").where("point is not null and sigma > 0")
    return C.band_distribution(live, "point", "sigma", 0.5, heavy=True).select("series", "day", "point", "sigma", "band_low", "band_high", "p_band")


@query("pulse_bridge_job", f"""WITH {MP_SQL}, w AS (SELECT o_orderpriority AS series, CAST(date_trunc('week', o_orderdate) AS DATE) + 5 AS week, count(*) AS n FROM orders GROUP BY ALL),
  q AS (SELECT series, CAST(date_trunc('month', week) AS DATE) AS period, CAST(sum(n) AS BIGINT) AS pulse, count(*) AS weeks FROM w WHERE day(week) <= 20 GROUP BY ALL),
  r AS (SELECT mp.series, mp.period, mp.n, pulse, least(weeks / 4.0::DOUBLE, 1.0) AS c, mp.period >= DATE '1996-01-01' AND weeks / 4.0::DOUBLE >= 0.5 AS t FROM mp JOIN q ON q.series = mp.series AND q.period = mp.period),
  x AS (SELECT *, sum(CASE WHEN t THEN n ELSE 0 END) OVER w - CASE WHEN t THEN n ELSE 0 END AS sy, sum(CASE WHEN t THEN pulse ELSE 0 END) OVER w - CASE WHEN t THEN pulse ELSE 0 END AS sx, 50.0::DOUBLE * (1 - c) AS k,
    lag(n) OVER (PARTITION BY series ORDER BY period) AS prior FROM r WINDOW w AS (PARTITION BY series)),
  y AS (SELECT *, greatest(least((sy + k * 1.5::DOUBLE) / (sx + k), 3.0::DOUBLE), 0.5::DOUBLE) AS ratio FROM x)
  SELECT series, period, n, round(ratio, 6) AS ratio, round(CASE WHEN c > 0 THEN pow(c, 0.5::DOUBLE) * (ratio * pulse) + (1 - pow(c, 0.5::DOUBLE)) * prior ELSE prior END, 6) AS blend FROM y""")
def pulse_bridge_job(spark, d):
    """A month's total from the weeks seen so far: completeness, a ratio of the months from a floor on with half of their weeks seen,
    shrunk, and a blend with last month."""
    weeks = table(spark, d, "orders").groupBy(F.col("o_orderpriority").alias("series"), F.date_add(F.trunc("o_orderdate", "WEEK"), 5).alias("week")).agg(F.count("*").alias("n"))
    seen = weeks.where(F.dayofmonth("week") <= 20).groupBy("series", F.trunc("week", "MM").alias("period")).agg(F.sum("n").alias("pulse"), F.count("*").alias("weeks"))
    rows = monthly_panel(spark, d).join(seen, ["series", "period"]).withColumn("c", F.least(F.col("weeks") / 4.0, F.lit(1.0)))
    counts = (F.col("period") >= F.lit("1996-01-01").cast("date")) & (F.col("weeks") / 4.0 >= 0.5)
    rows = M.shrunk_ratio(rows, ["series"], "n", "pulse", 1.5, 50.0, 0.5, 3.0, completeness="c", leave_one_out=True, counts=counts)
    s = Series(["series"], "period")
    rows = rows.withColumn("signal", F.col("ratio") * F.col("pulse")).withColumn("prior", s.lag(F.col("n")).cast("double"))
    return M.maturity_blend(rows, "signal", "prior", "c", 0.5).select("series", "period", "n", F.round("ratio", 6).alias("ratio"), F.round("blend", 6).alias("blend"))


_DRIFT = ", ".join(f"CASE WHEN lag(average, {k}) OVER w IS NOT NULL THEN (average - lag(average, {k}) OVER w) / {k} END" for k in range(14, 4, -1))


@query("poll_average_job", f"""WITH {SN_SQL}, a AS (SELECT kind, day, coalesce(max(CASE WHEN member = 7 THEN cents END) / 100.0, round_even(CAST(sum(CASE WHEN member <> 7 THEN cents END) AS DOUBLE) / count(CASE WHEN member <> 7 THEN 1 END) / 100, 1)) AS average FROM sn GROUP BY kind, day),
  g AS (SELECT kind, CAST(unnest(generate_series(min(day), max(day), INTERVAL 1 DAY)) AS DATE) AS day FROM a GROUP BY kind), x AS (SELECT g.kind, g.day, average FROM g LEFT JOIN a ON a.kind = g.kind AND a.day = g.day),
  f AS (SELECT *, coalesce({_DRIFT}, 0.0) AS drift FROM x WINDOW w AS (PARTITION BY kind ORDER BY day))
  SELECT kind, day, CAST(h AS INTEGER) AS h, day + CAST(h AS INTEGER) AS target, round(average + drift * h * (7 - h) / 6.0::DOUBLE, 6) AS forecast FROM f, (SELECT range AS h FROM range(1, 7))""")
def poll_average_job(spark, d):
    """Published average or the members' mean per kind of poll and day, carried on with its local drift, h = 1..6."""
    days = R.published_or_mean(snapshots(spark, d), ["kind", "day"], F.col("member") == 7, F.col("cents"))
    s = Series(["kind"], "day")
    dense = R.densify(days, ["kind"], "day", "1 day").withColumn("drift", s.local_drift(F.col("average")))
    ahead = dense.withColumn("h", F.explode(F.sequence(F.lit(1), F.lit(6))))
    forecast = F.col("average") + F.coalesce("drift", F.lit(0.0)) * F.col("h") * (7 - F.col("h")) / 6
    return ahead.select("kind", "day", "h", F.date_add("day", F.col("h")).alias("target"), F.round(forecast, 6).alias("forecast"))


_QUARTERS = [f"{y}-{m:02d}-01" for y in range(1995, 2000) for m in (3, 9)]
_SCRIPT_SQL = """past AS (SELECT o.origin, mp.*, row_number() OVER (PARTITION BY o.origin, series ORDER BY period) AS k FROM mp JOIN origins o ON period <= o.origin),
  trend AS (SELECT origin, series, regr_slope(value, k) AS slope, regr_intercept(value, k) AS level, max(k) AS k FROM past GROUP BY origin, series),
  f AS (SELECT t.series, t.origin, CAST(h AS INTEGER) AS horizon, CAST(t.origin + to_months(CAST(h AS INTEGER)) AS DATE) AS target, level + slope * (t.k + h) AS forecast, y.value AS seasonal
    FROM trend t CROSS JOIN (SELECT unnest(range(1, 4)) AS h) JOIN mp y ON y.series = t.series AND y.period = t.origin + to_months(CAST(h AS INTEGER) - 12))
  SELECT series, origin, horizon, target, round(forecast, 6) AS forecast, round(seasonal, 6) AS seasonal, 'trend_v1' AS model_version FROM f
  WHERE forecast IS NOT NULL QUALIFY count(*) OVER (PARTITION BY origin) = 3 * (SELECT count(DISTINCT series) FROM mp)"""


def _published(df):
    return df.select("series", "origin", "horizon", "target", *[F.round(c, 6).alias(c) for c in ("forecast", "seasonal")], "model_version")


@query("scripted_forecast", f"WITH {MP_SQL}, origins AS (SELECT max(period) AS origin FROM mp WHERE period <= DATE '1999-08-20'), {_SCRIPT_SQL}")
def scripted_forecast(spark, d):
    """A procedure as a SQL script: the origin found at run time, a guard that refuses to publish too few rows, one insert."""
    return _published(scripts.forecast_once(spark, monthly_panel(spark, d), scratch_path(spark, "script"), "1999-08-20"))


@query("scripted_walk_forward", f"WITH {MP_SQL}, {origins_sql(_QUARTERS)}, {_SCRIPT_SQL}")
def scripted_walk_forward(spark, d):
    """A loop over origins whose first fail, for want of a year before them, and are trapped."""
    done, _ = scripts.forecast_each(spark, monthly_panel(spark, d), origins_table(spark, _QUARTERS), scratch_path(spark, "script"))
    return _published(done)
