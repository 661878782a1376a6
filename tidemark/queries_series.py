"""Queries of joins, calendars, buckets and point-in-time features."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import features as P
from tidemark.operators import reshape as R
from tidemark.operators import selection
from tidemark.plans.fixtures import DS_SQL, MP_SQL, SN_SQL, daily_series, monthly_panel, snapshots, table
from tidemark.queries import origins_table, query, scratch_path
from tidemark.queries import _origins_sql as origins_sql

# --- joins and reshaping


@query("join_inner_eq", "SELECT o_orderkey, c_mktsegment, o_totalprice FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_totalprice > 300000")
def join_inner_eq(spark, d):
    o = table(spark, d, "orders").where("o_totalprice > 300000")
    return o.join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "c_mktsegment", "o_totalprice")


@query("join_left", """SELECT c_custkey, n_name, r_name, coalesce(k, 0) AS k FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
  LEFT JOIN (SELECT o_custkey, count(*) AS k FROM orders WHERE o_orderstatus = 'P' GROUP BY o_custkey) ON o_custkey = c_custkey""")
def join_left(spark, d):
    k = table(spark, d, "orders").where("o_orderstatus = 'P'").groupBy("o_custkey").agg(F.count("*").alias("k"))
    n = table(spark, d, "nation").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    out = table(spark, d, "customer").join(n, F.col("c_nationkey") == F.col("n_nationkey")).join(k, F.col("c_custkey") == F.col("o_custkey"), "left")
    return out.select("c_custkey", "n_name", "r_name", F.coalesce("k", F.lit(0)).alias("k"))


@query("join_full_outer", f"""WITH {MP_SQL}, a AS (SELECT period, value FROM mp WHERE series = '1-URGENT' AND year(period) < 2000), b AS (SELECT period, value FROM mp WHERE series = '2-HIGH' AND year(period) > 1996)
  SELECT coalesce(a.period, b.period) AS period, a.value AS urgent, b.value AS high FROM a FULL JOIN b ON a.period = b.period""")
def join_full_outer(spark, d):
    m = monthly_panel(spark, d)
    a = m.where("series = '1-URGENT' AND year(period) < 2000").select("period", F.col("value").alias("urgent"))
    b = m.where("series = '2-HIGH' AND year(period) > 1996").select("period", F.col("value").alias("high"))
    return a.join(b, "period", "full")


@query("join_range_origin", f"WITH {MP_SQL}, {origins_sql()} SELECT origin, series, count(*) AS n, max(period) AS last_period, CAST(sum(n) AS BIGINT) AS total FROM mp JOIN origins ON period BETWEEN DATE '1996-01-01' AND origin GROUP BY origin, series")
def join_range_origin(spark, d):
    rows = monthly_panel(spark, d).where("period >= '1996-01-01'").join(F.broadcast(origins_table(spark)), F.col("period") <= F.col("origin"))
    return rows.groupBy("origin", "series").agg(F.count("*").alias("n"), F.max("period").alias("last_period"), F.sum("n").alias("total"))


@query("join_offset", f"WITH {MP_SQL} SELECT a.series, a.period, a.value, b.value AS offset_value FROM mp a LEFT JOIN mp b ON a.series = b.series AND b.period = a.period - INTERVAL 12 MONTH")
def join_offset(spark, d):
    return R.join_offset(monthly_panel(spark, d), ["series"], "period", "value", months=12).select("series", "period", "value", "offset_value")


@query("join_asof_last", f"""WITH {MP_SQL}, l AS (SELECT DISTINCT series, CAST(last_day(period) AS DATE) AS at FROM mp),
  o AS (SELECT o_orderpriority AS series, CAST(o_orderdate AS DATE) AS day, max(o_totalprice) AS price FROM orders GROUP BY ALL)
  SELECT l.series, l.at, CASE WHEN date_diff('day', o.day, l.at) <= 2 THEN o.day END AS asof_when, CASE WHEN date_diff('day', o.day, l.at) <= 2 THEN o.price END AS asof_value
  FROM l ASOF LEFT JOIN o ON l.series = o.series AND l.at >= o.day""")
def join_asof_last(spark, d):
    left = monthly_panel(spark, d).select("series", F.last_day("period").alias("at")).distinct()
    right = table(spark, d, "orders").groupBy(F.col("o_orderpriority").alias("series"), F.to_date("o_orderdate").alias("day")).agg(F.max("o_totalprice").alias("price"))
    return R.join_asof_last(left, right, ["series"], "at", "day", "price", 2)


@query("asof_top_k", """WITH w AS (SELECT o_orderpriority AS series, CAST(date_trunc('week', o_orderdate) AS DATE) + 5 AS week, count(*)::DOUBLE AS n FROM orders GROUP BY ALL),
  g AS (SELECT series, CAST(unnest(generate_series(CAST(date_trunc('month', min(week)) AS DATE), CAST(date_trunc('month', max(week)) AS DATE), INTERVAL 1 MONTH)) AS DATE) AS period FROM w GROUP BY series),
  x AS (SELECT g.series, period, n, row_number() OVER (PARTITION BY g.series, period ORDER BY week DESC) AS k FROM g JOIN w ON w.series = g.series AND week <= last_day(period))
  SELECT series, period, """ + ", ".join(f"CASE WHEN max(k) >= 6 THEN max(CASE WHEN k = {i + 1} THEN n END) END AS v{i}" for i in range(6)) + " FROM x GROUP BY series, period")
def asof_top_k(spark, d):
    """Six weeks up to the month's end: always more than the month holds."""
    weeks = table(spark, d, "orders").groupBy(F.col("o_orderpriority").alias("series"), F.date_add(F.trunc("o_orderdate", "WEEK"), 5).alias("week")).agg(F.count("*").cast("double").alias("n"))
    return R.asof_top_k(weeks, ["series"], "week", "n", 6)


_PRIORITIES = {"1-URGENT": "urgent", "2-HIGH": "high", "3-MEDIUM": "medium", "4-NOT SPECIFIED": "unspecified", "5-LOW": "low"}


@query("pivot_long_wide", f"WITH {MP_SQL} SELECT period, " + ", ".join(f"max(CASE WHEN series = '{k}' THEN value END) AS {v}" for k, v in _PRIORITIES.items()) + " FROM mp GROUP BY period")
def pivot_long_wide(spark, d):
    return R.pivot_wide(monthly_panel(spark, d), ["period"], "series", "value", _PRIORITIES)


@query("unpivot_methods", f"WITH {MP_SQL} SELECT series, period, method, prediction FROM (SELECT series, period, value AS rw, value * 2 AS double FROM mp) UNPIVOT (prediction FOR method IN (rw, double))")
def unpivot_methods(spark, d):
    rows = monthly_panel(spark, d).select("series", "period", F.col("value").alias("rw"), (F.col("value") * 2).alias("double"))
    return rows.unpivot(["series", "period"], ["rw", "double"], "method", "prediction")


@query("union_all", "SELECT o_orderkey AS k, 'order' AS kind FROM orders UNION ALL SELECT c_custkey, 'customer' FROM customer")
def union_all(spark, d):
    a = table(spark, d, "orders").select(F.col("o_orderkey").alias("k"), F.lit("order").alias("kind"))
    return a.unionByName(table(spark, d, "customer").select(F.col("c_custkey").alias("k"), F.lit("customer").alias("kind")))


@query("intersect_origins", f"WITH {MP_SQL}, x AS (SELECT * FROM mp WHERE NOT (series = '5-LOW' AND month(period) < 4)) SELECT series, period, value FROM x WHERE period IN (SELECT period FROM x GROUP BY period HAVING count(DISTINCT series) = 5)")
def intersect_origins(spark, d):
    rows = monthly_panel(spark, d).where("NOT (series = '5-LOW' AND month(period) < 4)")
    return R.intersect_origins(rows, ["period"], "series", 5).select("series", "period", "value")


def holed(spark, d):
    """The monthly panel with two months of every year missing."""
    return monthly_panel(spark, d).where("month(period) NOT IN (5, 6)").select("series", "period", "value")


_HOLED = MP_SQL + ", holed AS (SELECT series, period, value FROM mp WHERE month(period) NOT IN (5, 6))"
_GRID = _HOLED + """, grid AS (SELECT series, CAST(unnest(generate_series(min(period), max(period), INTERVAL 1 MONTH)) AS DATE) AS period FROM holed GROUP BY series),
  dense AS (SELECT grid.series, grid.period, value FROM grid LEFT JOIN holed ON grid.series = holed.series AND grid.period = holed.period)"""


def dense(spark, d):
    return R.densify(holed(spark, d), ["series"], "period")


@query("densify_calendar", f"WITH {_GRID} SELECT * FROM dense")
def densify_calendar(spark, d):
    return dense(spark, d)


@query("extend_live_row", f"WITH {_HOLED}, grid AS (SELECT series, CAST(unnest(generate_series(min(period), max(period) + INTERVAL 1 MONTH, INTERVAL 1 MONTH)) AS DATE) AS period FROM holed GROUP BY series) SELECT grid.series, grid.period, value FROM grid LEFT JOIN holed ON grid.series = holed.series AND grid.period = holed.period")
def extend_live_row(spark, d):
    return R.densify(holed(spark, d), ["series"], "period", extra=1)


@query("last_valid_period", f"WITH {MP_SQL} SELECT series, max(CASE WHEN n > 100 THEN period END) AS last_period, CAST(max(CASE WHEN n > 100 THEN period END) + INTERVAL 1 MONTH AS DATE) AS target_period FROM mp GROUP BY series")
def last_valid_period(spark, d):
    rows = monthly_panel(spark, d).withColumn("value", F.when(F.col("n") > 100, F.col("value")))
    return R.last_valid_period(rows, ["series"], "period", "value")


@query("top_k", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 25")
def top_k(spark, d):
    return table(spark, d, "orders").select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(25)


@query("argmax_row", "SELECT o_custkey, arg_max(o_orderkey, row(o_totalprice, o_orderkey)) AS best FROM orders GROUP BY o_custkey")
def argmax_row(spark, d):
    return table(spark, d, "orders").groupBy("o_custkey").agg(F.max_by("o_orderkey", F.struct("o_totalprice", "o_orderkey")).alias("best"))


# --- buckets; means are of whole cents, so they don't depend on order

_C = "CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) / 100.0 / count(*)"


def _cents(value="value"):
    return F.sum(F.round(F.col(value) * 100).cast("long")) / F.lit(100.0) / F.count("*")


def _events(spark, d):
    return table(spark, d, "events").select(F.col("event_type").alias("series"), F.to_date("ts").alias("day"), "value", "user_id", "event_id")


@query("weekly_to_monthly_mean", f"WITH w AS (SELECT event_type AS series, CAST(date_trunc('week', ts) AS DATE) + 6 AS week_end, {_C} AS value FROM events GROUP BY ALL) SELECT series, CAST(date_trunc('month', week_end) AS DATE) AS period, round(avg(value), 6) AS mean, count(*) AS weeks FROM w GROUP BY ALL")
def weekly_to_monthly_mean(spark, d):
    """Weeks count for the month they end in."""
    weeks = _events(spark, d).groupBy("series", F.date_add(F.trunc("day", "WEEK"), 6).alias("week_end")).agg(_cents().alias("value"))
    return weeks.groupBy("series", F.trunc("week_end", "MM").alias("period")).agg(F.round(F.avg("value"), 6).alias("mean"), F.count("*").alias("weeks"))


@query("daily_to_monthly_mean", f"SELECT event_type AS series, CAST(date_trunc('month', ts) AS DATE) AS period, {_C} AS mean FROM events GROUP BY ALL")
def daily_to_monthly_mean(spark, d):
    return _events(spark, d).groupBy("series", F.trunc("day", "MM").alias("period")).agg(_cents().alias("mean"))


@query("monthly_mean_complete", """WITH x AS (SELECT o_custkey % 40 AS series, CAST(o_orderdate AS DATE) AS day, CAST(round(o_totalprice) AS BIGINT) AS value FROM orders)
  SELECT series, CAST(date_trunc('month', day) AS DATE) AS period, CASE WHEN min(day(day)) <= 7 AND date_diff('day', max(day), last_day(min(day))) <= 6 THEN CAST(sum(value) AS DOUBLE) / count(*) END AS mean FROM x GROUP BY series, date_trunc('month', day)""")
def monthly_mean_complete(spark, d):
    rows = table(spark, d, "orders").select((F.col("o_custkey") % 40).alias("series"), F.to_date("o_orderdate").alias("day"), F.round("o_totalprice").cast("long").alias("value"))
    return R.complete_month_mean(rows, ["series"], "day", "value", 7)


@query("month_window_mean", f"SELECT event_type AS series, CAST(date_trunc('month', ts) AS DATE) AS period, {_C} AS mean FROM events WHERE day(ts) BETWEEN 5 AND 20 GROUP BY ALL")
def month_window_mean(spark, d):
    return R.month_window_mean(_events(spark, d), ["series"], "day", _cents(), 5, 20)


@query("survey_window_mean", f"""WITH x AS (SELECT event_type AS series, CAST(date_trunc('month', ts) AS DATE) AS period, value FROM events WHERE day(ts) <= 7
  UNION ALL SELECT event_type, CAST(date_trunc('month', ts) + INTERVAL 1 MONTH AS DATE), value FROM events WHERE day(ts) >= 25) SELECT series, period, {_C} AS mean FROM x GROUP BY ALL""")
def survey_window_mean(spark, d):
    return R.survey_window_mean(_events(spark, d), ["series"], "day", _cents())


@query("resample_week", f"SELECT event_type AS series, CAST(CAST(ts AS DATE) + CAST((8 - isodow(ts)) % 7 AS INTEGER) AS DATE) AS week, {_C} AS mean FROM events GROUP BY ALL")
def resample_week(spark, d):
    return _events(spark, d).groupBy("series", R.week_label(F.col("day")).alias("week")).agg(_cents().alias("mean"))


@query("month_sum", "SELECT o_orderstatus AS series, CAST(date_trunc('month', o_orderdate) AS DATE) AS period, CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) / 100.0 AS total FROM orders GROUP BY ALL")
def month_sum(spark, d):
    return table(spark, d, "orders").groupBy(F.col("o_orderstatus").alias("series"), F.trunc("o_orderdate", "MM").alias("period")).agg((F.sum(F.round(F.col("o_totalprice") * 100).cast("long")) / 100.0).alias("total"))


@query("count_weeks_in_month", """WITH w AS (SELECT o_orderpriority AS series, CAST(o_orderdate AS DATE) + CAST((13 - dayofweek(o_orderdate)) % 7 AS INTEGER) AS d FROM orders),
  c AS (SELECT series, CAST(date_trunc('month', d) AS DATE) AS period, count(DISTINCT d) AS k FROM w GROUP BY ALL),
  g AS (SELECT series, CAST(unnest(generate_series(min(period), max(period), INTERVAL 1 MONTH)) AS DATE) AS period FROM c GROUP BY series)
  SELECT g.series, g.period, coalesce(k, 4) AS weeks FROM g LEFT JOIN c ON g.series = c.series AND g.period = c.period""")
def count_weeks_in_month(spark, d):
    """Observed weeks by the Saturday they end on; a month without any counts 4."""
    days = table(spark, d, "orders").select(F.col("o_orderpriority").alias("series"), F.to_date("o_orderdate").alias("day"))
    return R.weeks_in_month(days, ["series"], "day").select("series", "period", "weeks")


@query("completeness", "SELECT o_custkey % 40 AS series, CAST(date_trunc('month', o_orderdate) AS DATE) AS period, least(count(DISTINCT CAST(o_orderdate AS DATE)) / 20.0, 1.0)::DOUBLE AS completeness FROM orders GROUP BY ALL")
def completeness(spark, d):
    rows = table(spark, d, "orders").select((F.col("o_custkey") % 40).alias("series"), F.to_date("o_orderdate").alias("day"))
    return R.completeness(rows, ["series"], "day", F.lit(20.0))


@query("component_sum", f"WITH {MP_SQL}, w AS (SELECT period, max(CASE WHEN series = '1-URGENT' THEN n END) AS a, max(CASE WHEN series = '2-HIGH' THEN n END) AS b, max(CASE WHEN series = '5-LOW' AND month(period) <> 2 THEN n END) AS c FROM mp GROUP BY period) SELECT period, a + b + c AS total FROM w")
def component_sum(spark, d):
    rows = monthly_panel(spark, d).where("NOT (series = '5-LOW' AND month(period) = 2)")
    return R.component_sum(rows, ["period"], "series", "n", ["1-URGENT", "2-HIGH", "5-LOW"])


@query("conditional_agg", "SELECT o_custkey, max(CASE WHEN o_orderstatus = 'O' THEN o_totalprice END) AS open_max, max(CASE WHEN o_orderstatus = 'P' THEN o_totalprice END) AS partial_max FROM orders GROUP BY o_custkey")
def conditional_agg(spark, d):
    s = F.col("o_orderstatus")
    return R.conditional_max(table(spark, d, "orders"), ["o_custkey"], {"open_max": s == "O", "partial_max": s == "P"}, F.col("o_totalprice"))


@query("ordered_array_first", "SELECT user_id, arg_max(value, row(ts, event_id)) AS last_value FROM events GROUP BY user_id")
def ordered_array_first(spark, d):
    return R.ordered_first(table(spark, d, "events"), ["user_id"], "value", ["ts", "event_id"], "last_value")


_SNAPSHOT_SQL = f"WITH {SN_SQL} SELECT day, count(*) AS members, CAST(sum(cents) AS BIGINT) AS cents FROM (SELECT DISTINCT day, member, survey_end, cents FROM sn) GROUP BY day HAVING count(*) >= 3"


@query("collect_snapshot", _SNAPSHOT_SQL)
def collect_snapshot(spark, d):
    """A day's members as a list, as long as their number allows one, and what is read from it."""
    rows = snapshots(spark, d).select("day", "member", "survey_end", "cents").distinct()
    lists = R.collect_snapshot(rows, "day", ["member", "survey_end", "cents"], most=1_000_000)
    return lists.select("day", F.size("members").cast("long").alias("members"), F.aggregate("members", F.lit(0).cast("long"), lambda a, m: a + m["cents"]).alias("cents"))


@query("snapshot_sizes", _SNAPSHOT_SQL)
def snapshot_sizes(spark, d):
    """The same without lists, for days of any size."""
    rows = snapshots(spark, d).select("day", "member", "survey_end", "cents").distinct()
    return R.snapshot_sizes(rows, "day", F.col("cents")).select("day", F.col("n").alias("members"), F.col("total").alias("cents"))


@query("published_or_mean", f"WITH {SN_SQL} SELECT day, coalesce(max(CASE WHEN member = 7 THEN cents END) / 100.0, round_even(CAST(sum(CASE WHEN member <> 7 THEN cents END) AS DOUBLE) / count(CASE WHEN member <> 7 THEN 1 END) / 100, 1)) AS average FROM sn GROUP BY day")
def published_or_mean(spark, d):
    """Member 7 stands for the published average; without it, the rounded mean of the members."""
    return R.published_or_mean(snapshots(spark, d), ["day"], F.col("member") == 7, F.col("cents"))


@query("first_seen", f"""WITH {SN_SQL} SELECT member, survey_end, min(day) AS first_seen, arg_min(CASE WHEN event_id % 2 = 0 THEN day END, row(CASE WHEN event_id % 2 = 0 THEN 0 ELSE 1 END, day)) AS released FROM sn GROUP BY member, survey_end""")
def first_seen(spark, d):
    return R.first_seen(snapshots(spark, d), ["member", "survey_end"], "day", F.when(F.col("event_id") % 2 == 0, F.col("day")))


@query("distinct_counts", "SELECT count(DISTINCT o_orderpriority) AS priorities, count(DISTINCT o_custkey) AS customers FROM orders")
def distinct_counts(spark, d):
    return table(spark, d, "orders").agg(F.count_distinct("o_orderpriority").alias("priorities"), F.count_distinct("o_custkey").alias("customers"))


@query("grouped_median", "SELECT o_orderpriority, median(o_totalprice) AS med FROM orders GROUP BY o_orderpriority")
def grouped_median(spark, d):
    return table(spark, d, "orders").groupBy("o_orderpriority").agg(F.median("o_totalprice").alias("med"))


@query("grouped_median_any_size", "SELECT l_returnflag, l_linestatus, median(l_extendedprice) AS med FROM lineitem GROUP BY ALL")
def grouped_median_any_size(spark, d):
    """The same for groups that no task could hold."""
    return selection.grouped_median(table(spark, d, "lineitem"), ["l_returnflag", "l_linestatus"], "l_extendedprice", scratch_path(spark, "median"), "med")


# --- point-in-time features on the dense grid

_S = P.Series(["series"], "period")
_W = "(PARTITION BY series ORDER BY period"


def _feature(name, columns, sql):
    """A query of feature columns, made by a function of the series and its value, rounded to 9 places on both sides."""
    text = ", ".join(f"round({s}, 9) AS {n}" for n, s in sql.items())

    @query(name, f"WITH {_GRID} SELECT series, period, {text} FROM dense")
    def run(spark, d):
        return dense(spark, d).select("series", "period", *[F.round(c, 9).alias(n) for n, c in columns(_S, F.col("value")).items()])

    return run


_feature("lag_lead", lambda s, v: {"lag1": s.lag(v), "lag3": s.lag(v, 3), "lead1": s.lead(v)}, {"lag1": f"lag(value) OVER {_W})", "lag3": f"lag(value, 3) OVER {_W})", "lead1": f"lead(value) OVER {_W})"})
_feature("diff_k", lambda s, v: {"d1": s.diff(v), "d12": s.diff(v, 12)}, {"d1": f"value - lag(value) OVER {_W})", "d12": f"value - lag(value, 12) OVER {_W})"})
_feature("dlog", lambda s, v: {"dlog": s.dlog(v)}, {"dlog": f"ln(value) - ln(lag(value) OVER {_W}))"})
_feature("pct_change", lambda s, v: {"pct": s.pct_change(v)}, {"pct": f"(value / lag(value) OVER {_W}) - 1) * 100"})
_feature("yoy", lambda s, v: {"yoy_log": s.dlog(v, 12), "yoy_pct": s.pct_change(v, 12)}, {"yoy_log": f"ln(value) - ln(lag(value, 12) OVER {_W}))", "yoy_pct": f"(value / lag(value, 12) OVER {_W}) - 1) * 100"})
_feature(
    "rolling_mean",
    lambda s, v: {"mean12": s.rolling_mean(v, 12, 9), "mean6": s.rolling_mean(v, 6, 4), "with_current": s.rolling_mean(v, 4, 1, current=True)},
    {
        "mean12": f"CASE WHEN count(value) OVER {_W} ROWS BETWEEN 12 PRECEDING AND 1 PRECEDING) >= 9 THEN avg(value) OVER {_W} ROWS BETWEEN 12 PRECEDING AND 1 PRECEDING) END",
        "mean6": f"CASE WHEN count(value) OVER {_W} ROWS BETWEEN 6 PRECEDING AND 1 PRECEDING) >= 4 THEN avg(value) OVER {_W} ROWS BETWEEN 6 PRECEDING AND 1 PRECEDING) END",
        "with_current": f"avg(value) OVER {_W} ROWS BETWEEN 3 PRECEDING AND CURRENT ROW)",
    },
)
_feature("expanding_mean", lambda s, v: {"mean": s.expanding_mean(v)}, {"mean": f"avg(value) OVER {_W} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"})
_SEASON = "avg(value) OVER (PARTITION BY series, month(period) ORDER BY period ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
_feature("seasonal_expanding_mean", lambda s, v: {"seasonal": s.seasonal_mean(v)}, {"seasonal": _SEASON})
_feature("deviation_from_norm", lambda s, v: {"deviation": s.deviation(v)}, {"deviation": f"value - {_SEASON}"})
_feature("ffill_limit", lambda s, v: {"filled": s.ffill(v, 1)}, {"filled": f"last_value(value IGNORE NULLS) OVER {_W} ROWS BETWEEN 1 PRECEDING AND CURRENT ROW)"})
_feature("ffill", lambda s, v: {"filled": s.ffill(v)}, {"filled": f"last_value(value IGNORE NULLS) OVER {_W} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"})
_feature("local_drift", lambda s, v: {"drift": s.local_drift(v)}, {"drift": "coalesce(" + ", ".join(f"(value - lag(value, {k}) OVER {_W})) / {k}" for k in range(14, 4, -1)) + ")"})
_feature("zscore_population", lambda s, v: {"z": s.zscore(v)}, {"z": "(value - avg(value) OVER (PARTITION BY series)) / stddev_pop(value) OVER (PARTITION BY series)"})
_BEFORE = f"OVER {_W} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
_feature("zscore_point_in_time", lambda s, v: {"z": s.zscore(v, True)}, {"z": f"CASE WHEN stddev_pop(value) {_BEFORE} > 0 THEN (value - avg(value) {_BEFORE}) / stddev_pop(value) {_BEFORE} END"})


@query("freshest_lag", f"WITH {_GRID} SELECT series, period, CAST(CASE " + " ".join(f"WHEN lag(value, {k}) OVER {_W}) IS NOT NULL AND lag(value, {k + 1}) OVER {_W}) IS NOT NULL THEN {k}" for k in range(8, 13)) + " END AS INTEGER) AS lag FROM dense")
def freshest_lag(spark, d):
    return dense(spark, d).select("series", "period", _S.freshest_lag(F.col("value"), range(8, 13)).alias("lag"))


@query("direction_label", f"WITH {_GRID} SELECT series, period, CAST(CASE WHEN value IS NOT NULL AND lead(value) OVER {_W}) IS NOT NULL THEN CASE WHEN lead(value) OVER {_W}) > value THEN 1 ELSE 0 END END AS INTEGER) AS label FROM dense")
def direction_label(spark, d):
    return dense(spark, d).select("series", "period", _S.direction_label(F.col("value")).alias("label"))


@query("last_n_as_of", f"WITH {MP_SQL} SELECT series, period, lag(n) OVER {_W}) AS a, lag(n, 2) OVER {_W}) AS b, lag(n, 3) OVER {_W}) AS c FROM mp QUALIFY row_number() OVER {_W}) > 3")
def last_n_as_of(spark, d):
    rows = _S.last_values(monthly_panel(spark, d), F.col("n"), 3).where("last is not null")
    return rows.select("series", "period", *[F.col("last")[i].alias(n) for i, n in enumerate("abc")])


@query("gap_aware_diff", "WITH x AS (SELECT user_id, CAST(ts AS DATE) AS day, max(value) AS value FROM events GROUP BY ALL) SELECT user_id, day, round(CASE WHEN date_diff('day', lag(day) OVER w, day) <= 3 THEN (value - lag(value) OVER w) / date_diff('day', lag(day) OVER w, day) END, 6) AS change FROM x WINDOW w AS (PARTITION BY user_id ORDER BY day)")
def gap_aware_diff(spark, d):
    s = P.Series(["user_id"], "day")
    rows = _events(spark, d).groupBy("user_id", "day").agg(F.max("value").alias("value"))
    return rows.select("user_id", "day", F.round(s.gap_aware_diff(F.col("value"), 3), 6).alias("change"))


@query("cointegration_gap", f"WITH {MP_SQL}, w AS (SELECT period, max(CASE WHEN series = '1-URGENT' THEN value END) AS a, max(CASE WHEN series = '5-LOW' THEN value END) AS b FROM mp GROUP BY period) SELECT period, round(lag(ln(a) - ln(b)) OVER (ORDER BY period), 6) AS gap FROM w")
def cointegration_gap(spark, d):
    wide = R.pivot_wide(monthly_panel(spark, d), ["period"], "series", "value", {"1-URGENT": "a", "5-LOW": "b"}).withColumn("pair", F.lit("urgent-low"))
    return wide.select("period", F.round(P.Series(["pair"], "period").cointegration_gap(F.col("a"), F.col("b")), 6).alias("gap"))


@query("row_mean", f"WITH {MP_SQL}, w AS (SELECT period, max(CASE WHEN series = '1-URGENT' THEN n END) AS a, max(CASE WHEN series = '2-HIGH' AND n > 30 THEN n END) AS b, max(CASE WHEN series = '5-LOW' AND month(period) > 2 THEN n END) AS c FROM mp GROUP BY period) SELECT period, round(list_avg([a, b, c]), 6) AS mean FROM w")
def row_mean(spark, d):
    from tidemark.functions.scalars import row_mean as mean

    rows = monthly_panel(spark, d).where("NOT (series = '2-HIGH' AND n <= 30) AND NOT (series = '5-LOW' AND month(period) <= 2)")
    wide = R.pivot_wide(rows, ["period"], "series", "n", {"1-URGENT": "a", "2-HIGH": "b", "5-LOW": "c"})
    periods = monthly_panel(spark, d).select("period").distinct().join(wide, "period", "left")
    return periods.select("period", F.round(mean([F.col("a"), F.col("b"), F.col("c")]), 6).alias("mean"))


@query("price_updated_weight", f"""WITH {MP_SQL}, base AS (SELECT series, value AS b FROM mp WHERE period = DATE '1997-01-01'),
  m AS (SELECT mp.series, mp.period, 10.0 * lag(mp.value) OVER (PARTITION BY mp.series ORDER BY mp.period) / b AS w FROM mp JOIN base ON mp.series = base.series)
  SELECT series, period, round(w / sum(w) OVER (PARTITION BY period), 6) AS share FROM m""")
def price_updated_weight(spark, d):
    rows = monthly_panel(spark, d).withColumn("weight", F.lit(10.0))
    return P.price_updated_weights(rows, "series", "period", "value", "weight", "1997-01-01").select("series", "period", F.round("share", 6).alias("share"))


@query("weighted_reconstruction", f"""WITH {MP_SQL}, base AS (SELECT series, value AS b FROM mp WHERE period = DATE '1997-01-01'),
  m AS (SELECT mp.series, mp.period, mp.value, lag(mp.value) OVER (PARTITION BY mp.series ORDER BY mp.period) AS l, b FROM mp JOIN base ON mp.series = base.series),
  s AS (SELECT period, l / b / sum(l / b) OVER (PARTITION BY period) * (value / l - 1) AS part FROM m)
  SELECT period, round(sum(part) * 100, 6) AS change FROM s GROUP BY period""")
def weighted_reconstruction(spark, d):
    """The total's change from shares and the components' changes."""
    rows = P.price_updated_weights(monthly_panel(spark, d).withColumn("weight", F.lit(1.0)), "series", "period", "value", "weight", "1997-01-01")
    parts = rows.withColumn("part", F.col("share") * (F.col("value") / _S.lag(F.col("value")) - 1))
    return parts.groupBy("period").agg(F.round(F.sum("part") * 100, 6).alias("change"))


@query("drop_incomplete", f"WITH {_GRID}, x AS (SELECT series, period, value, lag(value) OVER {_W}) AS l1, lead(value) OVER {_W}) AS y FROM dense) SELECT series, period FROM x WHERE value IS NOT NULL AND l1 IS NOT NULL AND y IS NOT NULL")
def drop_incomplete(spark, d):
    rows = dense(spark, d).withColumns({"l1": _S.lag(F.col("value")), "y": _S.lead(F.col("value"))})
    return rows.na.drop(subset=["value", "l1", "y"]).select("series", "period")


_GAPS = "days AS (SELECT DISTINCT user_id AS member, CAST(ts AS DATE) AS day FROM events WHERE event_type = 'purchase' OR event_type = 'signup'), gaps AS (SELECT member, day, date_diff('day', lag(day) OVER (PARTITION BY member ORDER BY day), day) AS gap FROM days)"


def _days(spark, d):
    return table(spark, d, "events").where("event_type IN ('purchase', 'signup')").select(F.col("user_id").alias("member"), F.to_date("ts").alias("day")).distinct()


@query("renewal_hazard", f"""WITH {_GAPS}, c AS (SELECT member, gap, count(*) AS n FROM gaps WHERE gap IS NOT NULL GROUP BY ALL), g AS (SELECT member, unnest(range(1, max(gap) + 1)) AS gap FROM c GROUP BY member),
  x AS (SELECT g.member, g.gap, coalesce(n, 0) AS n FROM g LEFT JOIN c ON g.member = c.member AND g.gap = c.gap)
  SELECT member, CAST(gap AS INTEGER) AS gap, n, CAST(sum(n) OVER (PARTITION BY member ORDER BY gap DESC) AS BIGINT) AS at_risk, CAST(n AS DOUBLE) / sum(n) OVER (PARTITION BY member ORDER BY gap DESC) AS hazard FROM x""")
def renewal_hazard(spark, d):
    return P.renewal_hazard(_days(spark, d), "member", "day")


@query("weekday_factor", f"WITH {_GAPS}, c AS (SELECT isodow(day) - 1 AS k, count(*) AS n FROM days GROUP BY 1), w AS (SELECT range AS k FROM range(7)) SELECT CAST(w.k AS INTEGER) AS weekday, coalesce(n, 0) AS n, least((coalesce(n, 0) + 1.0::DOUBLE) / (sum(coalesce(n, 0)) OVER () + 7.0::DOUBLE) * 7, 2.0::DOUBLE) AS factor FROM w LEFT JOIN c ON w.k = c.k")
def weekday_factor(spark, d):
    return P.weekday_factor(_days(spark, d), "day")


@query("house_offset", f"""WITH {SN_SQL}, truth AS (SELECT day, CAST(sum(cents) AS BIGINT) / 100.0 / count(*) AS truth FROM sn GROUP BY day),
  e AS (SELECT member, value - truth AS e FROM sn JOIN truth ON sn.day = truth.day), m AS (SELECT member, avg(e) AS o, count(*) AS n FROM e GROUP BY member),
  r AS (SELECT CASE WHEN count(*) > 5 THEN greatest(stddev_pop(e.e - m.o), 0.3) ELSE 1.0 END AS sd FROM e JOIN m ON e.member = m.member)
  SELECT member, round(o, 6) AS "offset", round(sd, 6)::DOUBLE AS residual_sd, n FROM m, r""")
def house_offset(spark, d):
    rows = snapshots(spark, d)
    truth = rows.groupBy("day").agg((F.sum("cents") / 100.0 / F.count("*")).alias("truth"))
    out = P.member_offsets(rows, truth, "member", "day", "value", "truth")
    return out.select("member", F.round("offset", 6).alias("offset"), F.round("residual_sd", 6).alias("residual_sd"), "n")


@query("active_members", f"WITH {_GAPS} SELECT member, median(gap) AS median_gap, CAST(date_diff('day', max(day), DATE '2024-01-31') AS INTEGER) AS idle FROM gaps GROUP BY member HAVING date_diff('day', max(day), DATE '2024-01-31') <= least(median(gap) * 3, 50)")
def active_members(spark, d):
    return P.active_members(_days(spark, d), "member", "day", "2024-01-31")
