"""Vintage tables, panels and snapshots derived from the order and event tables, and the same in DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import reshape as R


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


TIE = ["k1", "k2", "k3", "k4", "k6", "k5"]
BT_SQL = """bt AS (
  SELECT l_returnflag || l_linestatus AS series, CAST(date_trunc('month', l_shipdate) AS DATE) AS period,
    CAST(last_day(l_shipdate) + CAST(l_orderkey % 90 AS INTEGER) AS DATE) AS vintage, l_extendedprice AS value,
    l_orderkey AS k1, l_linenumber AS k2, l_partkey AS k3, l_suppkey AS k4, date_diff('day', DATE '1970-01-01', CAST(l_shipdate AS DATE)) AS k5,
    CAST(round(l_extendedprice * 100) AS BIGINT) AS k6, l_linestatus AS source FROM lineitem)"""


def bitemporal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """series, period, vintage, value, and k1..k6, which settle ties."""
    return vintages(table(spark, sf_dir, "lineitem")).drop("l_shipdate")


def vintages(lineitem: DataFrame) -> DataFrame:
    """The same of any table like ``lineitem``, a stream too, with its l_shipdate."""
    return lineitem.select(
        F.concat("l_returnflag", "l_linestatus").alias("series"),
        F.trunc("l_shipdate", "MM").alias("period"),
        F.date_add(F.last_day("l_shipdate"), (F.col("l_orderkey") % 90).cast("int")).alias("vintage"),
        F.col("l_extendedprice").alias("value"),
        F.col("l_orderkey").alias("k1"),
        F.col("l_linenumber").alias("k2"),
        F.col("l_partkey").alias("k3"),
        F.col("l_suppkey").alias("k4"),
        F.datediff(F.to_date("l_shipdate"), F.lit("1970-01-01").cast("date")).alias("k5"),
        F.round(F.col("l_extendedprice") * 100).cast("long").alias("k6"),
        F.col("l_linestatus").alias("source"),
        "l_shipdate",
    )


MP_SQL = """mp AS (
  SELECT o_orderpriority AS series, CAST(date_trunc('month', o_orderdate) AS DATE) AS period,
    CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) / 100000007.0 AS value, count(*) AS n FROM orders GROUP BY ALL)"""


def monthly_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders by priority and month: value in nearly millions, n. Sums are of whole cents, so they don't depend on order; the prime
    divisor keeps means off the ties that engines round apart."""
    return (
        table(spark, sf_dir, "orders")
        .groupBy(F.col("o_orderpriority").alias("series"), F.trunc("o_orderdate", "MM").alias("period"))
        .agg((F.sum(F.round(F.col("o_totalprice") * 100).cast("long")) / F.lit(100000007.0)).alias("value"), F.count("*").alias("n"))
    )


DS_SQL = """ds AS (
  SELECT event_type AS series, CAST(ts AS DATE) AS day, CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) / 100.0 / count(*) AS value, count(*) AS n
  FROM events GROUP BY ALL)"""


def daily_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "events")
        .groupBy(F.col("event_type").alias("series"), F.to_date("ts").alias("day"))
        .agg((F.sum(F.round(F.col("value") * 100).cast("long")) / F.lit(100.0) / F.count("*")).alias("value"), F.count("*").alias("n"))
    )


SN_SQL = """sn AS (
  SELECT CAST(ts AS DATE) AS day, user_id AS member, CAST(CAST(ts AS DATE) - CAST(user_id % 5 AS INTEGER) AS DATE) AS survey_end, event_id,
    event_type AS kind, CAST(round(value * 100) AS BIGINT) AS cents, value FROM events)"""


def snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.to_date("ts").alias("day"),
        F.col("user_id").alias("member"),
        F.date_sub(F.to_date("ts"), (F.col("user_id") % 5).cast("int")).alias("survey_end"),
        "event_id",
        F.col("event_type").alias("kind"),
        F.round(F.col("value") * 100).cast("long").alias("cents"),
        "value",
    )


UP_SQL = """target AS (
  SELECT CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_custkey END AS custkey, o_orderkey AS orderkey, o_orderstatus AS status, o_totalprice AS price
  FROM orders WHERE o_orderkey % 3 = 0),
staged AS (
  SELECT CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_custkey END AS custkey, o_orderkey AS orderkey, o_orderstatus AS status, o_totalprice + 1 AS price
  FROM orders WHERE o_orderkey % 2 = 0)"""


def upsert_pair(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    rows = table(spark, sf_dir, "orders").select(
        F.when(F.col("o_orderkey") % 7 != 0, F.col("o_custkey")).alias("custkey"),
        F.col("o_orderkey").alias("orderkey"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_totalprice").alias("price"),
    )
    return rows.where("orderkey % 3 = 0"), rows.where("orderkey % 2 = 0").withColumn("price", F.col("price") + 1)


PRIORITIES = {"1-URGENT": "a", "2-HIGH": "b", "3-MEDIUM": "c", "4-NOT SPECIFIED": "e", "5-LOW": "f"}
SG_SQL = f"""od AS (
  SELECT c_mktsegment AS series, o_orderpriority AS kind, CAST(o_orderdate AS DATE) AS day,
    CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS cents FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL),
sm AS (SELECT series, CAST(date_trunc('month', day) AS DATE) AS period, {", ".join(f"CAST(sum(CASE WHEN kind = '{k}' THEN cents END) AS BIGINT) / 100000007.0 AS {c}" for k, c in PRIORITIES.items())} FROM od GROUP BY ALL),
sg AS (SELECT g.series, g.period, {", ".join(PRIORITIES.values())} FROM (
  SELECT series, CAST(unnest(generate_series(min(period), max(period), INTERVAL 1 MONTH)) AS DATE) AS period FROM sm GROUP BY series) g
  LEFT JOIN sm ON sm.series = g.series AND sm.period = g.period)"""


def segment_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders by market segment (series), priority (kind) and day: cents."""
    orders = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    days = orders.groupBy(F.col("c_mktsegment").alias("series"), F.col("o_orderpriority").alias("kind"), F.to_date("o_orderdate").alias("day"))
    return days.agg(F.sum(F.round(F.col("o_totalprice") * 100).cast("long")).alias("cents"))


def segment_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per market segment and month, without gaps; a column for each priority."""
    days = segment_days(spark, sf_dir).withColumn("period", F.trunc("day", "MM"))
    months = days.groupBy("series", "period", "kind").agg((F.sum("cents") / F.lit(100000007.0)).alias("value"))
    return R.densify(R.pivot_wide(months, ["series", "period"], "kind", "value", PRIORITIES), ["series"], "period")
