"""Registered queries over the given tables, each with the same query in DuckDB SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import scalars as S
from tidemark.operators import vintage as V
from tidemark.plans.fixtures import (
    BT_SQL, MP_SQL, TIE, UP_SQL, bitemporal, monthly_panel, table, upsert_pair,
)
from tidemark.sources import tables as L
from tidemark.sources.versioned import VersionedTable

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(f):
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f

    return register


_TIE = ", ".join(TIE)
_DESC = ", ".join(f"{c} DESC" for c in ["vintage", *TIE])
_ASC = ", ".join(["vintage", *TIE])

# --- vintage reads


@query("latest_vintage", f"WITH {BT_SQL} SELECT series, period, vintage, value FROM bt QUALIFY row_number() OVER (PARTITION BY series, period ORDER BY {_DESC}) = 1")
def latest_vintage(spark, d):
    return V.latest_vintage(bitemporal(spark, d), ["series", "period"], ["vintage", *TIE]).select("series", "period", "vintage", "value")


@query("latest_vintage_window", f"WITH {BT_SQL} SELECT series, period, vintage, value FROM bt QUALIFY row_number() OVER (PARTITION BY series, period ORDER BY {_DESC}) = 1")
def latest_vintage_window(spark, d):
    """The same by a window: Spark has no QUALIFY."""
    order = [F.desc(c) for c in ["vintage", *TIE]]
    return V.latest_by_window(bitemporal(spark, d), ["series", "period"], order).select("series", "period", "vintage", "value")


@query("latest_vintage_multi_order", f"WITH {BT_SQL} SELECT series, period, vintage, value FROM bt QUALIFY row_number() OVER (PARTITION BY series, period ORDER BY vintage DESC, {_TIE}) = 1")
def latest_vintage_multi_order(spark, d):
    return V.latest_by_window(bitemporal(spark, d), ["series", "period"], [F.desc("vintage"), *map(F.asc, TIE)]).select("series", "period", "vintage", "value")


@query("first_print", f"WITH {BT_SQL} SELECT series, period, vintage, value FROM bt QUALIFY row_number() OVER (PARTITION BY series, period ORDER BY {_ASC}) = 1")
def first_print(spark, d):
    return V.first_print(bitemporal(spark, d), ["series", "period"], ["vintage", *TIE]).select("series", "period", "vintage", "value")


_ORIGINS = ["1996-01-15", "1997-07-15", "1998-01-15", "1999-06-30", "2000-12-31"]


def origins_table(spark, dates=_ORIGINS):
    return spark.createDataFrame([(x,) for x in dates], "origin string").select(F.col("origin").cast("date").alias("origin"))


def _origins_sql(dates=_ORIGINS):
    return "origins AS (SELECT CAST(o AS DATE) AS origin FROM (VALUES " + ", ".join(f"('{x}')" for x in dates) + ") AS t(o))"


_KNOWN = ", ".join(f"CASE WHEN vintage <= origin THEN {c} ELSE -{c} END DESC" for c in TIE)


def _as_of_sql(limit="origin", origins=_ORIGINS, select="origin, series, period, vintage, value"):
    return f"""WITH {BT_SQL}, {_origins_sql(origins)} SELECT {select} FROM bt JOIN origins ON period <= {limit}
    QUALIFY row_number() OVER (PARTITION BY origin, series, period ORDER BY vintage <= origin DESC,
      CASE WHEN vintage <= origin THEN date_diff('day', DATE '1970-01-01', vintage) ELSE -date_diff('day', DATE '1970-01-01', vintage) END DESC, {_KNOWN}) = 1"""


@query("as_of_many", _as_of_sql())
def as_of_many(spark, d):
    return V.as_of_many(bitemporal(spark, d), origins_table(spark), ["series", "period"], "period", "vintage", TIE).select("origin", "series", "period", "vintage", "value")


@query("as_of", _as_of_sql(origins=["1998-01-15"], select="series, period, vintage, value"))
def as_of(spark, d):
    return V.as_of(bitemporal(spark, d), "1998-01-15", ["series", "period"], "period", "vintage", TIE).select("series", "period", "vintage", "value")


@query("as_of_latest", f"WITH {BT_SQL} SELECT series, period, vintage, value FROM bt WHERE period <= DATE '1998-01-15' QUALIFY row_number() OVER (PARTITION BY series, period ORDER BY {_DESC}) = 1")
def as_of_latest(spark, d):
    """Vintages set aside: the latest value of the periods up to the origin."""
    out = V.as_of(bitemporal(spark, d), "1998-01-15", ["series", "period"], "period", "vintage", TIE, use_vintages=False)
    return out.select("series", "period", "vintage", "value")


@query("known_ahead", _as_of_sql(limit="origin + INTERVAL 3 MONTH"))
def known_ahead(spark, d):
    out = V.as_of_many(bitemporal(spark, d), origins_table(spark), ["series", "period"], "period", "vintage", TIE, ahead_months=3)
    return out.select("origin", "series", "period", "vintage", "value")


@query("as_of_released", f"""WITH {BT_SQL} SELECT series, period, vintage, value FROM bt WHERE vintage <= DATE '1999-06-30'
  AND period + INTERVAL 1 MONTH + CAST((12 - dayofweek(period + INTERVAL 1 MONTH)) % 7 AS INTEGER) * INTERVAL 1 DAY <= DATE '1999-06-30'
  QUALIFY row_number() OVER (PARTITION BY series, period ORDER BY {_DESC}) = 1""")
def as_of_released(spark, d):
    """Released on the first Friday of the next month."""
    released = S.nth_weekday(F.add_months("period", 1), "FRI")
    return V.as_of_released(bitemporal(spark, d), "1999-06-30", ["series", "period"], ["vintage", *TIE], "vintage", released).select("series", "period", "vintage", "value")


@query("source_fallback", f"""WITH {BT_SQL}, latest AS (SELECT * FROM bt WHERE NOT (source = 'F' AND month(period) = 3) QUALIFY row_number() OVER (PARTITION BY series, period ORDER BY {_DESC}) = 1)
  SELECT period, coalesce(max(CASE WHEN source = 'F' THEN value END), max(CASE WHEN source <> 'F' THEN value END)) AS value FROM latest GROUP BY period""")
def source_fallback(spark, d):
    rows = bitemporal(spark, d).where(~((F.col("source") == "F") & (F.month("period") == 3)))
    return V.source_fallback(V.latest_vintage(rows, ["series", "period"], ["vintage", *TIE]), ["period"], "source", "F", "value")


@query("latest_group_filter", "SELECT o_orderkey, o_totalprice FROM orders WHERE year(o_orderdate) = (SELECT max(year(o_orderdate)) FROM orders)")
def latest_group_filter(spark, d):
    rows = table(spark, d, "orders").withColumn("y", F.year("o_orderdate"))
    return V.latest_group_filter(rows, "y").select("o_orderkey", "o_totalprice")


_FC_SQL = """fc AS (SELECT o_orderpriority AS target, CAST(date_trunc('month', o_orderdate) AS DATE) AS target_month, 'v' || (o_custkey % 3) AS model_version,
  CAST(o_orderdate AS DATE) AS as_of_date, o_orderkey AS generated, o_totalprice AS forecast FROM orders)"""


def forecasts(spark, d):
    return table(spark, d, "orders").select(
        F.col("o_orderpriority").alias("target"),
        F.trunc("o_orderdate", "MM").alias("target_month"),
        F.concat(F.lit("v"), F.col("o_custkey") % 3).alias("model_version"),
        F.to_date("o_orderdate").alias("as_of_date"),
        F.col("o_orderkey").alias("generated"),
        F.col("o_totalprice").alias("forecast"),
    )


@query("current_view", f"""WITH {_FC_SQL} SELECT target, target_month, model_version, as_of_date, generated, forecast FROM fc WHERE model_version <> 'v0'
  QUALIFY row_number() OVER (PARTITION BY target, target_month, model_version ORDER BY as_of_date DESC, generated DESC) = 1""")
def current_view(spark, d):
    return V.current_view(forecasts(spark, d), ["target", "target_month", "model_version"], ["as_of_date", "generated"], F.col("model_version") != "v0")


@query("current_generation", f"WITH {_FC_SQL} SELECT target, generated, forecast FROM fc WHERE as_of_date = (SELECT max(as_of_date) FROM fc)")
def current_generation(spark, d):
    return V.latest_group_filter(forecasts(spark, d), "as_of_date").select("target", "generated", "forecast")


@query("current_slice_join", f"""WITH {_FC_SQL}, top AS (SELECT target, max(as_of_date) AS m FROM fc GROUP BY target)
  SELECT fc.target, fc.as_of_date, fc.generated, fc.forecast FROM fc JOIN top ON fc.target = top.target AND as_of_date = m""")
def current_slice_join(spark, d):
    return V.current_slice(forecasts(spark, d), ["target"], "as_of_date").select("target", "as_of_date", "generated", "forecast")


@query("revision_summary", f"""WITH {BT_SQL} SELECT series, period, first_value, latest_value, n_vintages, n_rows, latest_value - first_value AS revision FROM (
  SELECT series, period, arg_min(value, row(vintage, {_TIE})) AS first_value, arg_max(value, row(vintage, {_TIE})) AS latest_value,
    count(DISTINCT vintage) AS n_vintages, count(*) AS n_rows FROM bt GROUP BY series, period)""")
def revision_summary(spark, d):
    return V.revision_summary(bitemporal(spark, d), ["series", "period"], ["vintage", *TIE], "vintage", "value")


@query("stage_revision", """WITH x AS (SELECT event_type AS kind, CAST(ts AS DATE) AS day, CASE WHEN hour(ts) < 12 THEN 'prelim' ELSE 'final' END AS stage, CAST(sum(CAST(round(value * 100) AS BIGINT)) AS DOUBLE) AS v
    FROM events GROUP BY ALL), w AS (SELECT kind, day, max(CASE WHEN stage = 'prelim' THEN v END) AS prelim, max(CASE WHEN stage = 'final' THEN v END) AS final FROM x GROUP BY kind, day)
  SELECT kind, day, prelim, final, final - prelim AS stage_revision FROM w""")
def stage_revision(spark, d):
    rows = table(spark, d, "events").groupBy(
        F.col("event_type").alias("kind"), F.to_date("ts").alias("day"), F.when(F.hour("ts") < 12, "prelim").otherwise("final").alias("stage")
    ).agg(F.sum(F.round(F.col("value") * 100).cast("long")).cast("double").alias("v"))
    return V.stage_revision(rows, ["kind", "day"], "stage", "v", "prelim", "final")


# --- loading and maintenance


@query("upsert", f"""WITH {UP_SQL} SELECT * FROM target t WHERE NOT EXISTS (SELECT 1 FROM staged s WHERE s.custkey IS NOT DISTINCT FROM t.custkey AND s.orderkey IS NOT DISTINCT FROM t.orderkey)
  UNION ALL SELECT * FROM staged""")
def upsert(spark, d):
    return L.upsert(*upsert_pair(spark, d), ["custkey", "orderkey"])


def _versioned(spark, rows, by, name):
    """The rows as a table that changes in place, loaded twice by one run."""
    held = VersionedTable.create(spark, scratch_path(spark, name), rows.schema, by, 16)
    for _ in range(2):
        held.replace_slice(rows, by, run="load")
    return held


@query("versioned_upsert", ORACLES["upsert"])
def versioned_upsert(spark, d):
    """The same written in place: parts that the staged rows touch, one rename, and a retry that changes nothing."""
    target, staged = upsert_pair(spark, d)
    held = _versioned(spark, target, ["orderkey"], "upsert")
    for _ in range(2):
        held.upsert(staged, ["custkey", "orderkey"], run="merge")
    return held.read()


@query("anti_self", f"WITH {UP_SQL} SELECT * FROM target t WHERE NOT EXISTS (SELECT 1 FROM staged s WHERE s.custkey IS NOT DISTINCT FROM t.custkey AND s.orderkey IS NOT DISTINCT FROM t.orderkey)")
def anti_self(spark, d):
    target, staged = upsert_pair(spark, d)
    return L.anti_self(target, staged, ["custkey", "orderkey"])


@query("dedupe_last", "SELECT o_custkey, o_orderkey, o_totalprice FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1")
def dedupe_last(spark, d):
    return L.dedupe_last(table(spark, d, "orders"), ["o_custkey"], ["o_orderdate", "o_orderkey"]).select("o_custkey", "o_orderkey", "o_totalprice")


@query("dedupe_first", "SELECT o_custkey, o_orderkey, o_totalprice FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) = 1")
def dedupe_first(spark, d):
    return L.dedupe_first(table(spark, d, "orders"), ["o_custkey"], ["o_orderdate", "o_orderkey"]).select("o_custkey", "o_orderkey", "o_totalprice")


@query("replace_slice", """SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderstatus <> 'P'
  UNION ALL SELECT o_orderkey, o_orderstatus, o_totalprice * 2 FROM orders WHERE o_orderstatus = 'P' AND o_orderkey % 2 = 0""")
def replace_slice(spark, d):
    target = table(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    rows = target.where("o_orderstatus = 'P' AND o_orderkey % 2 = 0").withColumn("o_totalprice", F.col("o_totalprice") * 2)
    return L.replace_slice(target, rows, ["o_orderstatus"])


@query("versioned_replace_slice", ORACLES["replace_slice"])
def versioned_replace_slice(spark, d):
    """A retry without a run's id: the slice is dropped and added again."""
    target = table(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    held = _versioned(spark, target, ["o_orderstatus"], "slice")
    rows = target.where("o_orderstatus = 'P' AND o_orderkey % 2 = 0").withColumn("o_totalprice", F.col("o_totalprice") * 2)
    for _ in range(2):
        held.replace_slice(rows, ["o_orderstatus"])
    return held.read()


@query("update_columns", """SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 5 = 0 THEN 'X' ELSE o_orderstatus END AS o_orderstatus FROM orders""")
def update_columns(spark, d):
    target = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    patch = target.where("o_orderkey % 5 = 0").select("o_orderkey", F.lit("X").alias("o_orderstatus"))
    return L.update_columns(target, patch, ["o_orderkey"], ["o_orderstatus"])


@query("versioned_update_columns", ORACLES["update_columns"])
def versioned_update_columns(spark, d):
    target = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    held = _versioned(spark, target, ["o_orderkey"], "update")
    held.update_columns(target.where("o_orderkey % 5 = 0").select("o_orderkey", F.lit("X").alias("o_orderstatus")), ["o_orderkey"], ["o_orderstatus"], run="patch")
    return held.read()


@query("backfill_stamp", "SELECT o_orderkey, coalesce(CASE WHEN o_orderkey % 2 = 0 THEN 'v2' END, 'v1') AS model_version FROM orders")
def backfill_stamp(spark, d):
    rows = table(spark, d, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 2 == 0, "v2").alias("model_version"))
    return L.backfill(rows, "model_version", "v1")


@query("vintage_loaded", f"WITH {BT_SQL} SELECT vintage, count(*) AS n FROM bt WHERE vintage NOT IN (SELECT vintage FROM bt WHERE period < DATE '1998-01-01') GROUP BY vintage")
def vintage_loaded(spark, d):
    rows = bitemporal(spark, d)
    return L.new_vintages(rows, rows.where("period < '1998-01-01'"), "vintage").groupBy("vintage").agg(F.count("*").alias("n"))


@query("normalize_wide_to_long", """SELECT p_partkey, measure, value FROM (SELECT p_partkey, 'size' AS measure, CASE WHEN p_size > 10 THEN CAST(p_size AS DOUBLE) END AS value FROM part
  UNION ALL SELECT p_partkey, 'price', p_retailprice FROM part) WHERE value IS NOT NULL""")
def normalize_wide_to_long(spark, d):
    wide = table(spark, d, "part").select("p_partkey", F.when(F.col("p_size") > 10, F.col("p_size").cast("double")).alias("size"), F.col("p_retailprice").alias("price"))
    return L.wide_to_long(wide, ["p_partkey"], ["size", "price"])


@query("normalize_nested", """WITH m AS (SELECT event_type AS series_id, count(*) AS series_rows FROM events WHERE event_type <> 'error' GROUP BY 1)
  SELECT event_id, event_type AS series_id, CAST(ts AS DATE) + k AS period, CASE WHEN k = 0 THEN round(value, 2) ELSE CAST(json_extract(props, '$.k') AS DOUBLE) END AS value, series_rows
  FROM events CROSS JOIN (SELECT CAST(range AS INTEGER) AS k FROM range(2)) LEFT JOIN m ON m.series_id = event_type""")
def normalize_nested(spark, d):
    """A feed's payload of series and their points to rows, with what the metadata knows of each series."""
    events = table(spark, d, "events")
    day = F.to_date("ts")
    k = F.from_json("props", "k double")["k"]
    points = F.array(F.struct(day.alias("period"), F.round("value", 2).alias("value")), F.struct(F.date_add(day, 1).alias("period"), k.alias("value")))
    payload = F.to_json(F.struct(F.array(F.struct(F.col("event_type").alias("id"), points.alias("points"))).alias("series")))
    metadata = events.where("event_type <> 'error'").groupBy(F.col("event_type").alias("series_id")).agg(F.count("*").alias("series_rows"))
    return L.nested_points(events.select("event_id", payload.alias("payload")), ["event_id"], "payload", metadata).select("event_id", "series_id", "period", "value", "series_rows")


@query("release_gate", f"WITH {MP_SQL} SELECT series, period, value FROM mp WHERE period <= (SELECT max(period) - INTERVAL 1 MONTH FROM mp)")
def release_gate(spark, d):
    rows = monthly_panel(spark, d)
    return L.release_gate(rows, "period", rows.agg(F.add_months(F.max("period"), -1).alias("cutoff"))).select("series", "period", "value")


@query("optional_input", f"WITH {MP_SQL} SELECT series, count(*) AS n, CAST(NULL AS DOUBLE) AS extra FROM mp GROUP BY series")
def optional_input(spark, d):
    schema = "series string, extra double"
    from pyspark.sql.types import StructType

    extra = L.optional_input(spark, f"{d}/no_such_table.parquet", StructType.fromDDL(schema))
    return monthly_panel(spark, d).join(extra, "series", "left").groupBy("series").agg(F.count("*").alias("n"), F.max("extra").alias("extra"))


@query("load_append", """SELECT o_orderkey, o_totalprice, CASE WHEN o_orderkey % 2 = 0 THEN 'run-1' ELSE 'run-2' END AS ingestion_run_id,
  CASE WHEN o_orderkey % 2 = 0 THEN TIMESTAMP '2024-01-01 00:00:00' ELSE TIMESTAMP '2024-01-02 00:00:00' END AS ingested_at FROM orders""")
def load_append(spark, d):
    """Two runs and an empty third one, appended to a table and read back."""
    from pyspark.sql.types import StructType

    path = scratch_path(spark, "append")
    rows = table(spark, d, "orders").select("o_orderkey", "o_totalprice")
    spec = L.TableSpec("orders", StructType.fromDDL("o_orderkey bigint not null, o_totalprice double"))
    L.load_append(rows.where("o_orderkey % 2 = 0"), spec, path, "2024-01-01", "run-1")
    L.load_append(rows.where("o_orderkey % 2 = 1"), spec, path, "2024-01-02", "run-2")
    L.load_append(rows.where("false"), spec, path, "2024-01-03", "run-3")
    return spark.read.parquet(path)


@query("raw_archive", "SELECT event_id, event_type, value, CAST(CASE WHEN event_id % 2 = 0 THEN '2024-01-01' ELSE '2024-01-02' END AS DATE) AS dt FROM events")
def raw_archive(spark, d):
    """JSON lines under dt=..., read back with the date discovered from the path."""
    from pyspark.sql.types import StructType

    path = scratch_path(spark, "raw")
    rows = table(spark, d, "events").select("event_id", "event_type", "value")
    L.raw_archive(rows.where("event_id % 2 = 0"), path, "2024-01-01")
    L.raw_archive(rows.where("event_id % 2 = 1"), path, "2024-01-02")
    return L.read_archive(spark, StructType.fromDDL("event_id bigint, event_type string, value double, dt date"), path)


def scratch_path(spark, name: str) -> str:
    """A new path in the shared folder of spark.checkpoint.dir; a temporary folder only where that is unset and all runs on one machine."""
    import tempfile
    import uuid

    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
        base = "file://" + tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


@query("read_csv", "SELECT c_custkey, c_name, c_acctbal FROM customer")
def read_csv(spark, d):
    path = scratch_path(spark, "csv")
    table(spark, d, "customer").select("c_custkey", "c_name", "c_acctbal").write.csv(path, header=True)
    return spark.read.schema("c_custkey bigint, c_name string, c_acctbal double").csv(path, header=True, mode="FAILFAST")


# --- scalar functions

_FILTER = "o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate < TIMESTAMP '1998-01-01' AND o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_totalprice BETWEEN 1000 AND 200000 AND o_custkey IS NOT NULL"


@query("filters", f"SELECT o_orderkey, o_totalprice FROM orders WHERE {_FILTER}")
def filters(spark, d):
    o = table(spark, d, "orders")
    when = (F.col("o_orderdate") >= F.lit("1996-01-01").cast("timestamp_ntz")) & (F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz"))
    return o.where(when & F.col("o_orderpriority").isin("1-URGENT", "2-HIGH") & F.col("o_totalprice").between(1000, 200000) & F.col("o_custkey").isNotNull()).select("o_orderkey", "o_totalprice")


@query("mask_period", f"WITH {MP_SQL} SELECT series, period, CASE WHEN period BETWEEN DATE '1997-03-01' AND DATE '1998-06-01' THEN NULL ELSE value END AS value FROM mp")
def mask_period(spark, d):
    return monthly_panel(spark, d).select("series", "period", F.when(~S.in_period(F.col("period"), "1997-03-01", "1998-06-01"), F.col("value")).alias("value"))


@query("parse_double", """SELECT o_orderkey, TRY_CAST(replace(trim(CASE o_orderkey % 4 WHEN 0 THEN '-' WHEN 1 THEN '(S)' WHEN 2 THEN '1,' || CAST(o_orderkey AS VARCHAR) ELSE CAST(o_orderkey AS VARCHAR) || '.5 ' END), ',', '') AS DOUBLE) AS x FROM orders""")
def parse_double(spark, d):
    k = F.col("o_orderkey")
    text = F.when(k % 4 == 0, "-").when(k % 4 == 1, "(S)").when(k % 4 == 2, F.concat(F.lit("1,"), k.cast("string"))).otherwise(F.concat(k.cast("string"), F.lit(".5 ")))
    return table(spark, d, "orders").select("o_orderkey", S.parse_double(text).alias("x"))


@query("parse_dates", """SELECT o_orderkey, CASE o_orderkey % 6 WHEN 0 THEN CAST(o_orderdate AS DATE) WHEN 1 THEN CAST(o_orderdate AS DATE) WHEN 2 THEN CAST(o_orderdate AS DATE)
  WHEN 3 THEN CAST(date_trunc('month', o_orderdate) AS DATE) WHEN 4 THEN CAST(date_trunc('quarter', o_orderdate) AS DATE) ELSE NULL END AS day FROM orders""")
def parse_dates(spark, d):
    k, t = F.col("o_orderkey") % 6, F.col("o_orderdate")
    text = (
        F.when(k == 0, F.date_format(t, "yyyy-MM-dd")).when(k == 1, F.date_format(t, "yyyy/MM/dd")).when(k == 2, F.date_format(t, "M/d/yyyy"))
        .when(k == 3, F.date_format(t, "yyyy'M'MM")).when(k == 4, F.concat(F.year(t), F.lit("q"), F.quarter(t))).otherwise(F.concat(F.year(t), F.lit("M13")))
    )
    return table(spark, d, "orders").select("o_orderkey", S.parse_date(text).alias("day"))


@query("fix_two_digit_year", "SELECT o_orderkey, CASE WHEN year(x) >= 2050 THEN CAST(x - INTERVAL 100 YEAR AS DATE) ELSE x END AS day FROM (SELECT o_orderkey, CAST(CAST(date_trunc('month', o_orderdate) AS DATE) + CAST(o_orderkey % 2 * 60 AS INTEGER) * INTERVAL 1 YEAR AS DATE) AS x FROM orders)")
def fix_two_digit_year(spark, d):
    day = F.add_months(F.trunc("o_orderdate", "MM"), (F.col("o_orderkey") % 2 * 720).cast("int"))
    return table(spark, d, "orders").select("o_orderkey", S.fix_two_digit_year(day).alias("day"))


@query("split_sample", "SELECT o_orderkey, o_custkey AS size, upper(substr(o_orderpriority, 3, 2)) AS kind FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')")
def split_sample(spark, d):
    o = table(spark, d, "orders").where(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"))
    size, kind = S.split_sample(F.concat_ws(" ", F.col("o_custkey").cast("string"), F.lower(F.substring("o_orderpriority", 3, 2))))
    return o.select("o_orderkey", size.alias("size"), kind.alias("kind"))


@query("string_ops", """SELECT o_orderkey, 'p_' || replace(substr(o_orderpriority, 3), ' ', '_') AS name, concat_ws('; ', CASE WHEN o_orderstatus = 'P' THEN 'partial' END, CASE WHEN o_totalprice > 200000 THEN 'large' END) AS notes,
  CASE o_orderstatus WHEN 'P' THEN 'pending' WHEN 'O' THEN 'open' WHEN 'F' THEN 'filled' END AS status, replace('A &amp; B', '&amp;', '&') AS plain FROM orders""")
def string_ops(spark, d):
    names = F.create_map(*[F.lit(x) for x in ("P", "pending", "O", "open", "F", "filled")])
    notes = F.array(F.when(F.col("o_orderstatus") == "P", "partial"), F.when(F.col("o_totalprice") > 200000, "large"))
    return table(spark, d, "orders").select(
        "o_orderkey",
        F.concat(F.lit("p_"), F.replace(F.substring("o_orderpriority", 3, 99), F.lit(" "), F.lit("_"))).alias("name"),
        F.array_join(F.filter(notes, lambda x: x.isNotNull()), "; ").alias("notes"),
        names[F.col("o_orderstatus")].alias("status"),
        F.replace(F.lit("A &amp; B"), F.lit("&amp;"), F.lit("&")).alias("plain"),
    )


@query("math", """SELECT o_orderkey, round(ln(o_totalprice), 8) AS log_x, round(ln(1 + o_totalprice / 1e6), 8) AS log1p_x, round(exp(o_totalprice / 1e6), 8) AS exp_x, round(exp(o_totalprice / 1e6) - 1, 8) AS expm1_x,
  abs(o_totalprice - 200000) AS abs_x, round(pow(o_totalprice / 1e5, 2), 8) AS pow_x, round(sqrt(o_totalprice), 8) AS sqrt_x, CAST(sign(o_totalprice - 200000) AS DOUBLE) AS sign_x,
  CAST(floor(o_totalprice / 1000) AS BIGINT) AS floor_x, greatest(least(o_totalprice, 300000.0), 50000.0) AS clip_x FROM orders""")
def math_functions(spark, d):
    x = F.col("o_totalprice")
    return table(spark, d, "orders").select(
        "o_orderkey", F.round(F.ln(x), 8).alias("log_x"), F.round(F.log1p(x / 1e6), 8).alias("log1p_x"), F.round(F.exp(x / 1e6), 8).alias("exp_x"), F.round(F.expm1(x / 1e6), 8).alias("expm1_x"),
        F.abs(x - 200000).alias("abs_x"), F.round(F.pow(x / 1e5, F.lit(2.0)), 8).alias("pow_x"), F.round(F.sqrt(x), 8).alias("sqrt_x"), F.signum(x - 200000).alias("sign_x"),
        F.floor(x / 1000).alias("floor_x"), S.clip(x, 50000.0, 300000.0).alias("clip_x"),
    )


@query("round_half_even", "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, round_even(l_quantity / 2, 0) AS q, round_even(l_quantity / 4, 1) AS r FROM lineitem")
def round_half_even(spark, d):
    q = F.col("l_quantity")
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", S.round_half_even(q / 2).alias("q"), S.round_half_even(q / 4, 1).alias("r"))


@query("rescale_diffusion", "SELECT event_id, 50.0 + value / 2 AS index_value, 50 - value AS deviation, (value - 50) / 100 AS scaled FROM events")
def rescale_diffusion(spark, d):
    v = F.col("value")
    return table(spark, d, "events").select("event_id", S.balance_to_index(v).alias("index_value"), (50 - v).alias("deviation"), ((v - 50) / 100).alias("scaled"))


@query("split_pos_neg", "SELECT event_id, CASE WHEN x > 0 THEN x ELSE 0.0 END AS pos, CASE WHEN x < 0 THEN x ELSE 0.0 END AS neg FROM (SELECT event_id, value - 20 AS x FROM events)")
def split_pos_neg(spark, d):
    x = F.col("value") - 20
    return table(spark, d, "events").select("event_id", S.positive_part(x).alias("pos"), S.negative_part(x).alias("neg"))


@query("date_arith", """SELECT o_orderkey, CAST(x + 6 AS DATE) AS saturday, CAST(x - 30 AS DATE) AS earlier, CAST(date_diff('day', x, DATE '2002-01-01') AS BIGINT) AS days, CAST(date_trunc('quarter', x) AS DATE) AS q, strftime(x, '%Y-%m') AS ym
  FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS x FROM orders)""")
def date_arith(spark, d):
    x = F.to_date("o_orderdate")
    return table(spark, d, "orders").select(
        "o_orderkey", F.date_add(x, 6).alias("saturday"), F.date_sub(x, 30).alias("earlier"), F.datediff(F.lit("2002-01-01").cast("date"), x).cast("long").alias("days"), F.trunc(x, "QUARTER").alias("q"), F.date_format(x, "yyyy-MM").alias("ym")
    )


@query("epoch_to_local_date", "SELECT event_id, CAST(ts - INTERVAL 5 HOUR AS DATE) AS local_date FROM events")
def epoch_to_local_date(spark, d):
    """January: New York is five hours behind throughout."""
    seconds = F.unix_timestamp(F.col("ts").cast("timestamp"))
    return table(spark, d, "events").select("event_id", S.epoch_to_local_date(seconds, "America/New_York").alias("local_date"))


@query("coalesce_first", "SELECT o_orderkey, coalesce(CASE WHEN o_orderkey % 3 = 0 THEN o_totalprice END, CAST(o_custkey AS DOUBLE)) AS x FROM orders")
def coalesce_first(spark, d):
    return table(spark, d, "orders").select("o_orderkey", F.coalesce(F.when(F.col("o_orderkey") % 3 == 0, F.col("o_totalprice")), F.col("o_custkey").cast("double")).alias("x"))


@query("safe_ratio", "SELECT o_orderkey, CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE o_totalprice / (o_orderkey % 10) END AS ratio, o_totalprice / (o_custkey / 12.0) AS months_supply FROM orders WHERE o_custkey > 0")
def safe_ratio(spark, d):
    o = table(spark, d, "orders").where("o_custkey > 0")
    return o.select("o_orderkey", S.safe_ratio(F.col("o_totalprice"), (F.col("o_orderkey") % 10).cast("double")).alias("ratio"), S.safe_ratio(F.col("o_totalprice"), F.col("o_custkey") / 12).alias("months_supply"))


@query("calendar_parts", "SELECT o_orderkey, CAST(month(o_orderdate) AS BIGINT) AS m, CAST(weekofyear(o_orderdate) AS BIGINT) AS w, CAST(isodow(o_orderdate) - 1 AS BIGINT) AS dow FROM orders")
def calendar_parts(spark, d):
    t = F.col("o_orderdate")
    return table(spark, d, "orders").select("o_orderkey", F.month(t).cast("long").alias("m"), F.weekofyear(t).cast("long").alias("w"), F.weekday(t).cast("long").alias("dow"))


@query("month_dummies", "SELECT o_orderkey, " + ", ".join(f"CASE WHEN month(o_orderdate) = {m} THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS m{m}" for m in range(2, 13)) + " FROM orders")
def month_dummies(spark, d):
    return table(spark, d, "orders").select("o_orderkey", *S.month_dummies(F.col("o_orderdate")))


@query("release_calendar", """WITH x AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS day, CAST(date_trunc('month', o_orderdate) AS DATE) AS first FROM orders)
  SELECT day, CAST(first + CAST((12 - dayofweek(first)) % 7 AS INTEGER) AS DATE) AS first_friday, CAST(first + CAST((10 - dayofweek(first)) % 7 + 7 AS INTEGER) AS DATE) AS second_wednesday,
    CAST(len(list_filter(generate_series(first, day, INTERVAL 1 DAY), lambda t: isodow(t) < 6)) AS BIGINT) AS business_day,
    CAST(first + 12 + CAST(2 - dayofweek(CAST(first + 12 AS DATE)) AS INTEGER) AS DATE) AS reference_tuesday, CAST(day + CAST((11 - dayofweek(day)) % 7 + 1 AS INTEGER) AS DATE) AS next_friday FROM x""")
def release_calendar(spark, d):
    day = F.col("day")
    days = table(spark, d, "orders").select(F.to_date("o_orderdate").alias("day")).distinct()
    return days.select(
        "day", S.nth_weekday(day, "FRI").alias("first_friday"), S.nth_weekday(day, "WED", 2).alias("second_wednesday"), S.business_days_in_month(day).alias("business_day"),
        S.reference_week_tuesday(day).alias("reference_tuesday"), F.next_day(day, "FRI").alias("next_friday"),
    )


@query("expected_periods", "SELECT DISTINCT CAST(date_trunc('month', o_orderdate) AS DATE) AS period, CAST(len(list_filter(generate_series(date_trunc('month', o_orderdate), last_day(o_orderdate), INTERVAL 1 DAY), lambda t: isodow(t) = 6)) AS BIGINT) AS saturdays FROM orders")
def expected_periods(spark, d):
    return table(spark, d, "orders").select(F.trunc("o_orderdate", "MM").alias("period")).distinct().select("period", S.expected_weekdays(F.col("period")).alias("saturdays"))
