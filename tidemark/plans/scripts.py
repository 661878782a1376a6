"""Forecast jobs as SQL scripts: session variables, statements made at run time, guards that raise, loops that trap errors.

A script's statements are Spark SQL over whole tables of series; the script itself only decides what runs next. Results are appended to a table at
a path in the shared folder, so what was published before a failure stays.
"""

from __future__ import annotations

import uuid
from datetime import date

from pyspark.sql import DataFrame, SparkSession

from tidemark.sources.tables import optional_input

#: A trend over all months up to the origin and the value a year before each target, for every series and horizon; parameters are the
#: origin and the horizons. Names in braces are tables.
_FORECAST = """
  WITH past AS (SELECT series, period, value, row_number() OVER (PARTITION BY series ORDER BY period) AS n FROM {source} WHERE period <= :origin AND value IS NOT NULL),
  trend AS (SELECT series, regr_slope(value, n) AS slope, regr_intercept(value, n) AS level, max(n) AS n FROM past GROUP BY series),
  ahead AS (SELECT series, slope, level, n, explode(sequence(1, :horizons)) AS horizon FROM trend)
  SELECT a.series, DATE(:origin) AS origin, a.horizon, add_months(:origin, a.horizon) AS target, a.level + a.slope * (a.n + a.horizon) AS forecast, p.value AS seasonal
  FROM ahead a LEFT JOIN past p ON p.series = a.series AND p.period = add_months(:origin, a.horizon - 12)
"""

_PUBLISH = """
  SET rows = (SELECT count(*) FROM {draft} WHERE forecast IS NOT NULL AND seasonal IS NOT NULL);
  SET wanted = (SELECT count(DISTINCT series) * {horizons} FROM {source});
  IF rows <> wanted THEN
    SELECT raise_error(concat('refusing to publish ', rows, ' of ', wanted, ' rows'));
  END IF;
  EXECUTE IMMEDIATE 'INSERT INTO {target} SELECT series, origin, horizon, target, forecast, seasonal, ? FROM {draft}' USING version;
"""

_ONCE = """
BEGIN
  DECLARE origin DATE;
  DECLARE rows BIGINT;
  DECLARE wanted BIGINT;
  DECLARE version STRING DEFAULT '{version}';
  EXECUTE IMMEDIATE 'SELECT max(period) FROM {source} WHERE value IS NOT NULL AND period <= ?' INTO origin USING DATE'{today}';
  EXECUTE IMMEDIATE 'INSERT OVERWRITE {draft} {forecast}' USING origin AS origin, {horizons} AS horizons;
  {publish}
END
"""

_EACH = """
BEGIN
  DECLARE rows BIGINT;
  DECLARE wanted BIGINT;
  DECLARE version STRING DEFAULT '{version}';
  FOR one AS SELECT DISTINCT origin FROM {origins} WHERE origin IS NOT NULL ORDER BY origin DO
    BEGIN
      DECLARE EXIT HANDLER FOR SQLEXCEPTION
      BEGIN
        EXECUTE IMMEDIATE 'INSERT INTO {skipped} VALUES (?, ?)' USING one.origin, concat('skipped: ', coalesce(rows, 0), ' of ', coalesce(wanted, 0), ' rows');
      END;
      EXECUTE IMMEDIATE 'INSERT OVERWRITE {draft} {forecast}' USING one.origin AS origin, {horizons} AS horizons;
      {publish}
    END;
  END FOR;
END
"""

_COLUMNS = "series STRING, origin DATE, horizon INT, target DATE, forecast DOUBLE, seasonal DOUBLE"


class Script:
    """Tables of one run of a script; they and the views go at its end, the files stay."""

    def __init__(self, spark: SparkSession, panel: DataFrame, path: str):
        self.spark, self.path, mark = spark, path, uuid.uuid4().hex
        self.names = {k: f"tidemark_{k}_{mark}" for k in ("source", "origins", "draft", "target", "skipped")}
        panel.select("series", "period", "value").createOrReplaceTempView(self.names["source"])

    def __enter__(self) -> Script:
        for table, columns in (("draft", _COLUMNS), ("target", f"{_COLUMNS}, model_version STRING"), ("skipped", "origin DATE, reason STRING")):
            self.spark.sql(f"CREATE TABLE {self.names[table]} ({columns}) USING parquet LOCATION '{self.path}/{table}'")
        return self

    def __exit__(self, *_) -> None:
        for table in ("draft", "target", "skipped"):
            self.spark.sql(f"DROP TABLE IF EXISTS {self.names[table]}")
        for view in ("source", "origins"):
            self.spark.catalog.dropTempView(self.names[view])

    def run(self, script: str, horizons: int, version: str, **more) -> None:
        if "'" in version:
            raise ValueError("a version is a plain word")
        known = {**self.names, "horizons": horizons, "version": version, **more}
        forecast = " ".join(_FORECAST.format(**known).split()).replace("'", "''")
        self.spark.sql(script.format(**known, forecast=forecast, publish=_PUBLISH.format(**known)))

    def _read(self, table: str) -> DataFrame:
        return optional_input(self.spark, f"{self.path}/{table}", self.spark.table(self.names[table]).schema)


def forecast_once(spark: SparkSession, panel: DataFrame, path: str, today: date | str, horizons: int = 3, version: str = "trend_v1") -> DataFrame:
    """Publish the forecasts from the newest period up to ``today`` and return what is published; an error, and nothing published, if a series lacks
    a row."""
    with Script(spark, panel, path) as job:
        job.run(_ONCE, horizons, version, today=str(today))
        return job._read("target")


def forecast_each(spark: SparkSession, panel: DataFrame, origins: DataFrame, path: str, horizons: int = 3, version: str = "trend_v1") -> tuple[DataFrame, DataFrame]:
    """(published forecasts, skipped origins with their reason) of a stated list of origins (column ``origin``): one that fails is noted and the next
    begins."""
    with Script(spark, panel, path) as job:
        origins.select("origin").createOrReplaceTempView(job.names["origins"])
        job.run(_EACH, horizons, version)
        return job._read("target"), job._read("skipped")


def forecasts(panel: DataFrame, origins: DataFrame, horizons: int = 3) -> DataFrame:
    """What the loop publishes, as one DataFrame: every origin at once, those that lack a row left out."""
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    known = panel.where("value IS NOT NULL").select("series", "period", "value", F.row_number().over(Window.partitionBy("series").orderBy("period")).alias("n"))
    asked = F.broadcast(origins.select("origin").where("origin IS NOT NULL").distinct())
    past = known.join(asked, F.col("period") <= F.col("origin"))
    trend = past.groupBy("series", "origin").agg(F.regr_slope("value", "n").alias("slope"), F.regr_intercept("value", "n").alias("level"), F.max("n").alias("n"))
    ahead = trend.withColumn("horizon", F.explode(F.sequence(F.lit(1), F.lit(horizons)))).withColumn("target", F.add_months("origin", F.col("horizon")))
    year = known.select("series", F.col("period").alias("then"), F.col("value").alias("seasonal"))
    out = ahead.withColumn("then", F.add_months("origin", F.col("horizon") - 12)).join(year, ["series", "then"])
    out = out.select("series", "origin", "horizon", "target", (F.col("level") + F.col("slope") * (F.col("n") + F.col("horizon"))).alias("forecast"), "seasonal")
    out = out.where("forecast IS NOT NULL")
    wanted = panel.agg((F.count_distinct("series") * horizons).alias("wanted"))
    full = out.groupBy("origin").agg(F.count("*").alias("rows")).join(F.broadcast(wanted), F.col("rows") == F.col("wanted"))
    return out.join(F.broadcast(full.select("origin")), "origin").select("series", "origin", "horizon", "target", "forecast", "seasonal")
