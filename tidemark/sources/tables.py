"""Loading and maintaining tables: append, archive, upsert, replace, and reshaping of what arrives.

Functions that change a table return the new table; writing it to a new path and pointing readers there is the caller's swap.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class TableSpec:
    name: str
    schema: T.StructType
    merge_keys: tuple[str, ...] = ()
    partition_by: str | None = None


def stamped(df: DataFrame, at: str, run_id: str) -> DataFrame:
    """One literal per run, not the time of each row."""
    return df.withColumn("ingested_at", F.lit(at).cast("timestamp")).withColumn("ingestion_run_id", F.lit(run_id))


def conform(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Columns of the schema, cast; unknown columns and nulls in required ones are errors."""
    unknown = set(df.columns) - set(spec.schema.names)
    if unknown:
        raise ValueError(f"{spec.name}: unknown columns {sorted(unknown)}")
    required = [f.name for f in spec.schema if not f.nullable]
    out = df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in spec.schema])
    for name in required:
        kept = F.when(F.col(name).isNull(), F.raise_error(F.lit(f"{spec.name}.{name} is null"))).otherwise(F.col(name))
        out = out.withColumn(name, kept)
    return out


def load_append(df: DataFrame, spec: TableSpec, path: str, at: str, run_id: str) -> bool:
    """Append a run's rows, stamped; an empty run writes nothing."""
    rows = stamped(conform(df, spec), at, run_id)
    if rows.isEmpty():
        return False
    writer = rows.write.mode("append")
    (writer.partitionBy(spec.partition_by) if spec.partition_by else writer).parquet(path)
    return True


def raw_archive(df: DataFrame, path: str, day: str) -> None:
    df.write.mode("append").json(f"{path}/dt={day}")


def read_archive(spark: SparkSession, schema: T.StructType, path: str) -> DataFrame:
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def optional_input(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The table, or an empty one of its schema where there is none."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], schema)


def same_keys(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> Column:
    """Null-safe equality of keys, as a join condition."""
    out = F.lit(True)
    for k in keys:
        out = out & a[k].eqNullSafe(b[k])
    return out


def dedupe_last(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("__row")).select(*keys, "__row.*")


def dedupe_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("__row")).select(*keys, "__row.*")


def anti_self(target: DataFrame, staged: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of the target that the staged rows leave alone."""
    return target.alias("t").join(staged.select(*keys).alias("s"), _null_safe(keys), "left_anti")


def _null_safe(keys: Sequence[str]) -> Column:
    out = F.lit(True)
    for k in keys:
        out = out & F.col(f"t.{k}").eqNullSafe(F.col(f"s.{k}"))
    return out


def one_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str] | None) -> DataFrame:
    """The last row of each key in the order; without one, in the order of all other columns, so that the pick is the same every time."""
    rest = [c for c in df.columns if c not in keys]
    return dedupe_last(df, keys, order or rest) if rest else df.select(*keys).distinct()


def upsert(target: DataFrame, staged: DataFrame, keys: Sequence[str], order: Sequence[str] | None = None) -> DataFrame:
    """Staged rows replace those of equal keys (null equals null) and add the others; the rest of the target stays. Of staged rows with
    equal keys the last in ``order`` counts (see ``one_per_key``)."""
    staged = one_per_key(staged, keys, order)
    return anti_self(target, staged, keys).unionByName(staged.select(*target.columns))


def replace_slice(target: DataFrame, rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Drop the slices that the new rows belong to, then add them: a retry leaves the same table."""
    return anti_self(target, rows, keys).unionByName(rows.select(*target.columns))


def update_columns(target: DataFrame, patch: DataFrame, keys: Sequence[str], columns: Sequence[str], order: Sequence[str] | None = None) -> DataFrame:
    """Set columns of the rows that a patch row matches; null patches leave what is there. Of patch rows with equal keys the last in
    ``order`` counts, so no target row is doubled."""
    patch = one_per_key(patch.select(*dict.fromkeys([*keys, *columns, *(order or ())])), keys, order)
    joined = target.alias("t").join(patch.alias("s"), _null_safe(keys), "left")
    return joined.select(*[F.coalesce(f"s.{c}", f"t.{c}").alias(c) if c in columns else F.col(f"t.{c}") for c in target.columns])


def new_vintages(incoming: DataFrame, stored: DataFrame, vintage: str) -> DataFrame:
    return incoming.join(stored.select(vintage).distinct(), vintage, "left_anti")


def wide_to_long(df: DataFrame, ids: Sequence[str], columns: Sequence[str], name: str = "measure", value: str = "value") -> DataFrame:
    return df.unpivot(list(ids), list(columns), name, value).where(F.col(value).isNotNull())


def release_gate(df: DataFrame, period: str, cutoff: DataFrame) -> DataFrame:
    """Rows up to the cutoff (column ``cutoff`` of its table; the latest, should there be several)."""
    one = cutoff.agg(F.max("cutoff").alias("__cutoff"))
    return df.join(F.broadcast(one), F.col(period) <= F.col("__cutoff")).drop("__cutoff")


def nested_points(df: DataFrame, ids: Sequence[str], payload: str, metadata: DataFrame, most: int = 100_000) -> DataFrame:
    """A JSON payload of series, each with points, to rows: ids, series_id, the metadata's columns, period, value.

    The payload is {"series": [{"id": ..., "points": [{"period": ..., "value": ...}]}]}; null values stay, points without a period go.
    ``metadata`` has one row per series_id; it is sent to every task when it has ``most`` rows or fewer, else joined by a shuffle.
    """
    schema = "series array<struct<id:string,points:array<struct<period:date,value:double>>>>"
    parsed = df.select(*ids, F.from_json(payload, schema, {"mode": "PERMISSIVE"}).alias("__p"))
    series = parsed.select(*ids, F.explode("__p.series").alias("__s"))
    points = series.select(*ids, F.col("__s.id").alias("series_id"), F.explode("__s.points").alias("__v"))
    rows = points.select(*ids, "series_id", "__v.period", "__v.value").where("period IS NOT NULL")
    small = metadata.limit(most + 1).count() <= most
    return rows.join(F.broadcast(metadata) if small else metadata, "series_id", "left")


def backfill(df: DataFrame, column: str, value) -> DataFrame:
    return df.withColumn(column, F.coalesce(F.col(column), F.lit(value)))
