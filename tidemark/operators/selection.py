"""Exact order statistics of groups of any size, by refining histograms of their values.

A round cuts each group's current range of values into bins, counts the bins, and keeps the one that holds the wanted rank, shrunk
to the least and greatest value in it. Values at the range's ends fall into different bins, so each round narrows every range that isn't
a single value yet; when all are, they are the answer. A task sends a row per group and bin at most, whatever a group's size, and no task
sees a group's values together.

Each round's ranges are written to the folder given, which is shared by all machines, so no round is computed twice.

Defined cases: values that are null or not finite are left out, and a group of none has no row. Null keys are a group. Repeated values count
each. An even count gives the mean of the middle two.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BINS = 1024


def grouped_ranks(df: DataFrame, keys: Sequence[str], value: str, ranks: dict[str, Column], path: str, bins: int = BINS) -> DataFrame:
    """keys, n, and for each name of ``ranks`` the value of that rank (from 0; an expression of ``n``, the group's count)."""
    names = [f"__k{i}" for i in range(len(keys))]
    v = F.col(value).cast("double")
    rows = df.select(*[F.col(k).alias(n) for k, n in zip(keys, names, strict=True)], v.alias("__v"))
    rows = rows.where(F.col("__v").isNotNull() & ~F.isnan("__v") & (F.abs("__v") < float("inf")))
    whole = rows.groupBy(*names).agg(F.count("*").alias("n"), F.min("__v").alias("low"), F.max("__v").alias("high")).where("n > 0")
    asked = F.explode(F.array(*[F.struct(F.lit(name).alias("name"), rank.cast("long").alias("rank")) for name, rank in ranks.items()]))
    ranges, round_ = _kept(whole.select(*names, "n", "low", "high", asked.alias("__a")).select(*names, "n", "low", "high", "__a.*"), f"{path}/0"), 0
    while not ranges.where("low < high").isEmpty():
        open_ = ranges.where("low < high")
        same = [F.col(f"r.{n}").eqNullSafe(F.col(f"o.{n}")) for n in names]
        near = rows.alias("r").join(open_.alias("o"), [*same, F.col("__v").between(F.col("low"), F.col("high"))])
        # halves, so that no difference overflows; the least numbers have none, and then the range's lower end parts from the rest
        width = F.col("high") / 2 - F.col("low") / 2
        place = F.when(width > 0, F.floor((F.col("__v") / 2 - F.col("low") / 2) / F.when(width > 0, width) * bins))
        place = F.coalesce(place, F.when(F.col("__v") > F.col("low"), F.lit(bins - 1)).otherwise(F.lit(0)))
        near = near.select(*[F.col(f"o.{n}").alias(n) for n in names], "n", "name", "rank", "__v", F.least(place, F.lit(bins - 1)).alias("bin"))
        counts = near.groupBy(*names, "n", "name", "rank", "bin").agg(F.count("*").alias("c"), F.min("__v").alias("low"), F.max("__v").alias("high"))
        run = Window.partitionBy(*names, "name").orderBy("bin")
        counts = counts.withColumn("before", F.sum("c").over(run) - F.col("c")).where("before <= rank AND rank < before + c")
        narrowed = counts.select(*names, "n", "low", "high", "name", (F.col("rank") - F.col("before")).alias("rank"))
        round_ += 1
        ranges = _kept(ranges.where("low = high").unionByName(narrowed), f"{path}/{round_}")
    wide = ranges.groupBy(*names, "n").agg(*[F.max(F.when(F.col("name") == name, F.col("low"))).alias(name) for name in ranks])
    return wide.select(*[F.col(n).alias(k) for k, n in zip(keys, names, strict=True)], "n", *ranks)


def _kept(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def grouped_median(df: DataFrame, keys: Sequence[str], value: str, path: str, out: str = "median", bins: int = BINS) -> DataFrame:
    """keys and the exact median of each group."""
    n = F.col("n")
    found = grouped_ranks(df, keys, value, {"__low": F.floor((n - 1) / 2), "__high": F.floor(n / 2)}, path, bins)
    return found.select(*keys, (F.col("__low") * 0.5 + F.col("__high") * 0.5).alias(out))
