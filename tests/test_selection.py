"""Medians of groups of any size against plain sorting."""

import random
import statistics
import uuid

import pytest
from pyspark.sql import functions as F

from tidemark.operators import scoring, selection


@pytest.mark.parametrize("bins", [16, 1024])
def test_exact_medians_of_skewed_groups(spark, tmp_path, bins):
    rng = random.Random(bins)
    groups = {
        "hot": [rng.choice([-1, 1]) * rng.random() ** 9 * 10 ** rng.randint(-3, 6) for _ in range(4000)],
        "ties": [rng.choice([1.5, 2.5, 2.5, 7.0]) for _ in range(101)],
        "pair": [1.0, 2.0],
        "one": [-0.1],
        "far": [-1.7e308, 1.7e308, 5e-324, 3.0],
        None: [4.0, 1.0, 1.0],
    }
    rows = [(k, v) for k, values in groups.items() for v in values] + [("ties", None), ("one", float("nan")), ("pair", float("inf")), ("none", None)]
    df = spark.createDataFrame(rows, "g string, x double").repartition(3).withColumn("n", F.lit(1)).withColumn("low", F.lit(2))
    out = selection.grouped_median(df, ["g"], "x", f"file://{tmp_path}/{uuid.uuid4().hex}", bins=bins)
    got = {r.g: r.median for r in out.collect()}
    assert got == {k: statistics.median(v) if k != "far" else 1.5 for k, v in groups.items()}


def test_median_absolute_errors_and_ranks(spark, tmp_path):
    df = spark.createDataFrame([("a", float(i)) for i in range(-3, 8)], "m string, error double")
    assert [tuple(r) for r in scoring.score_median(df, ["m"], f"file://{tmp_path}/a").collect()] == [("a", 3.0)]
    tops = selection.grouped_ranks(df, [], "error", {"least": F.lit(0), "third": F.lit(2), "most": F.col("n") - 1}, f"file://{tmp_path}/b", 3)
    assert [tuple(r) for r in tops.collect()] == [(11, -3.0, -1.0, 7.0)]
    assert selection.grouped_median(df.where("false"), ["m"], "error", f"file://{tmp_path}/c").count() == 0
