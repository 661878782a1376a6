"""SQL scripts against their DataFrame form."""

import datetime as dt
import math
import uuid

import pytest

from tidemark.plans import scripts


def panel(spark):
    rows = [(s, dt.date(2000 + i // 12, i % 12 + 1, 1), 10.0 * k + i + math.sin(i)) for k, s in enumerate("abc") for i in range(40)]
    rows = [(s, p, None if (s, i) == ("b", 62) else v) for i, (s, p, v) in enumerate(rows)]
    return spark.createDataFrame(rows, "series string, period date, value double")


def test_a_failing_origin_is_noted_and_the_loop_goes_on(spark, tmp_path):
    rows = panel(spark)
    origins = spark.createDataFrame([(dt.date(2000 + k // 12, k % 12 + 1, 1),) for k in (3, 8, 12, 15, 20, 32, 33, 35, 39)] + [(None,)], "origin date")
    done, skipped = scripts.forecast_each(spark, rows, origins, f"file://{tmp_path}/{uuid.uuid4().hex}")
    key = lambda r: (r.series, r.origin, r.horizon)
    got, want = sorted(done.collect(), key=key), sorted(scripts.forecasts(rows, origins).collect(), key=key)
    assert [tuple(r)[:4] for r in got] == [tuple(r)[:4] for r in want] and len(got) == 9 * len({r.origin for r in got})
    assert all(g.forecast == pytest.approx(w.forecast, rel=1e-12) and g.seasonal == w.seasonal for g, w in zip(got, want))
    missed = {r.origin: r.reason for r in skipped.collect()}
    assert set(missed) | {r.origin for r in got} == {r.origin for r in origins.collect() if r.origin} and not set(missed) & {r.origin for r in got}
    assert dt.date(2000, 4, 1) in missed and "of 9 rows" in missed[dt.date(2000, 4, 1)]
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("tidemark_")]


def test_one_run_publishes_all_or_fails(spark, tmp_path):
    rows, path = panel(spark), f"file://{tmp_path}/{uuid.uuid4().hex}"
    out = scripts.forecast_once(spark, rows, path, "2003-02-17").collect()
    assert {r.origin for r in out} == {dt.date(2003, 2, 1)} and len(out) == 9 and {r.model_version for r in out} == {"trend_v1"}
    with pytest.raises(Exception, match="refusing to publish"):
        scripts.forecast_once(spark, rows, f"{path}-2", "2000-05-01")
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("tidemark_")]
