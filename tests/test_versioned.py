"""Tables that change by parts: against the plain DataFrame forms, through crashes, retries and races."""

import uuid
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.sources import tables, versioned

SCHEMA = T.StructType().add("k", "long").add("g", "string").add("x", "double")


def new_table(spark, tmp_path, rows, by=("k",), parts=8):
    t = versioned.VersionedTable.create(spark, f"file://{tmp_path}/{uuid.uuid4().hex}", SCHEMA, by, parts)
    t.upsert(spark.createDataFrame(rows, SCHEMA), list(dict.fromkeys([*by, "k"])), run="load")
    return t


def got(df):
    return sorted(map(tuple, df.collect()), key=str)


ROWS = [(i, "abc"[i % 3], float(i)) for i in range(40)] + [(None, "a", -1.0)]


def test_changes_equal_their_dataframe_forms(spark, tmp_path):
    t = new_table(spark, tmp_path, ROWS)
    plain = spark.createDataFrame(ROWS, SCHEMA)
    assert got(t.read()) == got(plain)
    staged = spark.createDataFrame([(3, "z", 1.0), (3, "y", 2.0), (100, "n", None), (None, "q", 5.0)], SCHEMA)
    t.upsert(staged, ["k"], ["x"])
    plain = tables.upsert(plain, staged, ["k"], ["x"])
    assert got(t.read()) == got(plain) and len(got(plain)) == 42
    patch = spark.createDataFrame([(5, 50.0), (6, None), (None, 7.0)], "k bigint, x double")
    t.update_columns(patch, ["k"], ["x"])
    plain = tables.update_columns(plain, patch, ["k"], ["x"])
    assert got(t.read()) == got(plain)
    slice_ = spark.createDataFrame([(900, "a", 9.0), (901, "b", 9.0)], SCHEMA)
    t.replace_slice(slice_, ["g"])  # not by part: all are touched
    plain = tables.replace_slice(plain, slice_, ["g"])
    assert got(t.read()) == got(plain)
    t.replace_slice(slice_, ["g"])
    assert got(t.read()) == got(plain)
    assert t.manifest().number == 6 and got(t.read(2)) == got(spark.createDataFrame(ROWS, SCHEMA))


def test_only_touched_parts_are_rewritten(spark, tmp_path):
    t = new_table(spark, tmp_path, ROWS)
    before = t.manifest().parts
    t.upsert(spark.createDataFrame([(3, "z", 1.0)], SCHEMA), ["k"])
    after = t.manifest().parts
    assert set(before) == set(after) and sum(before[p] != after[p] for p in before) == 1
    (fresh,) = {d.split("/")[1] for d in after.values()} - {d.split("/")[1] for d in before.values()}
    root = Path(t.base.removeprefix("file:"))
    assert [p.name for p in (root / "data" / fresh).iterdir() if p.is_dir()] == [d.split("/")[2] for d in after.values() if fresh in d]
    # a slice by the table's own columns touches its part alone
    by_group = new_table(spark, tmp_path, ROWS, by=("g",), parts=16)
    before = by_group.manifest().parts
    by_group.replace_slice(spark.createDataFrame([(1, "b", 0.0)], SCHEMA), ["g"])
    assert sum(before[p] != d for p, d in by_group.manifest().parts.items()) == 1
    assert got(by_group.read()) == sorted([r for r in ROWS if r[1] != "b"] + [(1, "b", 0.0)], key=str)


def test_a_crash_before_the_rename_leaves_the_old_table(spark, tmp_path, monkeypatch):
    t = new_table(spark, tmp_path, ROWS)
    def crash(self, manifest):  # noqa: E306
        raise OSError("gone")
    monkeypatch.setattr(versioned.VersionedTable, "_commit", crash)
    change = spark.createDataFrame([(3, "z", 1.0)], SCHEMA)
    with pytest.raises(OSError):
        t.upsert(change, ["k"], run="r1")
    monkeypatch.undo()
    again = versioned.VersionedTable(spark, t.base)
    assert got(again.read()) == got(spark.createDataFrame(ROWS, SCHEMA)) and again.manifest().number == 2
    # the same run, tried again, takes effect once
    again.upsert(change, ["k"], run="r1")
    once = got(again.read())
    again.upsert(change.withColumn("x", F.lit(77.0)), ["k"], run="r1")
    assert got(again.read()) == once and (3, "z", 1.0) in once and again.manifest().number == 3


def test_the_slower_of_two_writers_starts_over(spark, tmp_path, monkeypatch):
    t = new_table(spark, tmp_path, ROWS)
    commit, done = versioned.VersionedTable._commit, []

    def overtaken(self, manifest):
        if not done:
            done.append(1)
            versioned.VersionedTable(spark, t.base).upsert(spark.createDataFrame([(4, "w", 4.5)], SCHEMA), ["k"])
        return commit(self, manifest)

    monkeypatch.setattr(versioned.VersionedTable, "_commit", overtaken)
    t.upsert(spark.createDataFrame([(3, "z", 1.0)], SCHEMA), ["k"])
    rows = got(t.read())
    assert (3, "z", 1.0) in rows and (4, "w", 4.5) in rows and len(rows) == 41 and t.manifest().number == 4


def test_edges_of_versioned_tables(spark, tmp_path):
    t = versioned.VersionedTable.create(spark, f"file://{tmp_path}/t", SCHEMA, ["k"], 4)
    assert t.read().count() == 0
    assert t.upsert(spark.createDataFrame([], SCHEMA), ["k"]) == 1
    assert versioned.VersionedTable.create(spark, t.base, SCHEMA, ["k"], 4).manifest().number == 1
    with pytest.raises(ValueError):
        versioned.VersionedTable.create(spark, t.base, SCHEMA, ["g"], 4)
    with pytest.raises(ValueError):
        t.upsert(spark.createDataFrame([], SCHEMA), ["g"])
    with pytest.raises(ValueError):
        t.upsert(spark.createDataFrame([(1, "a", 1.0, 2)], "k long, g string, x double, extra int"), ["k"])
    with pytest.raises(ValueError):
        t.read(9)
    for i in range(4):
        t.upsert(spark.createDataFrame([(i, "a", 1.0)], SCHEMA), ["k"])
    t.forget(2)
    assert t._numbers() == [4, 5] and t.read().count() == 4 and t.read(4).count() == 3
