"""First prints in a stream: late earlier vintages, restarts, and state that ends."""

import datetime as dt
import random
import uuid

import pyarrow as pa
from pyspark.sql import types as T

from tidemark.sources.versioned import VersionedTable
from tidemark.streaming import first_print

SCHEMA = T.StructType().add("k", "string").add("vintage", "date").add("tie", "long").add("value", "double").add("arrival", "timestamp")
TABLE = T.StructType().add("k", "string").add("vintage", "date").add("tie", "long").add("value", "double").add("arrival", "timestamp")


def row(k, day, tie, value, arrived):
    return (k, None if day is None else dt.date(2020, 1, day), tie, value, dt.datetime(2020, 1, 1) + dt.timedelta(days=arrived))


def test_corrections_restart_and_expiry(spark, tmp_path):
    base = f"file://{tmp_path}/{uuid.uuid4().hex}"
    table, said = VersionedTable.create(spark, f"{base}/table", TABLE, ["k"], 4), []

    def feed(n, rows):
        """A new file, and a run over it from the checkpoint of the runs before."""
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(f"{base}/in")
        stream = spark.readStream.schema(SCHEMA).parquet(f"{base}/in")
        prints = first_print.first_prints(stream, ["k"], ["vintage", "tie"], "arrival", "1 day", 30)
        first_print.publish_first_prints(prints, table, ["k"], ["vintage", "tie"], f"{base}/checkpoint").awaitTermination()
        q = prints.writeStream.outputMode("update").option("checkpointLocation", f"{base}/other").trigger(availableNow=True)
        q.foreachBatch(lambda b, i: said.extend((r.k, r.value, r.corrections) for r in b.collect())).start().awaitTermination()
        return {r.k: r.value for r in table.read().collect()}, sorted(said)

    got, _ = feed(1, [row("a", 10, 1, 1.0, 0), row("a", 12, 1, 2.0, 0), row("b", 5, 2, 3.0, 0), row("b", 5, 1, 4.0, 0), row("c", None, 1, 5.0, 0)])
    assert got == {"a": 1.0, "b": 4.0, "c": 5.0} and sorted(said) == [("a", 1.0, 0), ("b", 4.0, 0), ("c", 5.0, 0)]
    # a later vintage says nothing, an earlier one that comes late corrects
    said.clear()
    got, _ = feed(2, [row("a", 20, 1, 6.0, 2), row("b", 4, 9, 7.0, 2), row("c", 30, 1, 8.0, 2)])
    assert got == {"a": 1.0, "b": 7.0, "c": 8.0} and sorted(said) == [("b", 7.0, 1), ("c", 8.0, 1)]
    # the watermark passes the timers: state ends
    said.clear()
    feed(3, [row("d", 1, 1, 9.0, 60)])
    feed(4, [row("d", 2, 1, 9.5, 62)])
    said.clear()
    got, _ = feed(5, [row("a", 28, 1, 10.0, 63)])
    assert said == [("a", 10.0, 0)]  # as of a key never seen
    assert got == {"a": 1.0, "b": 7.0, "c": 8.0, "d": 9.0}  # and yet the table keeps the earlier vintage


def test_rows_that_cannot_matter_stay_in_their_task(spark, tmp_path, monkeypatch):
    """Whatever the watermark shuts out, the first print of the rest is kept; few rows a key are, and the state comes after that step."""
    rng = random.Random(4)
    some = lambda values: rng.choice([None, *values])
    rows = [row(some("abc"), some(range(1, 28)), n, float(n), rng.randint(0, 40)) for n in range(30_000)]
    rows += [(k, dt.date(2019, 1, 1), -1, 0.5, None) for k in "abc"]
    monkeypatch.setattr(first_print, "ROWS", 2_000)
    zone = dt.timezone.utc
    columns = [[r[i] if i < 4 or r[i] is None else r[i].replace(tzinfo=zone) for r in rows] for i in range(5)]
    kinds = [pa.string(), pa.date32(), pa.int64(), pa.float64(), pa.timestamp("us", "UTC")]
    table = pa.table([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=TABLE.names)
    out = pa.Table.from_batches(first_print.earliest(["k"], ["vintage", "tie"], "arrival")(iter(table.to_batches(500))), table.schema)
    assert out.num_rows < 500
    place = lambda r: (r["vintage"] is None, r["vintage"] or dt.date.min, r["tie"])

    def firsts(found, day):
        found = [r for r in found if r["arrival"] is None or r["arrival"] > dt.datetime(2020, 1, 1, tzinfo=zone) + dt.timedelta(days=day)]
        return {k: min((r for r in found if r["k"] == k), key=place, default=None) for k in ("a", "b", "c", None)}

    whole, left = table.to_pylist(), out.to_pylist()
    for drop in (False, True):  # with and without the rows that have no arrival
        whole, left = ([r for r in x if not drop or r["arrival"] is not None] for x in (whole, left))
        for day in range(-1, 41):
            assert firsts(whole, day) == firsts(left, day)
    base = f"file://{tmp_path}/{uuid.uuid4().hex}"
    spark.createDataFrame([], SCHEMA).write.parquet(base)
    prints = first_print.first_prints(spark.readStream.schema(SCHEMA).parquet(base), ["k"], ["vintage", "tie"], "arrival", "1 day", 30)
    plan = prints._jdf.queryExecution().analyzed().toString()
    assert 0 < plan.index("TransformWithState") < plan.index("EventTimeWatermark") < plan.index("MapInArrow")
