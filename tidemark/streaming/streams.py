"""Streaming forms of loading and reading: append, upsert, first arrival, latest value and bucket means."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.sources.tables import dedupe_last, upsert


def stream_append(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append what is there, then stop; a rerun goes on where it stopped."""
    return stream.writeStream.format("parquet").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(path)


def _versions(spark: SparkSession, base: str) -> dict[int, list[int]]:
    """The batches that wrote each part of the table, newest first."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    pattern = hadoop.Path(f"{base}/batch=*/part=*")
    found: dict[int, list[int]] = {}
    for status in pattern.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(pattern) or []:
        path = status.getPath()
        found.setdefault(int(path.getName().split("=")[1]), []).append(int(path.getParent().getName().split("=")[1]))
    return {part: sorted(batches, reverse=True) for part, batches in found.items()}


def stream_upsert(stream: DataFrame, base: str, checkpoint: str, keys: Sequence[str], order: Sequence[str], parts: int = 32, kept: int = 2) -> StreamingQuery:
    """Upsert into the table under ``base``, which lies in ``parts`` by hash of the keys. A batch rewrites the parts that it touches, as
    ``batch=<number>/part=<part>``; the newest version of a part is current. No path that is read is overwritten; of each part
    ``kept`` versions stay, so a reader has until the part's next change, and a batch that is run again finds what it read."""
    part = F.pmod(F.xxhash64(*keys), F.lit(parts)).cast("int")

    def merge(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        staged = dedupe_last(batch, keys, order)
        touched = [r.part for r in staged.select(part.alias("part")).distinct().collect()]  # ``parts`` numbers at most
        if not touched:
            return
        before = {p: [v for v in versions if v < number] for p, versions in _versions(spark, base).items() if p in touched}
        current = [f"{base}/batch={v[0]}/part={p}" for p, v in before.items() if v]
        if current:
            staged = upsert(spark.read.schema(staged.schema).parquet(*current), staged, keys)
        staged.withColumn("part", part).write.mode("overwrite").partitionBy("part").parquet(f"{base}/batch={number}")
        hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
        for p, versions in before.items():
            for v in versions[kept - 1 :]:
                path = hadoop.Path(f"{base}/batch={v}/part={p}")
                path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)

    return stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(merge).start()


def current_snapshot(spark: SparkSession, base: str) -> DataFrame:
    """The newest version of every part."""
    return spark.read.parquet(*[f"{base}/batch={v[0]}/part={p}" for p, v in sorted(_versions(spark, base).items())])


def first_arrivals(stream: DataFrame, keys: Sequence[str], event_time: str, delay: str) -> DataFrame:
    """The first arrival of each key within the watermark: arrival, not vintage, decides."""
    return stream.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(list(keys))


def latest_values(stream: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    rest = [c for c in stream.columns if c not in keys]
    return stream.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("row")).select(*keys, "row.*")


def bucket_means(stream: DataFrame, keys: Sequence[str], event_time: str, value: str, width: str, delay: str) -> DataFrame:
    """Tumbling windows; rows later than the watermark are dropped, revisions belong to ``latest_values``."""
    buckets = stream.withWatermark(event_time, delay).groupBy(*keys, F.window(event_time, width))
    cents = F.sum(F.round(F.col(value) * 100).cast("long"))
    return buckets.agg((cents / 100.0 / F.count("*")).alias("mean"), F.count("*").alias("n")).select(*keys, F.col("window.start").alias("start"), "mean", "n")


def run_to_end(stream: DataFrame, path: str, checkpoint: str, mode: str) -> None:
    """Run over what is there and write the final state: complete or update results go through foreachBatch."""

    def keep(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite" if mode == "complete" else "append").parquet(path)

    if mode == "append":
        query = stream_append(stream, path, checkpoint)
    else:
        query = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(keep).start()
    query.awaitTermination()
