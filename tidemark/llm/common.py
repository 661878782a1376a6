"""Helpers that the training-data operators share: fold columns, text bytes, and tables in the shared scratch folder."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from typing import ClassVar

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % F.lit(modulus)


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir; a new temporary one only where that is unset and all runs on one machine, as in tests."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        path = spark.sparkContext.getCheckpointDir()
    if not path:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
        path = "file://" + tempfile.mkdtemp(prefix="spark-", dir="/tmp")
        spark.sparkContext.setCheckpointDir(path)
    return path.rstrip("/")


def _delete(spark: SparkSession, path: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def temporary_tables(spark: SparkSession, lasting: Scratch) -> Iterator[None]:
    """Intermediate tables that operators write within the block are deleted at its end, but for those of ``lasting``."""
    before = set(Scratch.written)
    try:
        yield
    finally:
        for base in [x for x in Scratch.written if x not in before and x != lasting.base]:
            _delete(spark, base)
            Scratch.written.remove(base)


class Scratch:
    """Intermediate tables, written once to the shared folder and read again: a lost executor costs no recomputation."""

    #: Folders of all tables that this process has written.
    written: ClassVar[list[str]] = []

    def __init__(self, spark: SparkSession):
        self.spark, self.base, self.paths = spark, f"{shared_dir(spark)}/tidemark-{uuid.uuid4().hex}", {}
        self.kept = 0

    def keep(self, df: DataFrame, name: str, partition_by: str | None = None, records: int | None = None) -> DataFrame:
        """``records``: rows of an Arrow batch at most while the table is written, for steps that read whole texts."""
        self.kept += 1
        if self.kept == 1:
            Scratch.written.append(self.base)
        path = f"{self.base}/{name}-{self.kept}"
        writer = df.write.option("compression", "zstd")
        key, conf = "spark.sql.execution.arrow.maxRecordsPerBatch", self.spark.conf
        before = conf.get(key)
        if records:
            conf.set(key, str(min(records, int(before))))
        try:
            (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)
        finally:
            conf.set(key, before)
        schema = df.schema
        out = self.spark.read.schema(schema).parquet(path)
        self.paths[name] = path
        return out

    def drop(self, *names: str) -> None:
        """Delete tables that no later step reads."""
        for name in names:
            _delete(self.spark, self.paths.pop(name))


def utf8(column: pa.Array | pa.ChunkedArray) -> list[bytes]:
    """A string column as bytes; null becomes empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def texts(column: pa.Array) -> list[str]:
    return [x or "" for x in column.to_pylist()]


def batches(rows: Iterator[pa.RecordBatch], size: int = 2000) -> Iterator[pa.RecordBatch]:
    """The same rows in smaller batches, so that the output of one stays small."""
    for batch in rows:
        for at in range(0, batch.num_rows, size):
            yield batch.slice(at, size)
        batch = None
        release()
    release()


def release() -> None:
    """Give freed memory back: a Python worker outlives its task, and its share of the executor is small."""
    pa.default_memory_pool().release_unused()
    libc = ctypes.CDLL(None)
    if hasattr(libc, "malloc_trim"):
        libc.malloc_trim(0)
