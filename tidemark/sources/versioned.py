"""Batch tables that change in place: a change rewrites the parts that it touches and takes effect by one rename.

Rows lie in a fixed number of parts, by the hash of the table's ``by`` columns. A change reads the parts that its rows fall into, writes
them anew beside the old ones and then commits a manifest, which names the directory of every part; the manifest with
the highest number is the table. Until it is there readers see the old table, and a writer that dies before leaves
nothing but files that nobody reads. Old versions stay readable until ``forget``.

A change may bear a run's id. The manifest keeps the ids of the last ``REMEMBERED`` runs, so a run that is tried again after it
took effect changes nothing. Two writers at once: both write the same manifest number, the rename of the second is refused and it
starts over from the newer table.

The bytes that a change reads and writes grow with the parts it touches. A change that can't tell its parts (a slice whose columns
don't include all of ``by``) touches all. Parts are written through a rebalancing shuffle, so one that holds most rows is split over tasks.

The file system's rename within a folder must be atomic and refuse an existing target, as a cluster's is.

Defined cases: null keys equal null. Changes without rows commit nothing. Unknown columns and nulls in required ones are errors,
as in ``tables.conform``. A table without rows reads as empty.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.sources import tables

REMEMBERED = 1000


class Overtaken(RuntimeError):
    """Another change took effect first."""


@dataclass
class Manifest:
    number: int
    schema: dict
    by: list[str]
    n_parts: int
    parts: dict[str, str] = field(default_factory=dict)
    runs: list[str] = field(default_factory=list)


class VersionedTable:
    def __init__(self, spark: SparkSession, base: str):
        self.spark, self.base = spark, base.rstrip("/")
        self._hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._fs = self._path("").getFileSystem(self._conf)

    @classmethod
    def create(cls, spark: SparkSession, base: str, schema: T.StructType, by: Sequence[str], parts: int = 64) -> VersionedTable:
        """A new table without rows; an existing one is left as it is and must have the same form."""
        self = cls(spark, base)
        if not self._numbers():
            try:
                self._commit(Manifest(1, schema.jsonValue(), list(by), parts))
            except Overtaken:
                pass
        found = self.manifest()
        if (found.schema, found.by, found.n_parts) != (json.loads(schema.json()), list(by), parts):
            raise ValueError(f"{base} is a table of another form")
        return self

    # --- files

    def _path(self, name: str):
        return self._hadoop.Path(f"{self.base}/{name}" if name else self.base)

    def _numbers(self) -> list[int]:
        folder = self._path("manifest")
        if not self._fs.exists(folder):
            return []
        names = [s.getPath().getName() for s in self._fs.listStatus(folder)]
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and not n.startswith("."))

    def manifest(self, number: int | None = None) -> Manifest:
        """The table as of a version, by default the newest."""
        numbers = self._numbers()
        if not numbers or (number is not None and number not in numbers):
            raise ValueError(f"no such version of {self.base}: {number}")
        stream = self._fs.open(self._path(f"manifest/{number or numbers[-1]:012d}.json"))
        try:
            body = self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return Manifest(**json.loads(body))

    def _commit(self, manifest: Manifest) -> None:
        """One rename, which fails where the number is taken."""
        written, final = self._path(f"manifest/.{uuid.uuid4().hex}"), self._path(f"manifest/{manifest.number:012d}.json")
        out = self._fs.create(written, False)
        try:
            out.write(bytearray(json.dumps(vars(manifest)).encode()))
        finally:
            out.close()
        gateway = self.spark.sparkContext._gateway
        options = gateway.new_array(self._hadoop.Options.Rename, 1)
        options[0] = getattr(self._hadoop.Options.Rename, "NONE")
        try:
            self._hadoop.FileContext.getFileContext(written.toUri(), self._conf).rename(self._fs.makeQualified(written), self._fs.makeQualified(final), options)
        except Py4JJavaError as e:
            self._fs.delete(written, False)
            if "FileAlreadyExists" in str(e.java_exception.getClass().getName()):
                raise Overtaken(f"version {manifest.number} of {self.base} is taken") from e
            raise

    # --- reading

    def schema(self, manifest: Manifest | None = None) -> T.StructType:
        return T.StructType.fromJson((manifest or self.manifest()).schema)

    def read(self, version: int | None = None) -> DataFrame:
        return self._of(self.manifest(version))

    def _of(self, manifest: Manifest, parts: Sequence[int] | None = None) -> DataFrame:
        schema = self.schema(manifest)
        found = [f"{self.base}/{d}" for p, d in sorted(manifest.parts.items()) if parts is None or int(p) in parts]
        return self.spark.read.schema(schema).parquet(*found) if found else self.spark.createDataFrame([], schema)

    # --- changes

    def _part(self, manifest: Manifest) -> Column:
        return F.pmod(F.xxhash64(*manifest.by), F.lit(manifest.n_parts)).cast("int")

    def _change(self, rows: DataFrame, columns: Sequence[str], change: Callable[[DataFrame, DataFrame], DataFrame], run: str | None, whole: bool = False) -> int:
        """Commit what ``change(current rows of the touched parts, rows)`` gives; the table's version afterwards."""
        for _ in range(20):
            manifest = self.manifest()
            if run is not None and run in manifest.runs:
                return manifest.number
            schema = self.schema(manifest)
            spec = tables.TableSpec(self.base, T.StructType([schema[c] for c in columns]))
            staged = tables.conform(rows, spec)
            if whole:
                touched = [] if staged.isEmpty() else list(range(manifest.n_parts))
            else:
                touched = sorted(r[0] for r in staged.select(self._part(manifest)).distinct().collect())  # n_parts numbers at most
            if not touched:
                return manifest.number
            new = change(self._of(manifest, touched), staged).select(*[F.col(f"`{f.name}`").cast(f.dataType) for f in schema])
            name = f"data/{uuid.uuid4().hex}"
            new.withColumn("part", self._part(manifest)).hint("rebalance", "part").write.partitionBy("part").parquet(f"{self.base}/{name}")
            written = [s.getPath().getName() for s in self._fs.listStatus(self._path(name))]
            written = {n.removeprefix("part="): f"{name}/{n}" for n in written if n.startswith("part=")}
            parts = {p: d for p, d in manifest.parts.items() if int(p) not in touched} | written
            runs = (manifest.runs + ([run] if run is not None else []))[-REMEMBERED:]
            try:
                self._commit(Manifest(manifest.number + 1, manifest.schema, manifest.by, manifest.n_parts, parts, runs))
                return manifest.number + 1
            except Overtaken:
                self._fs.delete(self._path(name), True)
        raise Overtaken(f"{self.base} changes too often")

    def merge(self, rows: DataFrame, keys: Sequence[str], change: Callable[[DataFrame, DataFrame], DataFrame], run: str | None = None) -> int:
        """Commit ``change(current rows of the touched parts, rows)``, which may only look at rows of equal keys together."""
        by, names = self.manifest().by, self.schema().names
        if not set(by) <= set(keys):
            raise ValueError(f"rows of equal keys may lie in several parts: keys must include {by}")
        return self._change(rows, names, change, run)

    def upsert(self, staged: DataFrame, keys: Sequence[str], order: Sequence[str] | None = None, run: str | None = None) -> int:
        """See ``tables.upsert``; the keys must include the table's ``by`` columns."""
        return self.merge(staged, keys, lambda current, rows: tables.upsert(current, rows, keys, order), run)

    def replace_slice(self, rows: DataFrame, columns: Sequence[str], run: str | None = None) -> int:
        """Drop the slices (equal ``columns``) that the rows belong to and add the rows: done twice, it leaves the same table."""
        whole = not set(self.manifest().by) <= set(columns)
        return self._change(rows, self.schema().names, lambda current, new: tables.replace_slice(current, new, columns), run, whole)

    def update_columns(self, patch: DataFrame, keys: Sequence[str], columns: Sequence[str], order: Sequence[str] | None = None, run: str | None = None) -> int:
        """See ``tables.update_columns``; keys that don't include all of ``by`` touch every part."""
        whole = not set(self.manifest().by) <= set(keys)
        read = list(dict.fromkeys([*keys, *columns, *(order or ())]))
        return self._change(patch, read, lambda current, rows: tables.update_columns(current, rows, keys, columns, order), run, whole)

    def forget(self, keep: int = 2) -> None:
        """Drop all but the newest ``keep`` versions, and the parts that only they name."""
        numbers = self._numbers()
        old, new = numbers[:-keep], numbers[-keep:]
        held = {d for n in new for d in self.manifest(n).parts.values()}
        for n in old:
            for d in set(self.manifest(n).parts.values()) - held:
                self._fs.delete(self._path(d), True)
            self._fs.delete(self._path(f"manifest/{n:012d}.json"), False)
