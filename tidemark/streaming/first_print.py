"""The first print of each key in a stream, by vintage instead of arrival.

A key's state is its earliest row so far. A row of an earlier vintage that comes late replaces it, and goes on downstream as a correction; other rows say
nothing. State ends ``keep`` after the key's first arrival: an event-time timer clears it, so the store holds the keys of that
span only. The published table takes what the stream says under the same rule (the earlier vintage wins), so neither a batch that is
run again nor a row that comes after its key's state has ended can put a later vintage in its place.

The state takes a row at a time, so before the shuffle each task drops what can't matter (``earliest``): a row goes on only if it comes
before every row of its key that arrived as late or later. Whatever the watermark then shuts out, the earliest of the others is still there, and so is
the latest arrival, which the watermark follows. A hot key costs a few rows a task.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from tidemark.operators.vintage import latest_by_window
from tidemark.sources.versioned import VersionedTable

#: The state store that keyed state of several kinds and timers need.
STORE = ("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")

#: Rows, and bytes of them, that a task gathers before it drops what can't matter.
ROWS, BYTES = 100_000, 64_000_000
#: Types whose order in Arrow is that of Python, and of which equal values are equal keys.
_PLAIN = (T.IntegralType, T.DecimalType, T.StringType, T.BooleanType, T.DateType, T.TimestampType, T.BinaryType)


def _front(rows: pa.Table, keys: Sequence[str], order: Sequence[str], arrival: str) -> pa.Table:
    """Of each key the rows that come before every other row that arrived as late or later; rows without arrival are a key of their own."""
    lacking = pc.is_null(rows[arrival])
    by = pa.table([*[rows[k] for k in keys], lacking, *[rows[c] for c in order]], names=[str(i) for i in range(len(keys) + 1 + len(order))])
    at = pc.sort_indices(by, sort_keys=[(n, "ascending") for n in by.column_names], null_placement="at_end")
    opens = np.zeros(len(rows), bool)
    opens[0] = True
    for column in by.columns[: len(keys) + 1]:
        column = column.take(at)
        null = np.asarray(pc.is_null(column))
        opens[1:] |= np.asarray(pc.fill_null(pc.not_equal(column[1:], column[:-1]), False)) | (null[1:] != null[:-1])
    arrived = np.asarray(pc.fill_null(rows[arrival].take(at).cast(pa.int64()), 0))
    days, rank = np.unique(arrived, return_inverse=True)
    rank = np.cumsum(opens) * len(days) + rank
    kept = np.flatnonzero(np.diff(np.maximum.accumulate(rank), prepend=-1))
    return rows.take(pc.take(at, pa.array(kept)))


def earliest(keys: Sequence[str], order: Sequence[str], arrival: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A step for ``mapInArrow``. Where little can be dropped rows go on as they are, so a task holds ``ROWS`` and a batch at most."""

    def run(batches):
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
            if sum(b.num_rows for b in held) >= ROWS or sum(b.nbytes for b in held) >= BYTES:
                held = _front(pa.Table.from_batches(held), keys, order, arrival).combine_chunks().to_batches()
                if sum(b.num_rows for b in held) > ROWS // 2 or sum(b.nbytes for b in held) > BYTES // 2:
                    yield from held
                    held = []
        if held:
            yield from _front(pa.Table.from_batches(held), keys, order, arrival).to_batches()

    return run


class EarliestRow(StatefulProcessor):
    """Emits a key's earliest row when it becomes known or is corrected, with how often it has been."""

    def __init__(self, schema: T.StructType, keys: Sequence[str], order: Sequence[str], arrival: str, keep_ms: int):
        self.names = [n for n in schema.names if n not in keys]
        self.state = T.StructType([schema[n] for n in self.names] + [T.StructField("corrections", T.IntegerType())])
        self.out = [*keys, *self.state.names]
        self.order, self.arrival, self.keep_ms = [self.names.index(c) for c in order], self.names.index(arrival), keep_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle, self.first = handle, handle.getValueState("first", self.state)

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        held = tuple(self.first.get()) if self.first.exists() else None
        best = held
        for row in rows:
            row = tuple(row[n] for n in self.names)
            if best is None or self._before(row, best):
                best = (*row, 0 if held is None else held[-1] + 1)
        if best == held:
            return
        if held is None:
            self.handle.registerTimer(int(best[self.arrival].timestamp() * 1000) + self.keep_ms)
        self.first.update(best)
        yield Row(**dict(zip(self.out, (*key, *best), strict=True)))

    def _before(self, a: tuple, b: tuple) -> bool:
        """By the order's columns; null comes last."""
        for i in self.order:
            if a[i] != b[i]:
                return b[i] is None or (a[i] is not None and a[i] < b[i])
        return False

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self.first.clear()
        return iter(())


def first_prints(stream: DataFrame, keys: Sequence[str], order: Sequence[str], arrival: str, delay: str, keep_days: int) -> DataFrame:
    """The stream's columns, keys first, and ``corrections``: a row whenever a key's first print is found or corrected. ``order`` must
    settle ties; ``arrival`` is the timestamp that the watermark follows. Keys and order of nested or floating types go to the state row by row."""
    stream.sparkSession.conf.set(*STORE)
    rest = [n for n in stream.columns if n not in keys]
    processor = EarliestRow(stream.schema, keys, order, arrival, keep_days * 86_400_000)
    out = T.StructType([stream.schema[k] for k in keys] + list(processor.state))
    rows = stream.select(*keys, *rest)
    if all(isinstance(rows.schema[c].dataType, _PLAIN) for c in (*keys, *order)):
        rows = rows.mapInArrow(earliest(keys, order, arrival), rows.schema)
    return rows.withWatermark(arrival, delay).groupBy(*keys).transformWithState(processor, out, "Update", "EventTime")


def publish_first_prints(prints: DataFrame, table: VersionedTable, keys: Sequence[str], order: Sequence[str], checkpoint: str) -> StreamingQuery:
    """Keep ``table`` (whose columns are those of the stream without ``corrections``) at the first prints; a batch that is run again changes nothing."""

    first = [F.asc_nulls_last(c) for c in order]

    def take(batch: DataFrame, number: int) -> None:
        batch = batch.drop("corrections").persist()  # read twice, and the state should be moved on once
        try:
            table.merge(batch, keys, lambda current, rows: latest_by_window(current.unionByName(rows), keys, first), run=f"{checkpoint}#{number}")
        finally:
            batch.unpersist()

    return prints.writeStream.outputMode("update").option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(take).start()
