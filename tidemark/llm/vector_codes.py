"""Vector code compression: product codes by exact nearest entries, with the entries to look at memoised per grid cell.

A vector's components become integers floor(scale * x) and the vector is cut into equal parts. Each part position has a codebook of
up to 256 entries that starts as that part of the first vectors by id; rounds of assigning and averaging (floors) follow; at last each part
is replaced by the number of its nearest entry.

Assignment goes over a grid. A part's coarse cell is its components shifted right by ``cell_bits``. For a cell, an entry is dominated
if its least distance to any point of the cell's box is above the greatest distance that some other entry can have within the box;
such an entry is nearest to no point of it, ties included. The entries that are left are kept under the cell's hash (and its
coordinates, so that equal hashes of different cells do no harm) and only they are evaluated exactly, for this part and all later ones
of the cell. A task's memo is emptied when it holds ``memo_cells``; answers don't depend on what it holds, nor on the cells' size. Smaller cells
leave fewer entries and are met again less often: of vectors of 64 normal components, in cells of 64 where a component's deviation
is 128, 52 of 256 entries are left and 1 cell in 70 comes again among 10,000 vectors; copies always meet theirs again.

Codebooks are 256 vectors, whatever the table's size, and go to the tasks with the function. A task sends one row of sums per
entry and part that it has met, so a hot cell or entry costs one row a task. The integers are written once to the shared folder
and read by each round.

Defined cases: rows whose vector is null, empty, or holds null, NaN or infinite components take no part, nor do components that reach 2 ** 26
as integers, which distances in 64 bits could not hold. The vector length is that of the least id whose length parts
evenly; vectors of other lengths take no part. Fewer rows than entries: codebooks have one entry per row. Rows that share an id are rows of
their own and count by their components when the first are picked; a null id comes last. Equal distances go to the
lower entry. Entries that nothing is nearest to stay as they are. An empty table gives an empty result. Ids are cast to long: those
that are no numbers are an error. Only the named columns are read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import Scratch, batches, release

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
#: Coarse cells are cubes of 2 ** CELL_BITS; a task keeps up to MEMO_CELLS of them for each part.
CELL_BITS, MEMO_CELLS = 6, 1 << 15
LARGEST = 1 << 26
#: Labels whose totals are sent to all tasks; more meet their rows by a shuffle.
SENT_LABELS = 100_000
#: Distances that are evaluated at once.
_AT_ONCE = 1 << 18


def _hashed(cells: np.ndarray) -> np.ndarray:
    h = np.zeros(len(cells), np.uint64)
    for column in cells.T:
        h = (h ^ column.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    return h


class Grid:
    """Nearest entries of one codebook, by memoised cells; of one task."""

    def __init__(self, entries: np.ndarray, cell_bits: int = CELL_BITS, memo_cells: int = MEMO_CELLS):
        self.entries, self.bits, self.most = entries.astype(np.int64), cell_bits, memo_cells
        self.memo: dict[int, tuple[bytes, np.ndarray]] = {}
        #: Cells worked out, parts asked for, and distances evaluated.
        self.worked = self.asked = self.evaluated = 0

    def _undominated(self, cells: np.ndarray) -> list[np.ndarray]:
        """For each cell the entries that may be nearest to a point of its box, ascending."""
        low = cells << self.bits
        high = low + (1 << self.bits) - 1
        out = []
        step = max(1, _AT_ONCE // max(1, len(self.entries)))
        for at in range(0, len(cells), step):
            nearest = np.zeros((len(cells[at : at + step]), len(self.entries)), np.int64)
            farthest = np.zeros_like(nearest)
            for d in range(cells.shape[1]):
                under = low[at : at + step, d, None] - self.entries[None, :, d]
                over = self.entries[None, :, d] - high[at : at + step, d, None]
                nearest += np.maximum(np.maximum(under, over), 0) ** 2
                farthest += np.maximum(np.abs(under), np.abs(over)) ** 2
            held = nearest <= farthest.min(axis=1, keepdims=True)
            out += [np.flatnonzero(row) for row in held]
        self.worked += len(cells)
        return out

    def candidates(self, parts: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
        """The undominated entries of the distinct cells, and the cell of each part."""
        cells = parts >> self.bits
        _, first, which = np.unique(_hashed(cells), return_index=True, return_inverse=True)
        if (cells[first][which] != cells).any():  # two cells share a hash
            _, first, which = np.unique(cells, axis=0, return_index=True, return_inverse=True)
            which = which.reshape(-1)
        keys, distinct = _hashed(cells[first]).tolist(), cells[first]
        found: list[np.ndarray | None] = []
        for key, cell in zip(keys, distinct, strict=True):
            known = self.memo.get(key)
            found.append(known[1] if known is not None and known[0] == cell.tobytes() else None)
        new = [k for k, f in enumerate(found) if f is None]
        if new:
            if len(self.memo) + len(new) > self.most:
                self.memo.clear()
            for k, entries in zip(new, self._undominated(distinct[new]), strict=True):
                found[k] = entries
                if len(self.memo) < self.most:
                    self.memo[keys[k]] = (distinct[k].tobytes(), entries.astype(np.uint8))
        return found, which

    def nearest(self, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(entry, squared distance) of each part, ties to the lower entry."""
        found, which = self.candidates(parts)
        sizes = np.array([len(f) for f in found], np.int64)[which] if len(parts) else np.zeros(0, np.int64)
        entry, distance = np.empty(len(parts), np.int64), np.empty(len(parts), np.int64)
        self.asked += len(parts)
        self.evaluated += int(sizes.sum())
        ends = np.cumsum(sizes)
        at = 0
        while at < len(parts):
            stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + _AT_ONCE)))
            n = sizes[at:stop]
            listed = np.concatenate([found[k] for k in which[at:stop]]).astype(np.int64)
            own = np.repeat(np.arange(at, stop), n)
            d = np.zeros(len(listed), np.int64)
            for k in range(parts.shape[1]):
                d += (parts[own, k] - self.entries[listed, k]) ** 2
            starts = np.cumsum(n) - n
            least = np.minimum.reduceat(d, starts)
            # the first of equals, since a cell's entries ascend
            place = np.where(d == np.repeat(least, n), np.arange(len(d)), len(d))
            entry[at:stop] = listed[np.minimum.reduceat(place, starts)]
            distance[at:stop] = least
            at = stop
        return entry, distance


def _matrix(column: pa.ListArray, parts: int) -> list[np.ndarray]:
    """The parts of the vectors, each as a matrix of integers."""
    flat = np.asarray(column.flatten())
    whole = flat.reshape(len(column), -1) if len(column) else flat.reshape(0, parts)
    return np.split(whole, parts, axis=1)


def _sums(books: list[np.ndarray], cell_bits: int, memo_cells: int):
    """Per task: for each part and entry the sum of what is nearest to it, and how many."""

    def run(rows):
        grids = [Grid(b, cell_bits, memo_cells) for b in books]
        sums, counts = [np.zeros(b.shape, np.int64) for b in books], [np.zeros(len(b), np.int64) for b in books]
        for batch in batches(rows):
            for k, x in enumerate(_matrix(batch.column(0), len(books))):
                entry, _ = grids[k].nearest(x)
                np.add.at(sums[k], entry, x)
                counts[k] += np.bincount(entry, minlength=len(counts[k]))
        met = [(k, e) for k, c in enumerate(counts) for e in np.flatnonzero(c).tolist()]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([k for k, _ in met], pa.int32()),
                pa.array([e for _, e in met], pa.int32()),
                pa.array([sums[k][e].tolist() for k, e in met], pa.list_(pa.int64())),
                pa.array([int(counts[k][e]) for k, e in met], pa.int64()),
            ],
            names=["part", "entry", "sums", "n"],
        )
        release()

    return run


def _codes(books: list[np.ndarray], cell_bits: int, memo_cells: int):
    def run(rows):
        grids = [Grid(b, cell_bits, memo_cells) for b in books]
        for batch in batches(rows):
            found = [grids[k].nearest(x) for k, x in enumerate(_matrix(batch.column(1), len(books)))]
            codes = [bytes(row).hex() for row in np.stack([e for e, _ in found], axis=1).astype(np.uint8)] if batch.num_rows else []
            error = sum((d for _, d in found), np.zeros(batch.num_rows, np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(codes, pa.string()), pa.array(error, pa.int64())], names=["vec_id", "label", "code", "error"])
        release()

    return run


class Codebooks:
    """Codebooks of a table of vectors, and the codes that they give."""

    def __init__(
        self,
        vectors: DataFrame,
        vec_id: str = "vec_id",
        vector: str = "embedding",
        label: str = "label",
        parts: int = PARTS,
        entries: int = ENTRIES,
        rounds: int = ROUNDS,
        scale: int = SCALE,
        cell_bits: int = CELL_BITS,
        memo_cells: int = MEMO_CELLS,
    ):
        if not 1 <= entries <= 256:
            raise ValueError("a code's part is one byte: 1 to 256 entries")
        self.parts, self.cells = parts, (cell_bits, memo_cells)
        self.scratch = Scratch(vectors.sparkSession)
        x = F.col(f"`{vector}`")
        sound = x.isNotNull() & (F.size(x) > 0) & (F.size(x) % parts == 0)
        sound = sound & F.forall(x, lambda c: F.coalesce(F.abs(c.cast("double")) < LARGEST / scale, F.lit(False)))
        rows = vectors.where(sound).select(
            F.col(f"`{vec_id}`").cast("long").alias("vec_id"),
            F.transform(x, lambda c: F.floor(c.cast("double") * scale)).alias("v"),
            F.col(f"`{label}`").alias("label"),
        )
        self.label_type = rows.schema["label"].dataType.simpleString()
        rows = self.scratch.keep(rows, "integers")
        first = rows.orderBy(F.asc_nulls_last("vec_id"), "v").select("v")
        length = first.select(F.size("v")).head()
        self.rows = rows.where(F.size("v") == length[0]) if length else rows
        start = np.array([r.v for r in first.where(F.size("v") == length[0]).limit(entries).collect()], np.int64) if length else np.zeros((0, parts), np.int64)
        self.books = np.split(start, parts, axis=1)
        for _ in range(rounds if length else 0):
            self._average()

    def _average(self) -> None:
        size = self.books[0].shape[1]
        met = self.rows.select("v").mapInArrow(_sums(self.books, *self.cells), "part int, entry int, sums array<long>, n long")
        totals = met.groupBy("part", "entry").agg(F.sum("n").alias("n"), *[F.sum(F.col("sums")[i]).alias(f"s{i}") for i in range(size)])
        books = [b.copy() for b in self.books]
        for part, entry, n, *sums in totals.collect():  # parts * entries rows at most
            books[part][entry] = [s // n for s in sums]
        self.books = books

    def sha256(self) -> str:
        """Digest of the decimal components by part, entry and position."""
        return hashlib.sha256(",".join(str(x) for b in self.books for x in b.reshape(-1).tolist()).encode()).hexdigest()

    def codes(self) -> DataFrame:
        """vec_id, label, code (two hex digits a part), error (squared distances summed)."""
        kind = f"vec_id long, label {self.label_type}, code string, error long"
        return self.rows.select("vec_id", "v", "label").mapInArrow(_codes(self.books, *self.cells), kind)

    def decoded(self, codes: DataFrame, vector: str = "vector") -> DataFrame:
        """vec_id and the vector of integers that each code stands for."""
        books = self.books

        def run(rows):
            for batch in batches(rows):
                codes = np.frombuffer(b"".join(map(bytes.fromhex, batch.column(1).to_pylist())), np.uint8).reshape(batch.num_rows, len(books))
                whole = np.concatenate([b[codes[:, k]] for k, b in enumerate(books)], axis=1)
                offsets = np.arange(batch.num_rows + 1, dtype=np.int32) * whole.shape[1]
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(pa.array(offsets), pa.array(whole.reshape(-1)))], names=["vec_id", vector])

        return codes.select("vec_id", "code").mapInArrow(run, f"vec_id long, `{vector}` array<long>")

    def report(self) -> DataFrame:
        """vec_id, code, error, label_error (errors summed over rows of equal label, nulls together), codebooks_sha256."""
        coded = self.scratch.keep(self.codes(), "codes")
        totals = self.scratch.keep(coded.groupBy("label").agg(F.sum("error").alias("label_error")), "totals")
        other = totals.select(F.col("label").alias("of"), "label_error")
        other = F.broadcast(other) if totals.count() <= SENT_LABELS else other
        out = coded.join(other, F.col("label").eqNullSafe(F.col("of")))
        return out.select("vec_id", "code", "error", "label_error", F.lit(self.sha256()).alias("codebooks_sha256"))
