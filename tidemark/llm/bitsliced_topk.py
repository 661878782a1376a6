"""Exact top-k inner products by a bit-sliced index.

Each component becomes the integer floor(scale * x). A block of rows keeps, for every component, one bitmap per binary digit
(a slice) over its rows. A query adds the slices of all components, shifted and complemented as its own digits ask, with
full adders on whole bitmaps; the result is the slices of every row's score. The best k rows are then picked from the most
significant slice downward, and the rows that tie at the boundary are settled by the smaller id.

Blocks of rows and groups of queries form a grid; each cell is a task of bounded size and returns k rows a query. A block's index
goes to each group of queries once, so groups are as large as memory allows and as many as there are tasks to fill: the rows
sent grow with the blocks, not with the square of the table, until queries fill more than a group a task.

Defined cases: null vectors, vectors with a null or non-finite component, empty vectors and rows without an id take no part.
Vectors of different length have no product and never meet. Rows that share the query's id count as its own. Equal query
rows count once. Fewer than k candidates: all of them.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Rows of a block, and queries of a group at most and at least: they bound the memory of a task.
BLOCK_ROWS, QUERY_GROUP, LEAST_GROUP = 65_536, 8_192, 128


def quantised(embedding: Column, scale: int) -> Column:
    return F.transform(embedding, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")))


def taking_part(vec_id: Column, embedding: Column) -> Column:
    bad = F.exists(embedding, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == F.lit(float("inf"))))
    return vec_id.isNotNull() & embedding.isNotNull() & (F.size(embedding) > 0) & ~bad


def _matrix(column: pa.ChunkedArray, dims: int) -> np.ndarray:
    return np.asarray(column.combine_chunks().flatten()).astype(np.int64).reshape(-1, dims)


def _packed(bits: np.ndarray, words: int) -> np.ndarray:
    out = np.zeros(words * 8, np.uint8)
    raw = np.packbits(bits, bitorder="little")
    out[: len(raw)] = raw
    return out.view(np.uint64)


def build_block(key, rows):
    """One row: ids in ascending order and the slices of all components, each offset by its least value in the block."""
    dims, block = key[0].as_py(), key[1].as_py()
    ids = np.asarray(rows["vec_id"].combine_chunks())
    order = np.argsort(ids, kind="stable")
    ids, x = ids[order], _matrix(rows["v"], dims)[order]
    low = x.min(axis=0)
    x = x - low
    digits = max(1, int(x.max()).bit_length())
    words = (len(ids) + 63) // 64
    slices = np.empty((dims, digits, words), np.uint64)
    for d in range(dims):
        for b in range(digits):
            slices[d, b] = _packed((x[:, d] >> b) & 1, words)
    return pa.table(
        {
            "dims": pa.array([dims], pa.int32()),
            "block": pa.array([block], pa.int64()),
            "digits": pa.array([digits], pa.int32()),
            "ids": pa.array([ids.astype(np.int64).tobytes()], pa.binary()),
            "low": pa.array([low.tobytes()], pa.binary()),
            "slices": pa.array([slices.tobytes()], pa.binary()),
        }
    )


def signed_digits(q: int) -> list[tuple[int, int]]:
    """(place, +1 or -1) with no two neighbours, which needs the fewest additions."""
    out, place = [], 0
    while q:
        if q & 1:
            digit = 2 - (q & 3)
            out.append((place, digit))
            q -= digit
        q >>= 1
        place += 1
    return out


class Block:
    def __init__(self, ids: np.ndarray, low: np.ndarray, slices: np.ndarray):
        self.ids, self.low, self.slices = ids, low, slices
        self.full = (1 << slices.shape[1]) - 1
        self.rows = np.full(slices.shape[2], np.uint64(0xFFFFFFFFFFFFFFFF))
        if tail := len(ids) % 64:
            self.rows[-1] = np.uint64((1 << tail) - 1)
        self.complement = np.bitwise_not(slices)

    def score_slices(self, q: list[int]) -> tuple[list[np.ndarray], int]:
        """Slices of sum(q * x) + constant over the rows, least significant first."""
        piles: list[list[np.ndarray]] = []
        constant = 0
        for d, value in enumerate(q):
            constant += value * int(self.low[d])
            for place, sign in signed_digits(value):
                side = self.slices[d] if sign > 0 else self.complement[d]
                if sign < 0:  # -x = (full - x) - full
                    constant -= self.full << place
                while len(piles) < place + len(side):
                    piles.append([])
                for b in range(len(side)):
                    piles[place + b].append(side[b])
        out, j = [], 0
        while j < len(piles):
            pile = piles[j]
            if len(pile) > 1 and j + 1 == len(piles):
                piles.append([])
            while len(pile) > 2:
                a, b, c = pile.pop(), pile.pop(), pile.pop()
                t = a ^ b
                pile.insert(0, t ^ c)
                t &= c
                a = a & b
                a |= t
                piles[j + 1].append(a)
            if len(pile) == 2:
                a, b = pile
                piles[j + 1].append(a & b)
                pile = [a ^ b]
            out.append(pile[0] if pile else np.zeros_like(self.rows))
            j += 1
        return out, constant

    def top(self, query_id: int, q: list[int], k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the best k rows but the query's own, equal scores by the smaller id."""
        slices, constant = self.score_slices(q)
        tied = self.rows.copy()
        for own in range(*np.searchsorted(self.ids, [query_id, query_id + 1])):
            tied[own // 64] &= ~np.uint64(1 << (own % 64))
        sure, n_sure = np.zeros_like(tied), 0
        for s in reversed(slices):
            upper = tied & s
            n = n_sure + int(np.bitwise_count(upper).sum())
            if n > k:
                tied = upper
            else:
                sure, n_sure = sure | upper, n
                tied = tied & ~s
                if n == k:
                    tied = np.zeros_like(tied)
                    break
        if n_sure < k:
            edge = np.flatnonzero(np.unpackbits(tied.view(np.uint8), bitorder="little"))[: k - n_sure]
            rows = np.concatenate([np.flatnonzero(np.unpackbits(sure.view(np.uint8), bitorder="little")), edge])
        else:
            rows = np.flatnonzero(np.unpackbits(sure.view(np.uint8), bitorder="little"))
        place, shift = rows // 64, (rows % 64).astype(np.uint64)
        scores = np.full(len(rows), constant, np.int64)
        for j, s in enumerate(slices):
            scores += ((s[place] >> shift) & np.uint64(1)).astype(np.int64) << j
        return self.ids[rows], scores


def exact_top_k(
    vectors: DataFrame,
    is_query: Column,
    k: int = 20,
    scale: int = 64,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    block_rows: int = BLOCK_ROWS,
    query_group: int = QUERY_GROUP,
) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k best rows of each row of ``vectors`` for which ``is_query`` holds."""
    rows = vectors.where(taking_part(F.col(vec_id), F.col(embedding))).select(
        F.col(vec_id).cast("long").alias("vec_id"), quantised(F.col(embedding), scale).alias("v"), is_query.alias("q")
    )
    rows = rows.withColumn("dims", F.size("v"))
    sizes = rows.groupBy("dims").agg(F.count("*").alias("n"), F.sum(F.col("q").cast("int")).alias("nq")).collect()
    n_blocks = F.create_map(*[F.lit(x) for r in sizes for x in (r.dims, -(-r.n // block_rows))]) if sizes else F.create_map(F.lit(0), F.lit(1))
    tasks = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def groups_for(n: int, queries: int) -> int:
        fill = min(-(-queries // min(LEAST_GROUP, query_group)), -(-tasks * block_rows // max(n, 1)))
        return max(1, -(-queries // query_group), fill)

    n_groups = F.create_map(*[F.lit(x) for r in sizes for x in (r.dims, groups_for(r.n, r.nq or 0))]) if sizes else F.create_map(F.lit(0), F.lit(1))
    blocks, groups = n_blocks[F.col("dims")], n_groups[F.col("dims")]

    index = rows.withColumn("block", F.pmod(F.xxhash64("vec_id"), blocks).cast("long")).groupBy("dims", "block").applyInArrow(
        build_block, "dims int, block long, digits int, ids binary, low binary, slices binary"
    )
    index = index.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), groups.cast("long") - 1)))
    queries = (
        rows.where("q")
        .select("vec_id", "v", "dims", F.xxhash64("v").alias("own"))
        .distinct()
        .withColumn("part", F.pmod(F.xxhash64("vec_id", F.lit(1)), groups).cast("long"))
        .withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), blocks.cast("long") - 1)))
    )

    def cell(key, left, right):
        out_q, out_o, out_n, out_s = [], [], [], []
        if left.num_rows and right.num_rows:
            dims, digits = left["dims"][0].as_py(), left["digits"][0].as_py()
            ids = np.frombuffer(left["ids"][0].as_py(), np.int64)
            block = Block(
                ids, np.frombuffer(left["low"][0].as_py(), np.int64), np.frombuffer(left["slices"][0].as_py(), np.uint64).reshape(dims, digits, -1)
            )
            for q, own, v in zip(right["vec_id"].to_pylist(), right["own"].to_pylist(), _matrix(right["v"], dims).tolist(), strict=True):
                found, scores = block.top(q, v, k)
                out_q.append(np.full(len(found), q, np.int64))
                out_o.append(np.full(len(found), own, np.int64))
                out_n.append(found)
                out_s.append(scores)
        flat = lambda parts: np.concatenate(parts) if parts else np.zeros(0, np.int64)
        return pa.table({"query_id": flat(out_q), "own": flat(out_o), "vec_id": flat(out_n), "score": flat(out_s)})

    keys = ["dims", "block", "part"]
    found = index.groupBy(*keys).cogroup(queries.groupBy(*keys)).applyInArrow(cell, "query_id long, own long, vec_id long, score long")
    best = Window.partitionBy("query_id", "own").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
