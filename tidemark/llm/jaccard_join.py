"""N-gram Jaccard join by T-occurrence search with DivideSkip, and the components of its links.

A document is its set of distinct shingles, each a hash of 64 bits. Two documents link when 100 * |x & y| >= percent * |x | y|.

1. Signatures, for 90 percent and more. Linked sets of sizes a and b differ in at most D = (100 - percent) * (a + b) / (100 + percent) shingles. With the
   hash range cut into D + 1 segments, some segment holds the same shingles in both. Sizes fall into classes such that linked
   sets lie in one class or two neighbours; a document writes one signature for every segment of its own class and the next.
   Equal signatures meet by a shuffle, after each batch of documents has met its own: a signature that many documents share
   leaves a batch once. A segment may be empty in both sets; so a set with an empty segment writes those of another salt too,
   until a salt leaves none empty, and only after the last salt are empty ones written. No link can be lost.
   Below 90 percent a segment would hold two or three shingles and tell little. There prefixes are used: with shingles in any
   order that is the same for all, linked sets share l of the first |x| - T + l of either. In order of hashes and with l a
   twentieth of the set, a document goes on only if l of these shingles occur in other documents; few but near duplicates do.
   Those that go on count half of their shingles (by hash) exactly, and meet over the rarest |x| - T + 1, so that a passage
   which many documents share brings none together.
2. Candidate groups. Documents that share signatures (or rare shingles) form components (large-star, small-star); any link lies within one.
   Documents with equal sets are linked by that, and one of them stands for all.
3. Search. A group is cut into blocks of bounded size, all of which also hold a few pivots. Each block has an inverted index;
   each document asks for those that share T of its shingles. DivideSkip sets the longest lists aside, merges the short ones
   with a heap, and probes the long ones by binary search. Documents that are linked already need no second search.
4. Across blocks, only documents outside a group's largest component are searched for in the other blocks: two documents of
   different blocks are either both in the largest component, or one of them is searched for.

Pairs are never listed, a group never meets in one task, and no cap drops a link.

A shingle or signature that very many documents share has as many rows as there are batches of documents, since a batch sends it once.

Defined cases: null, empty and wordless texts have no shingles and link with nothing. Fewer words than the shingle's length
make one shingle of all. Texts of any length are read whole. Rows that share a doc_id are one node. A null doc_id is its own row,
without component. Ids are cast to long: those that are no numbers are an error. Only the named columns are read.
"""

from __future__ import annotations

import heapq
from bisect import bisect_left
from itertools import groupby

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import Scratch, batches, release, utf8

BLOCK_DOCS, PIVOTS, SALTS = 256, 16, 8
#: Texts of an Arrow batch.
TEXTS = 2000
_MULT = np.array([pow(0x9E3779B97F4A7C15, 2 * i + 1, 1 << 64) for i in range(12)], np.uint64)
SIGNATURE, CANDIDATE, EQUAL_SETS, EQUAL, SIZE, TOKEN, MANY, CREDIT = range(8)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_sets(bodies: list[bytes], length: int) -> list[np.ndarray]:
    """For each text the sorted hashes of its distinct shingles. A-Z count as a-z; words part at ASCII white space."""
    docs = [b.lower().split() for b in bodies]
    place = {w: i for i, w in enumerate({w for d in docs for w in d})}
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, place), np.uint64, len(place))
    out = []
    for words in docs:
        n = len(words)
        if not n:
            out.append(np.zeros(0, np.uint64))
            continue
        h = hashes[np.fromiter(map(place.__getitem__, words), np.int64, n)]
        k = min(n, length)
        s = np.full(n - k + 1, k, np.uint64)
        for i in range(k):
            s += h[i : n - k + 1 + i] * _MULT[i % 8] + np.uint64(i)
            s = _mix(s)
        out.append(np.unique(s))
    return out


def size_class(n: int, percent: int) -> tuple[int, int, int]:
    """(class, its largest size, the next class's largest size); linked sets lie in one class or two neighbours."""
    k, low = 0, 1
    while (high := 100 * low // percent) < n:
        k, low = k + 1, high + 1
    return k, high, 100 * (high + 1) // percent


def signatures(x: np.ndarray, percent: int, classes: dict[int, tuple[int, int, int]]) -> np.ndarray:
    n = len(x)
    if n not in classes:
        classes[n] = size_class(n, percent)
    k, *highs = classes[n]
    found = []
    for j, high in enumerate(highs):
        m = 2 * high * (100 - percent) // (100 + percent) + 1
        bounds = np.arange(1, m, dtype=np.uint64) * np.uint64(((1 << 64) - 1) // m)
        for salt in range(SALTS):
            s = x if not salt else np.sort(x * _MULT[salt])
            edges = np.concatenate([[0], np.searchsorted(s, bounds), [n]])
            sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_mix(s + _MULT[9]), dtype=np.uint64)])
            sizes = np.diff(edges)
            content = sums[edges[1:]] - sums[edges[:-1]]
            where = np.arange(m, dtype=np.uint64) * _MULT[10] + np.full(1, (k + j) * SALTS + salt, np.uint64) * _MULT[11]
            sig = _mix(_mix(content + sizes.astype(np.uint64)) + where)
            empty = sizes == 0
            if not empty.any():
                found.append(sig)
                break
            found.append(sig if salt == SALTS - 1 else sig[~empty])
    return np.concatenate(found)


def set_key(x: np.ndarray) -> np.ndarray:
    return _mix(_mix(x + _MULT[8]).sum(dtype=np.uint64, keepdims=True) + np.uint64(len(x)))


def _met(keys: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Each key once with its least document, and the pairs (least document, other) of keys that several have."""
    order = np.lexsort((docs, keys))
    keys, docs = keys[order], docs[order]
    first = np.ones(len(keys), bool)
    first[1:] = keys[1:] != keys[:-1]
    least = docs[np.flatnonzero(first)][np.cumsum(first) - 1] if len(keys) else docs
    other = least != docs
    pairs = np.unique(np.stack([least[other], docs[other]]), axis=1) if other.any() else np.zeros((2, 0), np.int64)
    return keys[first], docs[first], pairs[0], pairs[1]


def rows_of(kind, a, b):
    return pa.RecordBatch.from_arrays([pa.array(np.full(len(a), kind, np.int32)), pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["kind", "a", "b"])


def least_overlap(n: int, percent: int) -> int:
    """Shingles that a set of n shares with any it links with, at least."""
    return -(-percent * n // 100)


def extra(n: int) -> int:
    return max(1, n // 20)


def _prefix_sketch(length: int, percent: int):
    """Sizes, keys of equal sets, and the first shingles of each document; those that several of a batch have leave it once."""

    def run(rows):
        for batch in batches(rows, 5000):
            ids = batch.column(0).to_pylist()
            tokens, owners, keys, sizes = [], [], [], []
            for at in range(0, len(ids), 1000):
                for doc, x in zip(ids[at : at + 1000], shingle_sets(utf8(batch.column(1).slice(at, 1000)), length), strict=True):
                    sizes.append(len(x))
                    if len(x) and doc is not None:
                        tokens.append(x[: len(x) - least_overlap(len(x), percent) + extra(len(x))])
                        keys.append(set_key(x))
                        owners.append(doc)
            yield rows_of(SIZE, ids, sizes)
            if not owners:
                continue
            docs = np.array(owners, np.int64)
            token, own = np.concatenate(tokens).view(np.int64), np.repeat(np.arange(len(docs)), [len(t) for t in tokens])
            yield from _in_batch(token, own, docs)
            key, doc, a, b = _met(np.concatenate(keys).view(np.int64), docs)
            yield rows_of(EQUAL_SETS, key, doc)
            yield rows_of(EQUAL, a, b)

    return run


def _half_tokens(length: int, percent: int):
    """Of each document the shingles of the lower half of hashes, and as many more as its prefix needs; a batch sends a shingle once,
    with all its documents: rows (a: shingle, docs: document, prefix and half in shingles)."""
    item = pa.struct([("b", pa.int64()), ("needs", pa.int32()), ("half", pa.int32())])

    def run(rows):
        for batch in batches(rows, 1000):
            ids = np.asarray(batch.column(0))
            sets = shingle_sets(utf8(batch.column(1)), length)
            halves = np.array([np.searchsorted(x, np.uint64(1 << 63)) for x in sets], np.int64)
            needs = np.array([len(x) - least_overlap(len(x), percent) + 1 if len(x) else 0 for x in sets], np.int64)
            n = np.maximum(halves, needs)
            token = np.concatenate([x[:k] for x, k in zip(sets, n, strict=True)] or [np.zeros(0, np.uint64)]).view(np.int64)
            own = np.repeat(np.arange(len(sets)), n)
            order = np.argsort(token, kind="stable")
            token, own = token[order], own[order]
            first = np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1]])) if len(token) else np.zeros(0, np.int64)
            docs = pa.StructArray.from_arrays([pa.array(ids[own], pa.int64()), pa.array(needs[own], pa.int32()), pa.array(halves[own], pa.int32())], fields=list(item))
            lists = pa.ListArray.from_arrays(pa.array(np.append(first, len(token)), pa.int32()), docs)
            yield pa.RecordBatch.from_arrays([pa.array(token[first]), lists], names=["a", "docs"])

    return run


def _meet(rows):
    """Rows (a: key, b: document): a batch sends each key once, with its least document, and links the others to that one."""
    for batch in rows:
        key, doc, a, b = _met(np.asarray(batch.column(0)), np.asarray(batch.column(1)))
        yield rows_of(SIGNATURE, key, doc)
        yield rows_of(CANDIDATE, a, b)


def prefix_candidates(rows: DataFrame, sketch: DataFrame, equal: DataFrame, length: int, percent: int, scratch: Scratch) -> DataFrame:
    """Rows (a: shingle, b: document); linked documents whose sets differ have one in common."""
    # one shuffle serves all shingles: a batch of documents has met before and sends one that several have once
    credit = met_credit(sketch, scratch, "credit")
    size = sketch.where(F.col("kind") == SIZE).select(F.col("a").alias("b"), F.col("b").alias("size"))
    # the smaller of two linked sets has at least percent of the larger's shingles, and a twentieth of it is shared
    least = F.greatest(F.floor(F.floor(F.col("size") * percent / 100) / 20), F.lit(1))
    alive = size.join(credit, "b").where(F.col("n") >= least).select("b").distinct().join(equal.select("b").distinct(), "b", "left_anti")
    alive = scratch.keep(alive, "alive")
    half = alive.join(rows.withColumnRenamed("doc", "b"), "b").mapInArrow(_half_tokens(length, percent), "a long, docs array<struct<b:long,needs:int,half:int>>")
    half = half.withColumn("df", F.sum(F.size("docs")).over(Window.partitionBy("a"))).where("df > 1")
    # hashes of the upper half are negative as signed numbers
    half = half.select("a", "df", (F.col("a") < 0).alias("beyond"), F.explode("docs").alias("d")).select("a", "df", "beyond", "d.*")
    within = Window.partitionBy("b", "beyond")
    seldom = half.withColumn("place", F.row_number().over(within.orderBy("df", "a")) + F.col("half") - F.count("*").over(within))
    return scratch.keep(seldom.where("beyond OR place <= needs").select("a", "b"), "seldom", records=TEXTS)


def met_credit(sketch: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """(b: document, n: how many of the shingles it sent several documents have), of the rows of kinds TOKEN, MANY and CREDIT. A shingle has
    one row a batch at most."""
    same = Window.partitionBy("a")
    tokens = sketch.where(F.col("kind").isin(TOKEN, MANY)).withColumn("met", (F.count("*").over(same) > 1) | (F.max("kind").over(same) == MANY))
    credit = tokens.where(F.col("met") & (F.col("kind") == TOKEN)).groupBy("b").agg(F.count("*").alias("n"))
    return credit.unionByName(sketch.where(F.col("kind") == CREDIT).select(F.col("a").alias("b"), F.col("b").alias("n"))).groupBy("b").agg(F.sum("n").alias("n"))


def _in_batch(token: np.ndarray, own: np.ndarray, docs: np.ndarray):
    """Of a batch's (shingle, place of its document): those of one document, those of several once, and how many of the latter each has."""
    _, at, n = np.unique(token, return_inverse=True, return_counts=True)
    several = n[at] > 1
    yield rows_of(TOKEN, token[~several], docs[own[~several]])
    shared = np.unique(token[several])
    yield rows_of(MANY, shared, np.zeros(len(shared), np.int64))
    credit = np.bincount(own[several], minlength=len(docs))
    yield rows_of(CREDIT, docs[credit > 0], credit[credit > 0])


def _group_shingles(length: int):
    """All shingles of documents, told apart by their group: rows of ``_in_batch``, from columns group, node, body."""

    def run(rows):
        for batch in batches(rows, 1000):
            sets = shingle_sets(utf8(batch.column(2)), length)
            group = _mix(np.asarray(batch.column(0)).astype(np.int64).view(np.uint64) + _MULT[7])
            token = np.concatenate([_mix(x ^ g) for x, g in zip(sets, group, strict=True)] or [np.zeros(0, np.uint64)]).view(np.int64)
            yield from _in_batch(token, np.repeat(np.arange(len(sets)), [len(x) for x in sets]), np.asarray(batch.column(1)).astype(np.int64))

    return run


def hopeful(texts: DataFrame, sizes: DataFrame, length: int, percent: int, scratch: Scratch) -> DataFrame:
    """(group, node) of the documents that may link with another of their group; ``texts``: group, node, body; ``sizes``: node, size.

    Of s shingles that others of the group have too, at most s are shared with one of them, so a partner has at most
    s * (100 + percent) / percent - size shingles, and each must suit the other. Partners are looked for by bins of 5 percent of size, each of which
    keeps the largest partner that one of its documents can have. A family that shares a passage but is not alike goes here.
    """
    rows = scratch.keep(texts.select("group", "node", "body").mapInArrow(_group_shingles(length), "kind int, a long, b long"), "shared", "kind", records=TEXTS)
    credit = met_credit(rows, scratch, "shared").withColumnRenamed("b", "node")
    bounds = texts.select("group", "node").distinct().join(credit, "node").join(sizes, "node")
    largest = F.least(F.floor((F.col("n") * (100 + percent) - F.col("size") * percent) / percent), F.floor(F.col("size") * 100 / percent))
    bounds = bounds.withColumns({"most": largest, "least": F.ceil(F.col("size") * percent / 100)}).where("most >= least")
    of = lambda c: F.floor(F.log(F.col(c).cast("double")) / float(np.log(1.05)))
    bounds = scratch.keep(bounds.select("group", "node", "size", "most", of("size").alias("bin"), of("least").alias("from"), of("most").alias("to")), "bounds")
    bins = bounds.groupBy("group", "bin").agg(F.max("most").alias("top"), F.count("*").alias("k"))
    asked = bounds.select("group", "node", "size", F.col("bin").alias("own"), F.explode(F.sequence("from", "to")).alias("bin"))
    found = asked.join(bins, ["group", "bin"]).where("top >= size AND (bin <> own OR k > 1)")
    return found.select("group", "node").distinct()


def _sketch(length: int, percent: int):
    def run(rows):
        classes: dict[int, tuple[int, int, int]] = {}
        for batch in batches(rows, 5000):
            ids = batch.column(0).to_pylist()
            sigs, docs, keys, owners, sizes = [], [], [], [], []
            for at in range(0, len(ids), 1000):
                for doc, x in zip(ids[at : at + 1000], shingle_sets(utf8(batch.column(1).slice(at, 1000)), length), strict=True):
                    sizes.append(len(x))
                    if len(x) and doc is not None:
                        s = signatures(x, percent, classes)
                        sigs.append(s)
                        docs.append(np.full(len(s), doc, np.int64))
                        keys.append(set_key(x))
                        owners.append(doc)
            yield rows_of(SIZE, ids, sizes)
            if not owners:
                continue
            key, doc, a, b = _met(np.concatenate(sigs).view(np.int64), np.concatenate(docs))
            yield rows_of(SIGNATURE, key, doc)
            yield rows_of(CANDIDATE, a, b)
            key, doc, a, b = _met(np.concatenate(keys).view(np.int64), np.array(owners, np.int64))
            yield rows_of(EQUAL_SETS, key, doc)
            yield rows_of(EQUAL, a, b)

    return run


def _signatures(length: int, percent: int):
    """All signatures of each document, as rows (a: signature, b: document)."""

    def run(rows):
        classes: dict[int, tuple[int, int, int]] = {}
        for batch in batches(rows, 1000):
            sets = shingle_sets(utf8(batch.column(1)), length)
            found = [signatures(x, percent, classes) if len(x) else np.zeros(0, np.uint64) for x in sets]
            own = np.repeat(np.asarray(batch.column(0)), [len(x) for x in found])
            mark = np.concatenate(found or [np.zeros(0, np.uint64)]).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(mark), pa.array(own, pa.int64())], names=["a", "b"])

    return run


def meetings(placed: DataFrame, marks: DataFrame, scratch: Scratch) -> DataFrame:
    """Cells (group, block, node, asks) in which every two documents that share a mark and have different roots meet, if one of them
    has a tile. ``placed``: group, node, root, block, tile; ``marks``: a (mark), b (document).

    A cell is one tile and one block: of the tile the documents that share a mark with another root's document of the block,
    which ask, and the other way round. It holds a tile and a block at most, whatever the group's size.
    """
    marked = scratch.keep(placed.join(marks.select(F.col("a").alias("mark"), F.col("b").alias("node")), "node").distinct(), "marked")
    ends, asking = (F.min("root").alias("low"), F.max("root").alias("high")), marked.where("tile IS NOT NULL")
    blocks = marked.groupBy("group", "mark", "block").agg(*ends)
    tiles = asking.groupBy("group", "mark", "tile").agg(*ends)
    names = ["group", "tile", "block", "node"]
    asks = asking.drop("block").join(blocks, ["group", "mark"]).where("low <> root OR high <> root").select(*names, F.lit(True).alias("asks"))
    answers = marked.drop("tile").join(tiles, ["group", "mark"]).where("low <> root OR high <> root").select(*names, F.lit(False).alias("asks"))
    cells = asks.unionByName(answers).groupBy(*names).agg(F.max("asks").alias("asks"))
    return cells.select("group", (F.col("tile") * F.lit(1 << 32) + F.col("block")).alias("block"), "node", "asks")


def star(pairs: DataFrame) -> DataFrame:
    """Rows (a: key, b: document) to links (a: least document of the key, b: another). A batch of documents has met before and sends a
    key once, so the rows of a very common one are as many as batches; one shuffle serves all keys."""
    least = F.min("b").over(Window.partitionBy("a"))
    return pairs.select(least.alias("least"), "b").where("least < b").select(F.col("least").alias("a"), "b").distinct()


def _contract(rows):
    """Per task: links to the least node of what the task's own links connect, so that fewer and shorter chains are left."""
    parent: dict[int, int] = {}

    def find(i: int) -> int:
        while (up := parent.setdefault(i, i)) != i:
            parent[i] = i = parent[up]
        return i

    for batch in rows:
        for u, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            u, v = find(u), find(v)
            parent[max(u, v)] = min(u, v)
            if len(parent) > 1_000_000:  # what is held is sent on, and the next links start afresh
                found = [(i, r) for i in parent if (r := find(i)) != i]
                yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in found], pa.int64()), pa.array([x for _, x in found], pa.int64())], names=["u", "v"])
                parent.clear()
    found = [(i, r) for i in parent if (r := find(i)) != i]
    yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in found], pa.int64()), pa.array([x for _, x in found], pa.int64())], names=["u", "v"])


def components(edges: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """(node, root) of all nodes that the edges (a, b) touch but the roots; a root is its component's least node.

    Links are contracted within each task; then large-star and small-star steps by turns, each of them one aggregation and one
    join, until nothing changes. The least node of a large component is a key of many rows: the aggregations combine them before
    the shuffle, and the joins are plain ones, which adaptive execution splits when a key is skewed. Links that several tasks
    have found are as many rows until the end; a step makes no row more than it reads.
    """
    said = F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")).alias("hash"), F.count(F.lit(1)).alias("n")
    links = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    edges = scratch.keep(links.mapInArrow(_contract, "u long, v long").distinct(), f"{name}-0")
    before, i = None, 0
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
        i += 1
        seen = Observation()
        after_edges = scratch.keep(small.where("u <> v").observe(seen, *said), f"{name}-{i}")
        scratch.drop(f"{name}-{i - 1}")
        edges = after_edges
        after = (seen.get["n"], seen.get["hash"])
        if after == before or not after[0]:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).distinct()
        before = after


class Joined:
    """Which documents of a block are linked so far."""

    def __init__(self, n: int):
        self.parent = list(range(n))

    def find(self, i: int) -> int:
        while self.parent[i] != i:
            self.parent[i] = i = self.parent[self.parent[i]]
        return i

    def join(self, i: int, j: int) -> None:
        i, j = self.find(i), self.find(j)
        self.parent[max(i, j)] = min(i, j)


def t_occurrence(lists: list[list[int]], t: int, mu: float = 0.0085) -> list[tuple[int, int]]:
    """(document, lists that hold it) for all documents in at least ``t`` of the ascending lists, by DivideSkip."""
    if len(lists) < t:
        return []
    lists = sorted(lists, key=len)
    longest = len(lists[-1])
    n_long = min(t - 1, int(t / (mu * np.log2(longest + 1) + 1))) if longest > 1 else t - 1
    short, long_ = lists[: len(lists) - n_long], lists[len(lists) - n_long :]
    need = t - n_long
    counts = [(doc, sum(1 for _ in same)) for doc, same in groupby(heapq.merge(*short))]
    held = [(doc, n) for doc, n in counts if n >= need]
    if not held:
        return []
    out = []
    if len(held) * 4 < longest or len(held) < 8:
        for doc, n in held:
            missed, slack = 0, n + n_long - t
            for one in long_:
                i = bisect_left(one, doc)
                if i == len(one) or one[i] != doc:
                    missed += 1
                    if missed > slack:
                        break
            else:
                out.append((doc, n + n_long - missed))
        return out
    docs, n = np.array([d for d, _ in held]), np.array([c for _, c in held])
    for one in long_:
        one = np.asarray(one)
        n = n + (one[np.minimum(np.searchsorted(one, docs), len(one) - 1)] == docs)
    return [(int(d), int(c)) for d, c in zip(docs, n, strict=True) if c >= t]


def links_of_block(sets: list[np.ndarray], asking: list[bool], percent: int, joined: Joined) -> None:
    """Join all linked documents of the block of which at least one asks."""
    owner = np.concatenate([np.full(len(x), i, np.int64) for i, x in enumerate(sets)])
    keys = np.concatenate(sets)
    order = np.lexsort((owner, keys))
    keys, owner = keys[order], owner[order]
    start = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    size = np.diff(np.concatenate([start, [len(keys)]]))
    start, size = start[size > 1], size[size > 1]
    shared, postings = keys[start], owner.tolist()
    sizes = [len(x) for x in sets]
    for i, x in enumerate(sets):
        if not asking[i]:
            continue
        at = np.searchsorted(shared, x)
        at = at[(at < len(shared)) & (shared[np.minimum(at, max(len(shared) - 1, 0))] == x)] if len(shared) else at[:0]
        t = -(-percent * len(x) // 100)
        if len(at) < t:
            continue
        mine = joined.find(i)
        done = {j for j in range(len(sets)) if joined.find(j) == mine or not percent * max(sizes[i], sizes[j]) <= 100 * min(sizes[i], sizes[j])}
        if len(done) == len(sets):
            continue
        lists = [postings[s : s + n] for s, n in zip(start[at].tolist(), size[at].tolist(), strict=True)]
        if len(done) > 1:
            lists = [kept for one in lists if (kept := [j for j in one if j not in done])]
        for j, common in t_occurrence(lists, t):
            if j != i and 100 * common >= percent * (sizes[i] + sizes[j] - common):
                joined.join(i, j)


def _search(length: int, percent: int):
    """Rows sorted by cell (group, block): cell columns, doc, asks, texts' column; one cell at a time is in memory."""

    def links(cell):
        sets = shingle_sets([body for _, _, body in cell], length)
        keep = [i for i, x in enumerate(sets) if len(x)]
        if len(keep) < 2:
            return [], []
        docs = [cell[i][0] for i in keep]
        joined = Joined(len(keep))
        links_of_block([sets[i] for i in keep], [cell[i][1] for i in keep], percent, joined)
        pairs = [(docs[joined.find(i)], docs[i]) for i in range(len(keep)) if docs[joined.find(i)] != docs[i]]
        return [p[0] for p in pairs], [p[1] for p in pairs]

    def run(rows):
        cell, key, a, b = [], None, [], []
        for batch in rows:
            for group, block, doc, asks, body in zip(*(c.to_pylist() for c in batch.columns[:4]), utf8(batch.column(4)), strict=True):
                if key != (group, block):
                    x, y = links(cell)
                    a, b, cell, key = a + x, b + y, [], (group, block)
                cell.append((doc, asks, body))
            if len(a) > 1000:
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])
                a, b = [], []
        x, y = links(cell)
        yield pa.RecordBatch.from_arrays([pa.array(a + x, pa.int64()), pa.array(b + y, pa.int64())], names=["a", "b"])
        release()

    return run


def near_duplicates(
    docs: DataFrame,
    length: int = 5,
    percent: int = 80,
    doc_id: str = "doc_id",
    text: str = "text",
    block_docs: int = BLOCK_DOCS,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id (least doc_id that links reach, its own included)."""
    spark: SparkSession = docs.sparkSession
    scratch = Scratch(spark)
    rows = docs.select(F.col(doc_id).cast("long").alias("doc"), F.col(text).cast("string").alias("body"))
    by_segments = percent >= 90
    sketch = scratch.keep(rows.mapInArrow((_sketch if by_segments else _prefix_sketch)(length, percent), "kind int, a long, b long"), "sketch", "kind", records=TEXTS)
    part = lambda kind: sketch.where(F.col("kind") == kind).select("a", "b")

    equal = scratch.keep(part(EQUAL).unionByName(star(part(EQUAL_SETS))), "equal")
    if by_segments:
        candidates = part(CANDIDATE).unionByName(star(part(SIGNATURE)))
    else:
        marks = prefix_candidates(rows, sketch, equal, length, percent, scratch)
        met = scratch.keep(marks.mapInArrow(_meet, "kind int, a long, b long"), "met", "kind")
        candidates = met.where(F.col("kind") == CANDIDATE).select("a", "b").unionByName(star(met.where(F.col("kind") == SIGNATURE).select("a", "b")))
    groups = components(candidates, scratch, "groups")
    groups = groups.unionByName(groups.select(F.col("root").alias("node"), "root").distinct())
    # of equal sets only the least document is searched; what it links with, the others do
    stand_ins = groups.join(equal.select(F.col("b").alias("node")).distinct(), "node", "left_anti")
    counts = stand_ins.groupBy("root").agg(F.count("*").alias("n")).where("n > 1")
    grouped = scratch.keep(stand_ins.join(counts, "root").select("node", F.col("root").alias("group"), "n"), "grouped")
    texts = scratch.keep(grouped.join(rows.withColumnRenamed("doc", "node"), "node"), "texts", records=TEXTS)
    members = grouped.select("node", "group", "n", F.lit(1).cast("long").alias("blocks"))
    large = texts.where(F.col("n") > block_docs)
    if not large.isEmpty():
        size_of = part(SIZE).select(F.col("a").alias("node"), F.col("b").alias("size"))
        left = scratch.keep(hopeful(large, size_of, length, percent, scratch), "hopeful")
        counts = left.groupBy("group").agg(F.count("*").alias("n")).where("n > 1")
        left = left.join(counts, "group").select("node", "group", "n", F.ceil(F.col("n") / block_docs).alias("blocks"))
        members = members.where(F.col("n") <= block_docs).unionByName(left)
    members = scratch.keep(members, "members")
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("long")
    pivot = (F.col("blocks") > 1) & (F.pmod(F.xxhash64("node", F.lit(7)), F.lit(1 << 30)) * F.col("n") < F.lit(PIVOTS * (1 << 30)))
    everywhere = F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def searched(cells: DataFrame) -> DataFrame:
        full = cells.join(texts.select("node", "body"), "node").select("group", "block", "node", "asks", "body")
        full = full.repartition(parts, "group", "block").sortWithinPartitions("group", "block", "node")
        return full.mapInArrow(_search(length, percent), "a long, b long")

    cells = members.select("group", "node", F.lit(True).alias("asks"), F.explode(F.when(pivot, everywhere).otherwise(F.array(own))).alias("block"))
    links = scratch.keep(equal.unionByName(searched(cells)), "links", records=TEXTS)
    found = components(links, scratch, "found")
    many = members.where("blocks > 1")
    if not many.isEmpty():
        labelled = many.join(found, "node", "left").select("group", "node", own.alias("block"), F.coalesce("root", "node").alias("root"))
        most = labelled.groupBy("group", "root").agg(F.count("*").alias("k")).groupBy("group").agg(F.max_by("root", F.struct("k", "root")).alias("most"))
        labelled = scratch.keep(labelled.join(most, "group"), "labelled")
        rest = labelled.where("root <> most").groupBy("group").agg(F.ceil(F.count("*") / block_docs).alias("tiles"))
        if not rest.isEmpty():
            # links left to find have an end outside the group's largest component; such documents are cut into tiles
            tile = F.when(F.col("root") != F.col("most"), F.pmod(F.xxhash64("node", F.lit(11)), F.col("tiles")).cast("long")).alias("tile")
            placed = labelled.join(rest, "group").select("group", "node", "root", "block", tile)
            if by_segments:
                marks = placed.select("node").join(texts.select("node", "body"), "node").mapInArrow(_signatures(length, percent), "a long, b long")
            more = scratch.keep(searched(meetings(placed, marks, scratch)), "more", records=TEXTS)
            if not more.isEmpty():
                stars = found.select(F.col("root").alias("a"), F.col("node").alias("b"))
                found = components(stars.unionByName(more), scratch, "across")
    size = part(SIZE)
    out = size.join(found, F.col("a") == F.col("node"), "left")
    component = F.when(F.col("a").isNotNull(), F.coalesce("root", "a"))
    return out.select(F.col("a").alias("doc_id"), F.col("b").alias("n_shingles"), component.alias("component_id"))


def deduplicated(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **parameters) -> DataFrame:
    """``docs`` with one document of each component, that of the least doc_id; rows without a doc_id stay. Of rows that share an id
    the one of the least text stays (a null text last), and of equal texts the one of the least hash of the other columns."""
    found = near_duplicates(docs, doc_id=doc_id, text=text, **parameters)
    # most ids have nothing to say: one row, and it stays
    said = found.groupBy(F.col("doc_id").alias("__id")).agg(F.max(F.col("doc_id") != F.col("component_id")).alias("__gone"), F.count("*").alias("__n"))
    said = said.where("__id IS NOT NULL AND (__gone OR __n > 1)")
    kept = docs.join(said, F.col(doc_id) == F.col("__id"), "left").where("__gone IS NULL OR NOT __gone")
    others = [F.col(f"`{c}`") for c in docs.columns if c not in (doc_id, text)]
    first = Window.partitionBy("__id").orderBy(F.asc_nulls_last(text), F.xxhash64(*others) if others else F.lit(0))
    again = kept.where("__n IS NOT NULL").withColumn("__at", F.row_number().over(first)).where("__at = 1")
    columns = [F.col(f"`{c}`") for c in docs.columns]
    return kept.where("__n IS NULL").select(*columns).unionByName(again.select(*columns))
