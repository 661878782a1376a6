"""Benchmark decontamination by a generalised suffix automaton of the test items.

The automaton holds every run of words of every item. Each document streams through it word by word; the state tells the
longest run that ends here and occurs in some item. Where that length reaches the window, the words of the run are hit.

A large benchmark is dealt over several automata of bounded size. They are built, sent and dropped one after another, each in a
pass over the documents that keeps hits only; at the end a document's hits of all passes are put together.

Defined cases: a null or empty text, and an item without words, have no words and match nothing. Repeated documents are
scored each by itself; repeated items count by distinct item_id, of any type, as text. Texts of any length are streamed whole. An empty
benchmark leaves every document clean. Only the named columns are read, so further columns of any name do no harm.
"""

from __future__ import annotations

import re
from array import array
from bisect import bisect_left
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import Scratch, batches, utf8

#: Bytes of words stay (A-Z in lower case), all others part them. Bytes over 0x7F belong to code points over 0x7F.
_WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)
_WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")
#: Words of items in one automaton, about; a larger benchmark goes through several automata, one after another. The driver builds each
#: from dictionaries (about 250 MB for so many words) and sends it as arrays (about 30 MB).
SHARD_WORDS = 400_000


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_WORD_BYTES).split()


class SuffixAutomaton:
    """All runs of words of several sequences, with the items that each long enough run occurs in."""

    def __init__(self, window: int):
        self.window = window
        self.next: list[dict[bytes, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.items: list[list[str]] = [[]]
        self.short: list[list[tuple[int, str]]] = [[]]
        self.above: list[int] = []

    def _state(self, length: int, edges: dict[bytes, int], link: int) -> int:
        self.next.append(edges)
        self.length.append(length)
        self.link.append(link)
        self.items.append([])
        self.short.append([])
        return len(self.next) - 1

    def _split(self, p: int, w: bytes, q: int) -> int:
        clone = self._state(self.length[p] + 1, dict(self.next[q]), self.link[q])
        self.link[q] = clone
        while p >= 0 and self.next[p].get(w) == q:
            self.next[p][w] = clone
            p = self.link[p]
        return clone

    def _extend(self, last: int, w: bytes) -> int:
        q = self.next[last].get(w)
        if q is not None:
            return q if self.length[q] == self.length[last] + 1 else self._split(last, w, q)
        state, p = self._state(self.length[last] + 1, {}, 0), last
        while p >= 0 and w not in self.next[p]:
            self.next[p][w] = state
            p = self.link[p]
        if p >= 0:
            q = self.next[p][w]
            self.link[state] = q if self.length[q] == self.length[p] + 1 else self._split(p, w, q)
        return state

    def fill(self, sequences: list[tuple[str, list[bytes]]]) -> SuffixAutomaton:
        for _, seq in sequences:
            last = 0
            for w in seq:
                last = self._extend(last, w)
        seen = [-1] * len(self.next)
        for number, (item, seq) in enumerate(sequences):
            state = 0
            for w in seq:
                state = self.next[state][w]
                p = state
                while p > 0 and seen[p] != number:
                    seen[p] = number
                    self.items[p].append(item)
                    p = self.link[p]
            if 0 < len(seq) < self.window:
                self.short[state].append((len(seq), item))
        # the nearest state on the way up, this one included, at which a whole short item ends
        order = sorted(range(len(self.next)), key=self.length.__getitem__)
        self.above = [-1] * len(self.next)
        for s in order[1:]:
            self.above[s] = s if self.short[s] else self.above[self.link[s]]
        return self


class CompactAutomaton:
    """A filled automaton in arrays of 32-bit numbers, to be sent and searched: edges of a state lie together, sorted by word. Items are
    kept for the states at which a window first fits alone; from any other state with a window, one of them is reached by links."""

    def __init__(self, whole: SuffixAutomaton):
        self.window = whole.window
        self.words: dict[bytes, int] = {}
        self.first, self.edge, self.to = array("i", [0]), array("i"), array("i")
        for edges in whole.next:
            for word, state in sorted((self.words.setdefault(w, len(self.words)), s) for w, s in edges.items()):
                self.edge.append(word)
                self.to.append(state)
            self.first.append(len(self.edge))
        self.root = array("i", [0] * len(self.words))
        for k in range(self.first[1]):
            self.root[self.edge[k]] = self.to[k]
        self.link, self.length, self.above = array("i", whole.link), array("i", whole.length), array("i", whole.above)
        self.short = {s: found for s, found in enumerate(whole.short) if found}
        names: dict[str, int] = {}
        self.item_first, self.item = array("i", [0]), array("i")
        for s, items in enumerate(whole.items):
            if s and whole.length[s] >= self.window > whole.length[whole.link[s]]:
                self.item.extend(names.setdefault(x, len(names)) for x in items)
            self.item_first.append(len(self.item))
        self.names = list(names)

    def size(self) -> int:
        """Bytes of the arrays."""
        return sum(len(a) * a.itemsize for a in vars(self).values() if isinstance(a, array))

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Disjoint ascending (start, end) runs of hit words, and the items with a window here."""
        known, first, edge, to = self.words.get, self.first, self.edge, self.to
        link, length, above, window = self.link, self.length, self.above, self.window
        state = run = 0
        spans: list[list[int]] = []
        found: set[str] = set()
        for i, w in enumerate(words):
            word = known(w)
            if word is None:
                state = run = 0
                continue
            while state > 0:
                high = first[state + 1]
                k = bisect_left(edge, word, first[state], high)
                if k < high and edge[k] == word:
                    state = to[k]
                    run += 1
                    break
                state = link[state]
                run = length[state]
            else:
                state, run = self.root[word], 1
            start = -1
            if run >= window:
                p = state
                while length[link[p]] >= window:
                    p = link[p]
                found.update(self.names[x] for x in self.item[self.item_first[p] : self.item_first[p + 1]])
                start = i - run + 1
            p = above[state]
            while p > 0:
                for size, item in self.short[p]:
                    if size <= run:
                        found.add(item)
                        start = i - size + 1 if start < 0 else min(start, i - size + 1)
                p = above[link[p]]
            if start >= 0:
                while spans and spans[-1][0] >= start:
                    spans.pop()
                if spans and spans[-1][1] >= start:
                    spans[-1][1] = i + 1
                else:
                    spans.append([start, i + 1])
        return [(a, b) for a, b in spans], found


def _dealt(benchmark: DataFrame, item_id: str, item_text: str, shard_words: int) -> tuple[DataFrame, int]:
    """Items (item, text, shard) and how many shards they are dealt over by hash, for ``shard_words`` words in each, about."""
    items = benchmark.select(F.col(item_id).cast("string").alias("item"), F.coalesce(F.col(item_text).cast("string"), F.lit("")).alias("text"))
    words = items.agg(F.sum(F.regexp_count("text", F.lit(r"[0-9A-Za-z\x{80}-\x{10FFFF}]+")))).first()[0] or 0
    n = max(1, -(-words // shard_words))
    return items.withColumn("shard", F.pmod(F.xxhash64("item", "text"), F.lit(n))), n


def _automaton(items: DataFrame, shard: int, window: int) -> CompactAutomaton | None:
    """One shard's automaton, built by the driver: its size is bounded by the shard's words."""
    rows = items.where(F.col("shard") == shard).select("item", "text").collect()
    sequences = [(r.item, seq) for r in rows if (seq := words_of(r.text.encode()))]
    return CompactAutomaton(SuffixAutomaton(window).fill(sequences)) if sequences else None


_SPANS, _ITEMS = "array<struct<start:int,end:int>>", "array<string>"
_ARROW_SPANS, _ARROW_ITEMS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])), pa.list_(pa.string())


def _merged(runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for start, end in sorted(runs):
        if out and start <= out[-1][1]:
            out[-1][1] = max(end, out[-1][1])
        else:
            out.append([start, end])
    return [(a, b) for a, b in out]


def _as_spans(runs: list[list[tuple[int, int]]]) -> pa.Array:
    return pa.array([[{"start": a, "end": b} for a, b in r] for r in runs], _ARROW_SPANS)


def _sorted_items(found) -> list[str | None]:
    return sorted(found, key=lambda x: (x is None, x))


def benchmark_hits(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = 10,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    shard_words: int = SHARD_WORDS,
    names: tuple[str, str, str] = ("n_words", "spans", "items"),
) -> DataFrame:
    """``docs`` with n_words, the hit runs of words (``spans``, end exclusive) and the items (as text) with a window in the text;
    ``names`` are the new columns' names, for tables that have such columns already.

    One automaton: no shuffle, documents stream through it where they are read. Several: see above; the documents are joined
    with their hits, which are few.
    """
    spark, keep = docs.sparkSession, docs.columns
    items, shards = _dealt(benchmark, item_id, item_text, shard_words)
    if shards == 1:
        sent, at = spark.sparkContext.broadcast(_automaton(items, 0, window)), keep.index(text)

        def scan(rows):
            for batch in batches(rows):
                n, spans, found = [], [], []
                for body in utf8(batch.column(at)):
                    words = words_of(body)
                    hit, own = sent.value.scan(words) if words and sent.value else ([], ())
                    n.append(len(words))
                    spans.append(hit)
                    found.append(_sorted_items(own))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(n, pa.int64()), _as_spans(spans), pa.array(found, _ARROW_ITEMS)], names=[*keep, *names])

        schema = docs.schema
        for name, kind in zip(names, ("bigint", _SPANS, _ITEMS), strict=True):
            schema = T.StructType([*schema.fields, T.StructField(name, T.DataType.fromDDL(kind))])
        return docs.mapInArrow(scan, schema)

    scratch = Scratch(spark)
    staged = scratch.keep(docs.withColumn("__row", F.monotonically_increasing_id()), "docs")
    items, hits = scratch.keep(items, "items"), []
    for shard in range(shards):
        sent = spark.sparkContext.broadcast(_automaton(items, shard, window))

        def scan_one(rows, sent=sent):
            for batch in batches(rows):
                own, spans, found = [], [], []
                for row, body in zip(batch.column(0).to_pylist(), utf8(batch.column(1)), strict=True):
                    hit, names_of = sent.value.scan(words_of(body)) if sent.value else ([], ())
                    if hit:
                        own.append(row)
                        spans.append(hit)
                        found.append(_sorted_items(names_of))
                yield pa.RecordBatch.from_arrays([pa.array(own, pa.int64()), _as_spans(spans), pa.array(found, _ARROW_ITEMS)], names=["__row", "s", "i"])

        hits.append(scratch.keep(staged.select("__row", F.col(text).cast("string")).mapInArrow(scan_one, f"__row long, s {_SPANS}, i {_ITEMS}"), f"hits-{shard}"))
        sent.unpersist()
    every = reduce(DataFrame.unionByName, hits).groupBy("__row").agg(F.flatten(F.collect_list("s")).alias("s"), F.array_distinct(F.flatten(F.collect_list("i"))).alias("i"))

    def put_together(rows):
        for batch in batches(rows):
            columns = dict(zip(batch.schema.names, batch.columns, strict=True))
            spans = [_merged([(x["start"], x["end"]) for x in row or ()]) for row in columns["s"].to_pylist()]
            found = [_sorted_items(row or ()) for row in columns["i"].to_pylist()]
            n = [len(words_of(body)) for body in utf8(columns[text])]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], pa.array(n, pa.int64()), _as_spans(spans), pa.array(found, _ARROW_ITEMS)], names=[*keep, *names])

    schema = docs.schema
    for name, kind in zip(names, ("bigint", _SPANS, _ITEMS), strict=True):
        schema = T.StructType([*schema.fields, T.StructField(name, T.DataType.fromDDL(kind))])
    joined = staged.join(every, "__row", "left").select(*[F.col(f"`{c}`") for c in keep], "s", "i")
    return joined.mapInArrow(put_together, schema)


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = 10,
    max_coverage: float = 0.5,
    text: str = "text",
) -> DataFrame:
    """``docs`` without the hit runs; a document of which more than ``max_coverage`` is hit goes altogether.

    A run goes with what stands between its words; the parts left are joined by one space. Clean texts stay as they are.
    """
    keep = docs.columns
    found = benchmark_hits(docs, benchmark, window, text, names=("__words", "__runs", "__found"))
    hit = F.aggregate("__runs", F.lit(0), lambda n, s: n + s["end"] - s["start"])
    left = found.where(hit <= F.lit(max_coverage) * F.col("__words"))
    at = keep.index(text)

    def cut(rows):
        for batch in batches(rows):
            bodies, spans = batch.column(at).to_pylist(), batch.column(len(keep)).to_pylist()
            for k, runs in enumerate(spans):
                if runs:
                    body = bodies[k].encode()
                    places = [m.span() for m in _WORD.finditer(body)]
                    parts, end = [], 0
                    for r in runs:
                        parts.append(body[end : places[r["start"]][0]].strip())
                        end = places[r["end"] - 1][1]
                    parts.append(body[end:].strip())
                    bodies[k] = b" ".join(p for p in parts if p).decode()
            columns = [pa.array(bodies, pa.string()) if i == at else batch.column(i) for i in range(len(keep))]
            yield pa.RecordBatch.from_arrays(columns, names=keep)

    return left.select(*keep, "__runs").mapInArrow(cut, docs.schema)


def report(docs: DataFrame, benchmark: DataFrame, window: int = 10, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    found = benchmark_hits(docs.select(doc_id, text), benchmark, window, text)
    names = F.array_sort("items")
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select(
        F.col(doc_id).alias("doc_id"),
        "n_words",
        hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(names, ","), 256).alias("items_sha256"),
        (hit > 0).alias("contaminated"),
    )
