"""Periodic runs: stretches of words that repeat with a period, by enumeration of maximal pairs.

A maximal pair is two places i < j of a text from which l words agree, while the words before them differ and so do the words after
the l. The words from i to j + l then have period j - i and no neighbour continues it; so pairs whose distance is at most l / 2 and
at least 24 - l are just the runs of 3 periods and 24 words, with multiples of a run's smallest period beside it, which share its
first and last word. Nothing is extended.

Pairs come out of the tree of LCP intervals, bottom up. An interval keeps its places by the word to their left (places of one class
make no maximal pair) and in order. Two intervals that meet under a parent compare the smaller one's places with the larger one's.
Places within half of l of one another that start the same l words step by one period, and all but the first have the same word
to their left; so a place asks for the farthest neighbour before it and, if it differs from the nearest one after it, for those
after it: every place found is a pair, and pairs are at most as many as periods in runs. Intervals of under 16 words can hold no run and
are not built; a document in which no 16 words repeat (by a hash, which may only report too much) is left at once.

Documents are independent: Arrow batches, no shuffle, no state beyond one document.

Defined cases: null, empty and wordless texts have no words and no runs. Texts of any length are handled whole. Repeated rows give a row each. Ties between runs of
equal exponent go to the smallest start, then period. Words differ by case and part at ASCII white space. An empty table gives an
empty result. Only the named columns are read.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from heapq import merge

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import batches, release, utf8

LEAST_LENGTH, LEAST_PERIODS = 24, 3
#: Words of the documents that are hashed together.
WORDS_AT_ONCE = 1_000_000
_MIX = np.uint64(0x9E3779B97F4A7C15)


def least_agreement(length: int = LEAST_LENGTH, periods: int = LEAST_PERIODS) -> int:
    """Words that a run's maximal pair agrees in, at least: distance + l >= length and distance <= l / (periods - 1)."""
    return max(1, -(-length * (periods - 1) // periods))


def may_repeat(docs: list[list[bytes]], width: int) -> np.ndarray:
    """For each document whether ``width`` of its words occur twice, by hashes: never False where they do."""
    out = np.zeros(len(docs), bool)
    sizes = np.array([len(d) for d in docs], np.int64)
    if not sizes.sum():
        return out
    words = {w for d in docs for w in d}
    place = dict(zip(words, range(len(words)), strict=True))
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    h = hashes[np.fromiter((place[w] for d in docs for w in d), np.int64, int(sizes.sum()))]
    owner = np.repeat(np.arange(len(docs)), sizes)
    total, done = h.copy(), 1
    while done < width:  # total[i] stands for the words i .. i + done
        step = min(done, width - done)
        total = total[: len(total) - step] * _MIX + (total[step:] ^ (total[step:] >> np.uint64(29)))
        done += step
        if not len(total):
            return out
    same_doc = owner[: len(total)] == owner[width - 1 :]
    key, own = (total[same_doc] + owner[: len(total)][same_doc].astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)), owner[: len(total)][same_doc]
    order = np.argsort(key)
    key, own = key[order], own[order]
    out[own[1:][(key[1:] == key[:-1]) & (own[1:] == own[:-1])]] = True
    return out


def suffix_array(w: np.ndarray) -> np.ndarray:
    """Places in the order of what follows them, by doubling; ``w`` holds numbers from 0."""
    n = len(w)
    rank = np.unique(w, return_inverse=True)[1].astype(np.int64)
    k = 1
    while True:
        after = np.zeros(n, np.int64)
        after[: max(n - k, 0)] = rank[k:] + 1
        key = rank * (n + 1) + after
        order = np.argsort(key, kind="stable")
        new = np.empty(n, np.int64)
        new[order] = np.concatenate([[0], np.cumsum(key[order][1:] != key[order][:-1])])
        rank = new
        if not n or rank[order[-1]] == n - 1:
            return order
        k *= 2


def common_prefixes(w: list[int], order: list[int]) -> list[int]:
    """lcp[k]: words that the k-th and the (k - 1)-th suffix begin with alike; lcp[0] is 0."""
    n = len(w)
    before, lcp, l = [0] * n, [0] * n, 0
    place = [0] * n
    for k, i in enumerate(order):
        place[i] = k
        before[i] = order[k - 1] if k else -1
    for i in range(n):
        j = before[i]
        if j < 0:
            l = 0
            continue
        top = n - max(i, j)
        while l < top and w[i + l] == w[j + l]:
            l += 1
        lcp[place[i]] = l
        if l:
            l -= 1
    return lcp


class Interval:
    """Places that share a beginning, by the word to their left, and in order."""

    __slots__ = ("classes", "places")

    def __init__(self, place: int, left: int):
        self.classes, self.places = {left: [place]}, [place]

    def take(self, other: Interval) -> None:
        """Add the places of a smaller interval."""
        for left, places in other.classes.items():
            mine = self.classes.get(left)
            self.classes[left] = places if mine is None else _united(mine, places)
        self.places = _united(self.places, other.places)


def _united(large: list[int], small: list[int]) -> list[int]:
    if len(large) < len(small):
        large, small = small, large
    if small[0] > large[-1]:
        large.extend(small)
        return large
    if len(small) * 16 < len(large):
        for x in small:
            large.insert(bisect_left(large, x), x)
        return large
    return list(merge(large, small))


def _pairs(small: Interval, large: Interval, left: list[int], nearest: int, farthest: int) -> Iterator[tuple[int, int]]:
    """Pairs (i, j) of a place of each, nearest <= j - i <= farthest, whose left words differ."""
    order = large.places
    for word, asking in small.classes.items():
        if len(large.classes) == 1 and word in large.classes:
            continue
        for i in asking:
            at = bisect_left(order, i - farthest)
            if at < len(order) and order[at] <= i - nearest and left[order[at]] != word:
                yield order[at], i
            at, end = bisect_right(order, i), bisect_right(order, i + farthest)
            if at < end and left[order[at]] != word:
                for j in order[at:end]:
                    if j - i >= nearest:
                        yield i, j


def maximal_pairs(w: list[int], order: list[int], lcp: list[int], length: int, periods: int) -> Iterator[tuple[int, int, int]]:
    """(i, j, l) of all maximal pairs with length - l <= j - i <= l / (periods - 1)."""
    least = least_agreement(length, periods)
    n = len(w)
    left = [-1, *w[: n - 1]]  # no word stands before the first

    def meet(a: Interval, b: Interval, l: int) -> Iterator[tuple[int, int, int]]:
        small, large = (a, b) if len(a.places) < len(b.places) else (b, a)
        for i, j in _pairs(small, large, left, max(1, length - l), l // (periods - 1)):
            yield i, j, l
        large.take(small)
        return large

    stack: list[tuple[int, Interval]] = []  # (l of the interval that joins it with what stands below on the stack, interval)
    for k in range(n + 1):
        now = lcp[k] if k < n else 0
        # what is on top and agrees in more words than the next suffix is complete
        while stack and stack[-1][0] > now and stack[-1][0] >= least:
            l, top = stack.pop()
            joined = yield from meet(stack[-1][1], top, l)
            stack[-1] = (stack[-1][0], joined)
        if k == n:
            return
        if now < least:
            stack.clear()
            if k + 1 >= n or lcp[k + 1] < least:
                continue
        stack.append((now if stack else 0, Interval(order[k], left[order[k]])))


def runs(words: list[bytes] | list[int], length: int = LEAST_LENGTH, periods: int = LEAST_PERIODS) -> list[tuple[int, int, int]]:
    """(start, length, smallest period) of all runs, by start, then period."""
    place: dict = {}
    w = [place.setdefault(x, len(place)) for x in words]
    if len(w) < length:
        return []
    order = suffix_array(np.array(w, np.int64)).tolist()
    found: dict[tuple[int, int], int] = {}
    for i, j, l in maximal_pairs(w, order, common_prefixes(w, order), length, periods):
        stretch, period = (i, j - i + l), j - i
        found[stretch] = min(period, found.get(stretch, period))
    return sorted(((i, n, p) for (i, n), p in found.items()), key=lambda r: (r[0], r[2]))


def best(found: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run of the greatest length / period; of equals the least start, then period."""
    top = None
    for start, n, p in found:
        if top is None or n * top[2] > top[1] * p:
            top = (start, n, p)
    return top


def collapsed(words: list[bytes], found: list[tuple[int, int, int]]) -> list[bytes]:
    """The words without those that a run holds after its first period."""
    drop = np.zeros(len(words) + 1, np.int64)
    for start, n, p in found:
        drop[start + p] += 1
        drop[start + n] -= 1
    return [x for x, d in zip(words, np.cumsum(drop)[:-1].tolist(), strict=True) if not d]


def _groups(bodies: list[bytes], most: int) -> Iterator[list[list[bytes]]]:
    group, held = [], 0
    for body in bodies:
        group.append(body.split())
        held += len(group[-1])
        if held >= most:
            yield group
            group, held = [], 0
    if group:
        yield group


def _documents(docs: DataFrame, doc_id: str, text: str, schema: str, rows, length: int, periods: int) -> DataFrame:
    if periods < 3:
        raise ValueError("runs have 3 periods at least: nearer places only lie one period apart")
    least = least_agreement(length, periods)

    def run(parts):
        for batch in batches(parts, 500):
            at = 0
            for group in _groups(utf8(batch.column(1)), WORDS_AT_ONCE):
                found = [runs(w, length, periods) if may else [] for w, may in zip(group, may_repeat(group, least), strict=True)]
                yield rows(batch.column(0).slice(at, len(group)), group, found)
                at += len(group)
        release()

    read = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    kind = read.schema["doc_id"].dataType.simpleString()
    return read.mapInArrow(run, f"doc_id {kind}, {schema}")


def find(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LEAST_LENGTH, periods: int = LEAST_PERIODS) -> DataFrame:
    """One row per run: doc_id, start (word number), length, period."""

    def rows(ids, group, found):
        own = pa.array(np.repeat(np.arange(len(group)), [len(f) for f in found]))
        flat = [r for f in found for r in f]
        return pa.RecordBatch.from_arrays([ids.take(own), *[pa.array([r[k] for r in flat], pa.int64()) for k in range(3)]], names=["doc_id", "start", "length", "period"])

    return _documents(docs, doc_id, text, "start long, length long, period long", rows, length, periods)


def collapse(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LEAST_LENGTH, periods: int = LEAST_PERIODS) -> DataFrame:
    """doc_id and text, where of each run one period is left; words are joined by one space."""

    def rows(ids, group, found):
        kept = [b" ".join(collapsed(w, f)) for w, f in zip(group, found, strict=True)]
        return pa.RecordBatch.from_arrays([ids, pa.array(kept, pa.binary()).cast(pa.string())], names=["doc_id", "text"])

    return _documents(docs, doc_id, text, "text string", rows, length, periods)


def report(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LEAST_LENGTH, periods: int = LEAST_PERIODS) -> DataFrame:
    """doc_id, n_runs, the run of the greatest exponent (start, length, period, exponent_milli; nulls without runs), and digests of
    all runs and of the collapsed text."""

    def rows(ids, group, found):
        tops = [best(f) for f in found]
        lines = [hashlib.sha256("".join(f"{s},{n},{p}\n" for s, n, p in f).encode()).hexdigest() for f in found]
        kept = [hashlib.sha256(b" ".join(collapsed(w, f) if f else w)).hexdigest() for w, f in zip(group, found, strict=True)]
        top = [pa.array([t and t[k] for t in tops], pa.int64()) for k in range(3)]
        milli = pa.array([t and 1000 * t[1] // t[2] for t in tops], pa.int64())
        names = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
        return pa.RecordBatch.from_arrays([ids, pa.array([len(f) for f in found], pa.int64()), *top, milli, pa.array(lines), pa.array(kept)], names=names)

    schema = "n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"
    return _documents(docs, doc_id, text, schema, rows, length, periods)
