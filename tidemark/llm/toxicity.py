"""Toxicity: gradient-boosted trees over dense features, with isotonic calibration.

Features of a text: densities of a lexicon of words and of word beginnings, how near hits stand to second-person words,
capitals, punctuation, and obfuscation (signs and digits inside words, undone before a second look-up). The lexicon is learned
from one half of the labelled training rows, trees and calibration from the other, so no row judges words it taught. A term
is in it when enough of that half's toxic rows have it, which bounds the lexicon by the rows' length; none is cut off.

The trees are fitted on ``max_train_rows`` labelled rows at most, those of the least hash of the id: a documented bound, which
holds what reaches the driver (a matrix of rows by features). Scoring covers every whole text where it is read.

Defined cases: null and empty texts have all features 0 and get a score like any other. Labels that are null are left out;
a document with several labels counts as toxic if one says so. Without rows of both classes every score is the share of toxic
rows, 0 if there are none. Repeated rows are scored each by itself; of rows that share an id the least text is learned from. Texts of
any length are read whole. Splits of equal gain go to the first feature and the least bound; equal margins are pooled before
they are calibrated. Only the named columns are read; a column that has the score's name is replaced.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import Scratch, batches, texts

#: Words that address the reader, in the languages of common web corpora.
SECOND_PERSON = frozenset(
    "you your yours yourself u ur du dich dir dein deine ihr euch tu te toi ton ta tes vous votre vos tú ti usted ustedes vosotros su sus".split()
)
#: Signs that stand for letters in obfuscated words.
LEET = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i", "*": None, "+": "t"})
_WORD = re.compile(r"[^\W\d_]+")
_ODD = re.compile(r"[^\W\d_]+[0-9@$!*+]+[^\W_][\w@$!*+]*")
STEM = 5
FEATURES = (
    "word_density", "word_hits", "word_weight", "word_most", "stem_density", "stem_hits", "stem_weight", "stem_most", "near_you", "nearest_you",
    "you_density", "capitals", "capital_words", "exclamations", "questions", "punctuation", "digits", "odd_density", "odd_hits", "log_words", "word_length",
)


def lexicon_terms(text: str) -> set[tuple[bool, str]]:
    """(is a beginning, term) of a text."""
    words = set(_WORD.findall(text.lower()))
    return {(False, w) for w in words} | {(True, w[:STEM]) for w in words if len(w) >= STEM}


def features(text: str, lexicon: dict[tuple[bool, str], float]) -> list[float]:
    words = _WORD.findall(text.lower())
    if not text:
        return [0.0] * len(FEATURES)
    n = max(len(words), 1)
    whole, begin = lexicon
    hits = [(i, whole[w]) for i, w in enumerate(words) if w in whole]
    stems = [(i, begin[w[:STEM]]) for i, w in enumerate(words) if w[:STEM] in begin]
    you = [i for i, w in enumerate(words) if w in SECOND_PERSON]
    places = sorted({i for i, _ in hits} | {i for i, _ in stems})
    gaps = []
    if you and places:
        at = np.searchsorted(you, places)
        left = np.where(at > 0, np.asarray(places) - np.asarray(you)[np.maximum(at - 1, 0)], 1 << 30)
        right = np.where(at < len(you), np.asarray(you)[np.minimum(at, len(you) - 1)] - np.asarray(places), 1 << 30)
        gaps = np.minimum(left, right).tolist()
    bytes_ = np.bincount(np.frombuffer(text.encode(), np.uint8), minlength=256)
    size = len(text)
    upper = int(bytes_[65:91].sum())
    odd = _ODD.findall(text)
    undone = sum(1 for w in odd if (x := w.lower().translate(LEET)) in whole or x[:STEM] in begin)
    marks = int(bytes_[33:48].sum() + bytes_[58:65].sum() + bytes_[91:97].sum() + bytes_[123:127].sum())
    return [
        len(hits) / n, np.log1p(len(hits)), sum(x for _, x in hits) / n, max((x for _, x in hits), default=0.0),
        len(stems) / n, np.log1p(len(stems)), sum(x for _, x in stems) / n, max((x for _, x in stems), default=0.0),
        sum(g <= 5 for g in gaps) / n, 1 / (1 + min(gaps, default=1 << 30)), len(you) / n,
        upper / size, sum(1 for w in _CAPS.findall(text)) / n, bytes_[33] / size, bytes_[63] / size, marks / size, int(bytes_[48:58].sum()) / size,
        len(odd) / n, np.log1p(undone), np.log1p(len(words)), sum(map(len, words)) / n,
    ]


_CAPS = re.compile(r"\b[A-Z]{3,}\b")


class Trees:
    """Boosted trees of fixed depth on binned features, for logistic loss."""

    def __init__(self, trees: int = 60, depth: int = 4, rate: float = 0.15, bins: int = 64, ridge: float = 1.0, least: float = 1.0):
        self.trees, self.depth, self.rate, self.bins, self.ridge, self.least = trees, depth, rate, bins, ridge, least

    def fit(self, x: np.ndarray, y: np.ndarray) -> Trees:
        n, width = x.shape
        edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, self.bins + 1)[1:-1])) for f in range(width)]
        binned = np.stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(edges)], axis=1)
        share = np.clip(y.mean(), 1e-4, 1 - 1e-4)
        self.start, self.found = float(np.log(share / (1 - share))), []
        margin = np.full(n, self.start)
        for _ in range(self.trees):
            p = 1 / (1 + np.exp(-margin))
            g, h = p - y, p * (1 - p)
            node = np.zeros(n, np.int64)
            feature, bound = np.zeros(2**self.depth - 1, np.int64), np.full(2**self.depth - 1, np.inf)
            for level in range(self.depth):
                k, first = 2**level, 2**level - 1
                best = np.full(k, 1e-6)
                sums = np.bincount(node, g, k), np.bincount(node, h, k)
                whole = sums[0] ** 2 / (sums[1] + self.ridge)
                for f in range(width):
                    cells = node * self.bins + binned[:, f]
                    gl = np.bincount(cells, g, k * self.bins).reshape(k, -1).cumsum(axis=1)
                    hl = np.bincount(cells, h, k * self.bins).reshape(k, -1).cumsum(axis=1)
                    gr, hr = sums[0][:, None] - gl, sums[1][:, None] - hl
                    gain = gl**2 / (hl + self.ridge) + gr**2 / (hr + self.ridge) - whole[:, None]
                    gain[(hl < self.least) | (hr < self.least)] = 0
                    gain = gain[:, : len(edges[f])]
                    if gain.size:
                        at = gain.argmax(axis=1)
                        value = gain[np.arange(k), at]
                        better = value > best
                        best[better] = value[better]
                        feature[first : first + k][better] = f
                        bound[first : first + k][better] = edges[f][at[better]]
                own = first + node
                node = node * 2 + (x[np.arange(n), feature[own]] > bound[own])
            leaves = 2**self.depth
            value = -self.rate * np.bincount(node, g, leaves) / (np.bincount(node, h, leaves) + self.ridge)
            margin += value[node]
            self.found.append((feature, bound, value))
        return self

    def margin(self, x: np.ndarray) -> np.ndarray:
        out, rows = np.full(len(x), self.start), np.arange(len(x))
        for feature, bound, value in self.found:
            node = np.zeros(len(x), np.int64)
            for level in range(self.depth):
                own = 2**level - 1 + node
                node = node * 2 + (x[rows, feature[own]] > bound[own])
            out += value[node]
        return out


def isotonic(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Knots of the non-decreasing step fit of y to x by pooling neighbours that fall out of order; equal x pool first."""
    values, at = np.unique(x, return_inverse=True)
    weight, mean = np.bincount(at).astype(float), np.bincount(at, weights=y) / np.bincount(at)
    pools: list[list[float]] = []
    for i in range(len(values)):
        pools.append([mean[i], weight[i], values[i], values[i]])
        while len(pools) > 1 and pools[-2][0] >= pools[-1][0]:
            m, w, _, high = pools.pop()
            last = pools[-1]
            last[0] = (last[0] * last[1] + m * w) / (last[1] + w)
            last[1] += w
            last[3] = high
    return np.array([v for p in pools for v in p[2:4]]), np.array([p[0] for p in pools for _ in range(2)])


def train(docs: DataFrame, labels: DataFrame, learn: Column, max_train_rows: int = 40_000, folds: int = 4) -> dict:
    """docs: doc_id, text; labels: doc_id, toxic. ``learn`` says by doc_id which labels may be learned from."""
    marked = labels.where(learn & F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg((F.max("toxic") > 0).cast("int").alias("toxic"))
    marked = marked.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_train_rows)
    # bounded by max_train_rows: one text an id
    rows = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).join(F.broadcast(marked), "doc_id")
    rows = rows.groupBy("doc_id", "toxic").agg(F.min("text").alias("text")).withColumn("half", F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(2)))

    def count(parts):
        counts: Counter = Counter()
        n = [0, 0]
        for batch in parts:
            for body, toxic in zip(texts(batch.column(0)), batch.column(1).to_pylist(), strict=True):
                n[toxic] += 1
                counts.update((toxic, begin, term) for begin, term in lexicon_terms(body))
        keys = list(counts)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([None, *(k[1] for k in keys)], pa.bool_()),
                pa.array(["", *(k[2] for k in keys)], pa.string()),
                pa.array([n[1], *(counts[k] * k[0] for k in keys)], pa.int64()),
                pa.array([n[0], *(counts[k] * (1 - k[0]) for k in keys)], pa.int64()),
            ],
            names=["begin", "term", "toxic", "clean"],
        )

    counted = rows.where("half = 0").select("text", "toxic").mapInArrow(count, "begin boolean, term string, toxic long, clean long")
    counted = counted.groupBy("begin", "term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    scratch = Scratch(docs.sparkSession)
    counted = scratch.keep(counted, "terms")
    whole = counted.where(F.col("begin").isNull()).first()
    toxic, clean = (whole.toxic, whole.clean) if whole else (0, 0)
    weight = F.log((F.col("toxic") + 0.5) / F.lit(toxic + 1.0)) - F.log((F.col("clean") + 0.5) / F.lit(clean + 1.0))
    known = counted.where(F.col("begin").isNotNull() & (F.col("toxic") >= max(4, 0.004 * toxic))).withColumn("weight", weight).where("weight > 1.5")
    lexicon: tuple[dict, dict] = ({}, {})
    for r in known.select("begin", "term", "weight").collect():
        lexicon[r.begin][r.term] = r.weight
    scratch.drop("terms")
    sent = docs.sparkSession.sparkContext.broadcast(lexicon)

    def measure(parts):
        for batch in parts:
            found = [features(body, sent.value) for body in texts(batch.column(0))]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.list_(pa.float64())), batch.column(1), batch.column(2)], names=["x", "toxic", "doc_id"])

    got = rows.where("half = 1").select("text", "toxic", "doc_id").mapInArrow(measure, "x array<double>, toxic int, doc_id long").orderBy("doc_id").collect()
    y = np.array([r.toxic for r in got], float)
    if len(y) < 2 * folds or y.min() == y.max():
        share = (toxic + y.sum()) / max(toxic + clean + len(y), 1)
        return {"lexicon": lexicon, "trees": None, "share": float(share)}
    x = np.array([r.x for r in got])
    fold, apart = np.arange(len(y)) % folds, np.zeros(len(y))
    for k in range(folds):
        own = fold != k
        apart[~own] = Trees().fit(x[own], y[own]).margin(x[~own])
    return {"lexicon": lexicon, "trees": Trees().fit(x, y), "knots": isotonic(apart, y)}


def score(docs: DataFrame, model: dict, text: str = "text", added: str = "score") -> DataFrame:
    """``docs`` with the calibrated score of each text."""
    docs = docs.drop(added)
    sent = docs.sparkSession.sparkContext.broadcast(model)
    at, names = docs.columns.index(text), [*docs.columns, added]

    def run(parts):
        for batch in batches(parts):
            m = sent.value
            if m["trees"] is None:
                s = np.full(batch.num_rows, m["share"])
            else:
                x = np.array([features(body, m["lexicon"]) for body in texts(batch.column(at))])
                s = np.clip(np.interp(m["trees"].margin(x), *m["knots"]), 0, 1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(s, pa.float64())], names=names)

    schema = docs.schema
    return docs.mapInArrow(run, type(schema)(list(schema.fields)).add(added, "double"))
