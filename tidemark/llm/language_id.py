"""Language identification by word-first back-off.

Known words are scored by their log frequency in each language. A word that no language knows falls back to its character
n-grams, the longest order first of which some language knows a gram. A text takes the language of the best mean score.

Training counts every word of every training text. A word stays in the model when it makes up at least ``word_share`` of its
language's words (n-grams: ``gram_share`` of the grams of that order), so that a language has 1/word_share words and
1/gram_share grams of an order at most: that bounds what is sent to the tasks, whatever the size of the corpus.

Defined cases: a null text or one without a letter is ``und`` with score 0, and so is every text when nothing could be
learned. Rows with a null label are not learned from. Equal scores go to the language that sorts first. Repeated rows are
scored each by itself.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import Scratch, batches, release, texts

_LETTERS = re.compile(r"[^\W\d_]+")
_FLUSH = 500_000
#: Odd factors for keys, one for each place in a gram.
_FACTORS = np.array([pow(0x9E3779B97F4A7C15, 2 * i + 1, 1 << 64) for i in range(9)], np.uint64)


def letter_words(text: str) -> list[str]:
    return _LETTERS.findall(text.lower())


def gram_keys(words: list[str], max_order: int) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Per order the keys of all n-grams of " word ", and the place of the word that each belongs to.

    A key is a hash of 64 bits of the code points; a gram of one is a letter.
    """
    points = np.frombuffer((" " + " ".join(words) + " ").encode("utf-32-le"), np.uint32).astype(np.uint64)
    space = points == 32
    word = np.cumsum(space) - 1
    out, keys = {}, np.zeros(len(points), np.uint64)
    fits = np.ones(len(points), bool)
    for n in range(1, max_order + 1):
        keys = keys[: len(points) - n + 1] + points[n - 1 :] * _FACTORS[n - 1]
        fits = fits[: len(keys)]
        if n > 2:
            fits = fits & ~space[n - 2 : len(points) - 1]
        here = ~space if n == 1 else fits
        mixed = keys[here]
        mixed ^= mixed >> np.uint64(31)
        out[n] = (mixed * _FACTORS[-1]).view(np.int64), word[: len(keys)][here]
    return out


def _count_words(rows):
    counts: dict[str, Counter] = {}
    held = 0

    def out():
        for lang, c in counts.items():
            keys = list(c)
            for at in range(0, len(keys), 50_000):
                part = keys[at : at + 50_000]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(part), pa.string()), pa.array(part, pa.string()), pa.array([c[k] for k in part], pa.int64())],
                    names=["lang", "word", "n"],
                )

    for batch in rows:
        for body, lang in zip(texts(batch.column(0)), batch.column(1).to_pylist(), strict=True):
            c = counts.setdefault(lang, Counter())
            held -= len(c)
            c.update(letter_words(body))
            held += len(c)
            if held > _FLUSH:
                yield from out()
                counts, held = {}, 0
    yield from out()
    counts.clear()
    release()


def train(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    max_order: int = 4,
    word_share: float = 1e-5,
    gram_share: float = 2e-5,
) -> dict:
    """Model: languages, word and gram scores (log10 of relative frequency). All rows of ``docs`` with a label are read."""
    rows = docs.where(F.col(lang).isNotNull()).select(F.col(text).alias("text"), F.col(lang).cast("string").alias("lang"))
    scratch = Scratch(docs.sparkSession)
    words = rows.mapInArrow(_count_words, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))
    words = scratch.keep(words, "words", records=2000)
    counted = words.mapInArrow(_gram_counter(max_order), "lang string, ord int, key long, n long").groupBy("lang", "ord", "key").agg(F.sum("n").alias("n"))
    counted = scratch.keep(counted, "grams")

    def known(df, keys, share):
        total = df.groupBy(*keys).agg(F.sum("n").alias("total")).collect()
        totals = {tuple(r)[:-1]: r.total for r in total}
        if not totals:
            return totals, []
        least = F.create_map(*[F.lit(x) for k, t in totals.items() for x in ("\x00".join(map(str, k)), share * t)])
        return totals, df.where(F.col("n") >= least[F.concat_ws("\x00", *keys)]).collect()

    word_totals, word_rows = known(words, ["lang"], word_share)
    gram_totals, gram_rows = known(counted, ["lang", "ord"], gram_share)
    scratch.drop("words", "grams")
    langs = sorted(k[0] for k in word_totals)
    place = {x: i for i, x in enumerate(langs)}
    # what a language lacks: one tenth of the lowest frequency that could have stayed
    table: dict[str, list[float]] = {}
    lack = math.log10(word_share) - 1
    for r in word_rows:
        table.setdefault(r.word, [lack] * len(langs))[place[r.lang]] = max(math.log10(r.n / word_totals[r.lang,]), lack)
    model = {"langs": langs, "words": {w: i for i, w in enumerate(table)}, "word_scores": np.array(list(table.values()), np.float64).reshape(len(table), len(langs)), "grams": {}}
    lack = math.log10(gram_share) - 1
    for n in range(1, max_order + 1):
        rows_n = [r for r in gram_rows if r.ord == n]
        keys = np.unique(np.array([r.key for r in rows_n], np.int64))
        scores = np.full((len(keys), len(langs)), lack)
        at = np.searchsorted(keys, np.array([r.key for r in rows_n], np.int64))
        for i, r in zip(at, rows_n, strict=True):
            scores[i, place[r.lang]] = max(math.log10(r.n / gram_totals[r.lang, n]), lack)
        model["grams"][n] = keys, scores
    return model


def _gram_counter(max_order: int):
    def run(parts):
        held: dict[tuple[str, int], list[tuple[np.ndarray, np.ndarray]]] = {}
        size = 0

        def merged():
            for (lang, n), found in held.items():
                keys, at = np.unique(np.concatenate([k for k, _ in found]), return_inverse=True)
                counts = np.bincount(at, weights=np.concatenate([c for _, c in found])).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(keys), pa.string()), pa.array(np.full(len(keys), n, np.int32)), pa.array(keys), pa.array(counts)],
                    names=["lang", "ord", "key", "n"],
                )

        for batch in parts:
            langs, words, counts = batch.column(0).to_pylist(), batch.column(1).to_pylist(), np.asarray(batch.column(2), np.float64)
            for lang in sorted(set(langs)):
                own = [i for i, x in enumerate(langs) if x == lang]
                weight = counts[own]
                for n, (keys, word) in gram_keys([words[i] for i in own], max_order).items():
                    keys, at = np.unique(keys, return_inverse=True)
                    held.setdefault((lang, n), []).append((keys, np.bincount(at, weights=weight[word], minlength=len(keys))))
                    size += len(keys)
            if size > 8 * _FLUSH:
                yield from merged()
                held, size = {}, 0
        yield from merged()
        held.clear()
        release()

    return run


def word_vectors(model: dict, words: list[str]) -> np.ndarray:
    """Scores of different words in each language, from the word itself or the mean of its grams of the longest known order;
    nan for a word of which nothing is known."""
    out = np.full((len(words), len(model["langs"])), np.nan)
    at = np.fromiter((model["words"].get(w, -1) for w in words), np.int64, len(words))
    out[at >= 0] = model["word_scores"][at[at >= 0]]
    left = np.flatnonzero(at < 0)
    if len(left) and model["grams"]:
        found = gram_keys([words[i] for i in left], max(model["grams"]))
        open_ = np.ones(len(left), bool)
        for n in sorted(found, reverse=True):
            keys, scores = model["grams"][n]
            gram, word = found[n]
            if not len(keys):
                continue
            gram, word = gram[open_[word]], word[open_[word]]
            i = np.minimum(np.searchsorted(keys, gram), len(keys) - 1)
            here = keys[i] == gram
            i, word = i[here], word[here]
            counts = np.bincount(word, minlength=len(left))
            seen = counts > 0
            for c in range(scores.shape[1]):
                out[left[seen], c] = np.bincount(word, weights=scores[i, c], minlength=len(left))[seen] / counts[seen]
            open_ &= ~seen
    return out


def _predict(model: dict, bodies: list[str]) -> tuple[list[str], list[float]]:
    langs, docs = model["langs"], [letter_words(b) for b in bodies]
    labels, scores = ["und"] * len(docs), [0.0] * len(docs)
    if not langs:
        return labels, scores
    place = {w: i for i, w in enumerate({w for d in docs for w in d})}
    vectors = word_vectors(model, list(place))
    known = ~np.isnan(vectors[:, 0]) if len(vectors) else np.zeros(0, bool)
    vectors = np.nan_to_num(vectors)
    for k, words in enumerate(docs):
        if not words:
            continue
        at = np.fromiter(map(place.__getitem__, words), np.int64, len(words))
        n = int(known[at].sum())
        total = vectors[at].sum(axis=0)
        best = int(np.argmax(total))
        labels[k] = langs[best]
        scores[k] = float(1 / np.exp(np.maximum(math.log(10) * min(n, 20) / max(n, 1) * (total - total[best]), -700)).sum())
    return labels, scores


def predict(docs: DataFrame, model: dict, text: str = "text", added: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """``docs`` with lang_pred and score (the share of the best language among all, from 20 words' worth of evidence)."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    at, names = docs.columns.index(text), [*docs.columns, *added]

    def run(rows):
        for batch in batches(rows, 1000):
            labels, scores = _predict(sent.value, texts(batch.column(at)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(labels, pa.string()), pa.array(scores, pa.float64())], names=names)

    schema = docs.schema
    for name, kind in zip(added, ("string", "double"), strict=True):
        schema = type(schema)(list(schema.fields)).add(name, kind)
    return docs.mapInArrow(run, schema)


def identify(
    docs: DataFrame, learn: Column | None = None, text: str = "text", lang: str = "lang", added: tuple[str, str] = ("lang_pred", "score"), **parameters
) -> DataFrame:
    """Learn from the labelled rows of ``docs`` for which ``learn`` holds, then predict all rows."""
    return predict(docs, train(docs if learn is None else docs.where(learn), text, lang, **parameters), text, added)
