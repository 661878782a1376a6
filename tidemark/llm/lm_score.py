"""Language-model scores: a causal self-attention model on subword ids, trained with numpy inside Spark tasks.

A text is its words, A-Z in lower case, each encoded with a space before it by a public byte-level BPE, then an end id. The model
predicts the next id's class by attention over the ids before it, and the id within its class from counts of pairs:

  P(id | past) = softmax(bigram[hash(last)] + linear(last) + sum over past of attention * value)[class] * P(id | class, hash(last))

- One pass over all training texts counts pairs (hash of the last id, id). From these come id vectors (leading directions of the
  pairs' pointwise mutual information), classes (k-means of the vectors) and P(id | class, hash). Ids are bounded by the vocabulary, so these tables are too, whatever the corpus.
- Attention, value and position weights are trained by Adam: every task starts from the same weights, learns from windows of all
  its training documents, and the tasks' weights are averaged by windows. Over the rounds each window is learned from once.
- A window is 32 ids and overlaps the next by 16. Its last 16 ids are scored, each once, by one batched masked product; the 16
  before are context only. Ids lie in blocks of 16, and a window is two neighbouring blocks, so what belongs to a position
  is looked up once.

The base score needs the training counts of every word of every document. Documents are handled in blocks; a block lists each
of its words once (64-bit hash), the lists meet by ranges of hashes to be summed, and return to their block. No word list is
broadcast.

Defined cases: null, empty and wordless texts are one end token. Without training rows the model's counts are flat and N = 0.
Repeated rows are scored each by itself; a null id counts as the empty text for the fold; a null ``held_out`` is false. A text of any
length is one document, scored whole. Ids are cast to long.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import Scratch, batches, release
from tidemark.llm.token_counts import encoding

#: The public vocabulary for many languages.
VOCABULARY = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
CLASSES, BUCKETS, HALF, KEY, STRIDE, WINDOW = 64, 256, 16, 8, 16, 32
DIM = 2 * HALF
#: Pairs are sent by rows of so many buckets.
PART = 64
#: Bytes of text whose words are listed together.
BLOCK_BYTES = 16_000_000
#: Listed words of one range of keys, about.
PART_WORDS = 250_000
#: Windows of one training step or one scoring product, and of one run of neighbours within a training step.
STEP, RUN = 128, 16
#: Ids of the BPE, then the end, the start and what fills windows.
END, START, FILL, IDS = 50_256, 50_257, 50_258, 50_259
SHAPES = {"wq": (DIM, KEY), "bq": (KEY,), "wk": (DIM, KEY), "wv": (DIM, CLASSES), "r": (WINDOW,), "wd": (DIM, CLASSES), "b": (CLASSES,)}
DOC, WORD, PAIR = range(3)


def bucket(ids: np.ndarray) -> np.ndarray:
    return (ids.astype(np.uint64) * np.uint64(2654435761) >> np.uint64(13)) % np.uint64(BUCKETS)


def _by_bytes(batch: pa.RecordBatch, limit: int) -> Iterator[pa.RecordBatch]:
    """The rows in runs of ``limit`` bytes of text at most; a longer text is a run of its own."""
    size = np.asarray(pc.fill_null(pc.binary_length(batch.column(2)), 0)).astype(np.int64)
    at = 0
    while at < batch.num_rows:
        n = max(1, int(np.searchsorted(np.cumsum(size[at:]), limit, "right")))
        yield batch.slice(at, n)
        at += n


def words_of(column: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Words of each text, and all words one after another; A-Z in lower case, parted at ASCII white space."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(column, "")))
    words, n = lists.flatten(), np.asarray(pc.list_value_length(lists)).astype(np.int64)
    real = np.asarray(pc.binary_length(words)) > 0
    ends = np.cumsum(n)
    upto = np.concatenate([[0], np.cumsum(real)])
    return upto[ends] - upto[ends - n], words if real.all() else words.filter(pa.array(real))


def encoded(encoder, opens: np.ndarray, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all words, each with a space before it, and how many each word has. ``opens``: ids whose bytes begin with a space."""
    if not words:
        return np.zeros(0, np.uint16), np.zeros(0, np.int32)
    text = " ".join(["", *words])
    ids = encoder.encode_to_numpy(text, disallowed_special=())
    first = np.flatnonzero(opens[ids])
    if len(first) == len(words) and len(text.split()) == len(words):
        return ids.astype(np.uint16), np.diff(first, append=len(ids)).astype(np.int32)
    # a word that holds white space of other scripts may merge with its neighbours: each by itself
    lists = [encoder.encode_ordinary(" " + w) for w in words]
    return np.concatenate([np.array(x, np.uint16) for x in lists]), np.array([len(x) for x in lists], np.int32)


class _Pairs:
    """Counts of cells id * BUCKETS + bucket that were seen."""

    def __init__(self):
        self.held: list[tuple[np.ndarray, np.ndarray]] = []

    def add(self, cells: np.ndarray) -> None:
        cells = np.sort(cells)
        first = np.flatnonzero(np.concatenate([[True], cells[1:] != cells[:-1]])) if len(cells) else np.zeros(0, np.int64)
        self.held.append((cells[first], np.diff(first, append=len(cells))))
        if len(self.held) > 8:
            self.held = [self.total()]

    def total(self) -> tuple[np.ndarray, np.ndarray]:
        if not self.held:
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        cells, n = (np.concatenate(x) for x in zip(*self.held, strict=True))
        order = np.argsort(cells, kind="stable")
        cells, n = cells[order], n[order]
        first = np.flatnonzero(np.concatenate([[True], cells[1:] != cells[:-1]])) if len(cells) else np.zeros(0, np.int64)
        return cells[first], np.add.reduceat(n, first) if len(first) else n


def _read(vocabulary: bytes):
    """Pass over the texts: ids and word lists of documents, words of blocks, counts of pairs."""
    names = ["kind", "a", "b", "n", "held", "x", "y", "v"]
    kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.binary(), pa.binary(), pa.list_(pa.int32())]

    def rows_of(kind, size, **columns):
        arrays = [pa.array(np.full(size, kind, np.int32))]
        arrays += [columns[n] if n in columns else pa.nulls(size, t) for n, t in zip(names[1:], kinds[1:], strict=True)]
        return pa.RecordBatch.from_arrays([a.cast(t) if a.type != t else a for a, t in zip(arrays, kinds, strict=True)], names=names)

    def run(rows):
        encoder = encoding(vocabulary.value)
        opens = np.zeros(END + 1, bool)
        opens[[i for i in range(END) if encoder.decode_single_token_bytes(i)[:1] == b" "]] = True
        near, pack, pairs = bucket(np.arange(IDS)).astype(np.uint32), zstandard.ZstdCompressor(level=1).compress, _Pairs()

        def block_rows(part):
            docs, block = part.num_rows, uuid.uuid4().int >> 65
            counts, words = words_of(part.column(2))
            listed = words.dictionary_encode()
            words = listed.dictionary.to_numpy(zero_copy_only=False)
            keys = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
            order = np.argsort(keys, kind="stable")
            keys, words = keys[order], words[order].tolist()
            place = np.empty(len(order), np.uint32)
            place[order] = np.arange(len(order), dtype=np.uint32)
            at = place[np.asarray(listed.indices)]
            # a word's ids are the same wherever it stands: each is encoded once a block; the last entry is the end
            known, size = encoded(encoder, opens, words)
            known, size = np.append(known, np.uint16(END)), np.append(size, np.int32(1))
            begins = (np.cumsum(size) - size).astype(np.int32)
            ends = np.cumsum(counts)
            full = np.insert(at, ends, len(words))
            n = size[full]
            upto = np.cumsum(n, dtype=np.int64)
            take = np.repeat(begins[full] - (upto - n).astype(np.int32), n)
            take += np.arange(len(take), dtype=np.int32)
            ids = known[take]
            last_of = upto[ends + np.arange(docs)]
            first_of = np.concatenate([[0], last_of[:-1]])
            learn = ~np.asarray(part.column(1))
            trained = np.bincount(at[np.repeat(learn, counts)], minlength=len(words))
            last = np.empty(len(ids), np.uint16)
            last[1:] = ids[:-1]
            last[first_of] = START
            cells = ids.astype(np.uint32) * np.uint32(BUCKETS) + near[last]
            pairs.add(cells if learn.all() else cells[np.repeat(learn, last_of - first_of)])
            cut = 1000
            for k in range(0, docs, cut):
                some = range(k, min(docs, k + cut))
                x = [pack(ids[first_of[i] : last_of[i]].tobytes()) for i in some]
                y = [pack(at[ends[i] - counts[i] : ends[i]].tobytes()) for i in some]
                yield rows_of(
                    DOC, len(some), a=part.column(0).slice(k, cut), b=pa.array(np.full(len(some), block, np.int64)), n=pa.array(counts[k : k + cut]),
                    held=part.column(1).slice(k, cut), x=pa.array(x, pa.binary()), y=pa.array(y, pa.binary()),
                )
            if len(words):
                # a: number of words, x: their keys in ascending order, y: their training counts
                yield rows_of(
                    WORD, 1, a=pa.array([len(words)], pa.int64()), b=pa.array([block], pa.int64()),
                    x=pa.array([keys.tobytes()], pa.binary()), y=pa.array([trained.astype(np.uint32).tobytes()], pa.binary()),
                )

        for batch in rows:
            for part in _by_bytes(batch, BLOCK_BYTES):
                yield from block_rows(part)
            release()
        cells, n = pairs.total()
        run_of = cells // np.uint32(PART)
        first = np.flatnonzero(np.concatenate([[True], run_of[1:] != run_of[:-1]])) if len(cells) else np.zeros(0, np.int64)
        for at in range(0, len(first), 10_000):
            some = first[at : at + 10_000]
            low, high = some[0], first[at + 10_000] if at + 10_000 < len(first) else len(cells)
            counts = np.zeros((len(some), PART), np.int32)
            counts[np.repeat(np.arange(len(some)), np.diff(some, append=high)), cells[low:high] % np.uint32(PART)] = n[low:high]
            v = pa.ListArray.from_arrays(pa.array(np.arange(0, counts.size + 1, PART, dtype=np.int32)), pa.array(counts.ravel()))
            yield rows_of(PAIR, len(some), a=pa.array(run_of[some].astype(np.int64)), v=v)

    return run


def tables_from_counts(pairs: np.ndarray, seed: int = 1) -> dict[str, np.ndarray]:
    """Vectors, classes and log probabilities of ids from counts (IDS, BUCKETS). Ids never seen share one row of each class."""
    rng = np.random.default_rng(seed)
    seen = np.flatnonzero(pairs.any(axis=1))
    own_pairs = pairs[seen].astype(np.float64)
    ids, column = own_pairs.sum(axis=1), own_pairs.sum(axis=0)
    vectors, classes = np.zeros((IDS, DIM)), np.arange(IDS) % CLASSES
    if len(seen) > CLASSES:
        share = (column + 1e-9) / max(column.sum(), 1e-9)
        pmi = np.log((own_pairs + 0.5 * share) / (ids + 0.5)[:, None] / share + 0.05)
        weight = np.sqrt(ids)
        pmi -= np.average(pmi, axis=0, weights=weight)
        _, directions = np.linalg.eigh((pmi * weight[:, None]).T @ pmi)
        v = pmi @ directions[:, ::-1][:, :HALF]
        v *= np.minimum(1, np.sqrt(ids / 20))[:, None]
        v /= np.sqrt(np.average(v**2, axis=0, weights=weight)) + 1e-9
        vectors[seen, :HALF] = np.clip(v, -4, 4)
        # the other half: what follows the ids of the same bucket
        after = (pmi * weight[:, None]).T @ v / weight.sum()
        after /= np.sqrt(np.average(after**2, axis=0, weights=column + 1e-9)) + 1e-9
        vectors[:, HALF:] = np.clip(after, -4, 4)[bucket(np.arange(IDS)).astype(np.int64)]
        vectors[FILL] = 0
        centres = v[rng.choice(len(seen), CLASSES, replace=False, p=weight / weight.sum())]
        for _ in range(20):
            own = ((v**2).sum(axis=1)[:, None] - 2 * v @ centres.T + (centres**2).sum(axis=1)).argmin(axis=1)
            for c in range(CLASSES):
                if (own == c).any():
                    centres[c] = np.average(v[own == c], axis=0, weights=weight[own == c])
        classes[seen] = own
    classes[[START, FILL]] = 0
    share = np.full(IDS, 0.05)
    share[seen] += ids
    share[[START, FILL]] = 0
    share /= np.bincount(classes, share, CLASSES)[classes]
    per_class = np.stack([np.bincount(classes[seen], own_pairs[:, h], CLASSES) for h in range(BUCKETS)], axis=1)
    strength = 8.0
    # P(id | class, bucket) = (pairs + strength * share) / (pairs of the class + strength): rows of the seen ids, and 0 counts for others
    row = np.zeros(IDS, np.int64)
    row[seen] = np.arange(1, len(seen) + 1)
    counts = np.concatenate([np.zeros((1, BUCKETS)), own_pairs]).astype(np.float32)
    prior = per_class.sum(axis=1) + 1
    bigram = np.log((per_class + 20 * (prior / prior.sum())[:, None]) / (column + 20)).T
    # one more column is 1 for every id, and one is 1 for FILL
    marks = np.zeros((IDS, 2))
    marks[:, 0], marks[FILL, 1] = 1, 1
    return {
        "vectors": np.concatenate([vectors, marks], axis=1).astype(np.float32), "classes": classes, "row": row, "pairs": counts,
        "share": (strength * share).astype(np.float32), "norm": np.log(per_class + strength).astype(np.float32),
        "bigram": np.ascontiguousarray(bigram, np.float32),
        "bucket": bucket(np.arange(IDS)).astype(np.int64),
    }


def initial(seed: int = 1) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    w = {k: np.zeros(s, np.float32) for k, s in SHAPES.items()}
    for k in ("wq", "wk"):
        w[k] = (rng.standard_normal(SHAPES[k]) * 0.2).astype(np.float32)
    w["wv"] = (rng.standard_normal(SHAPES["wv"]) * 0.02).astype(np.float32)
    w["r"] = (-0.1 * np.arange(WINDOW)).astype(np.float32)
    return w


#: Distance of each key of a window from each query, and what a query must not see.
_GAP = STRIDE + np.arange(STRIDE)[:, None] - np.arange(WINDOW)[None, :]
_MASK = np.where(_GAP < 0, np.float32(-1e9), np.float32(0))
_DISTANCE, _SEEN = np.abs(_GAP), _GAP >= 0


def blocks(ids: np.ndarray, sizes: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Past and targets (n + 1, 16) of a document of n blocks. Window i looks at past i and i + 1 and predicts the targets of
    row i; the last row of targets is FILL, so documents follow one another without a window of two. ``sizes``: ids of each of
    several documents, one after another."""
    sizes = np.array([len(ids)]) if sizes is None else sizes
    length = STRIDE * (-(-sizes // STRIDE) + 1)
    start = np.cumsum(length) - length
    past, target = np.full((2, int(length.sum()) + 1), FILL, np.int64)
    at = np.arange(len(ids)) + np.repeat(start - (np.cumsum(sizes) - sizes), sizes)
    target[at] = ids
    past[at + (STRIDE + 1)] = ids
    past[start + STRIDE + sizes] = FILL  # nothing follows the last id
    past[start + STRIDE] = START
    return past[:-1].reshape(-1, STRIDE), target[:-1].reshape(-1, STRIDE)


def _two(x: np.ndarray, first: int, end: int) -> np.ndarray:
    """Columns first to end of rows (runs, n, 32, d) of two neighbouring blocks each, as a view of a contiguous (runs, n + 1, 16, d)."""
    return np.ndarray((x.shape[0], x.shape[1] - 1, WINDOW, end - first), x.dtype, x, first * x.itemsize, x.strides)


def _key_weights(w: dict[str, np.ndarray]) -> np.ndarray:
    """Products with the vectors give queries, with a last 1, and beside them keys, whose last column shuts FILL out."""
    out = np.zeros((DIM + 2, 2 * KEY + 2), np.float32)
    out[:DIM, :KEY], out[DIM, :KEY], out[DIM, KEY] = w["wq"], w["bq"], 1
    out[:DIM, KEY + 1 : -1], out[DIM + 1, -1] = w["wk"], -1e4
    return out


def _exp(x: np.ndarray, limit: int) -> None:
    """exp of min(x, limit) in place; to look for the greatest is cheaper than to cut all."""
    if x.max(initial=0) > limit:
        np.minimum(x, np.float32(limit), out=x)
    np.exp(x, out=x)


def _attention(rows: np.ndarray, qk: np.ndarray, at: int, bias: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Unscaled weights (runs, n, 16, 32) and the vectors they add up to, of which the last but one column is the sum of the weights.
    ``rows`` begins with the vectors; ``qk`` has queries and keys from column ``at`` on."""
    k = at + KEY + 1
    s = np.matmul(qk[:, 1:, :, at:k], _two(qk, k, k + KEY + 1).swapaxes(2, 3))
    s += bias
    _exp(s, 60)
    return s, np.matmul(s, _two(rows, 0, DIM + 2)).reshape(-1, DIM + 2)


_ONES = np.ones(CLASSES, np.float32)


def _exp_sum(x: np.ndarray) -> np.ndarray:
    """exp of the logits in place; returns each row's sum."""
    _exp(x, 80)
    return np.maximum(x @ _ONES, np.float32(1e-30))


class Scorer:
    """Tables folded with trained weights, so that a window costs look-ups and two batched products."""

    def __init__(self, tables: dict[str, np.ndarray], w: dict[str, np.ndarray]):
        e = tables["vectors"]
        #: Of each id its vector, query and key side by side.
        self.rows = np.concatenate([e, e @ _key_weights(w)], axis=1)
        self.wv, self.bucket = w["wv"].astype(np.float32), tables["bucket"]
        self.last = (tables["bigram"][self.bucket] + e[:, :DIM] @ w["wd"] + w["b"]).astype(np.float32)
        self.bias = (_MASK + w["r"][_DISTANCE]).astype(np.float32)
        self.classes, self.row, self.pairs = tables["classes"], tables["row"], tables["pairs"]
        self.share, self.norm = tables["share"], tables["norm"]

    def log_probabilities(self, past: np.ndarray, target: np.ndarray) -> np.ndarray:
        """Natural log probability of each target (n, 16) of the n windows of n + 1 blocks; 0 for FILL."""
        rows = self.rows.take(past, axis=0)[None]
        _, mean = _attention(rows, rows, DIM + 2, self.bias)
        last, target = past[1:].ravel(), target[:-1].ravel()
        logits = (mean[:, :DIM] * (1 / np.maximum(mean[:, DIM : DIM + 1], np.float32(1e-30)))) @ self.wv
        logits += self.last.take(last, axis=0)
        own, near = self.classes.take(target), self.bucket.take(last)
        picked = logits.take(np.arange(0, logits.size, CLASSES) + own)
        within = np.maximum(self.pairs.take(self.row.take(target) * BUCKETS + near) + self.share.take(target), np.float32(1e-30))
        out = picked + np.log(within / _exp_sum(logits)) - self.norm.take(own * BUCKETS + near)
        out[target == FILL] = 0
        return out.reshape(-1, STRIDE)


def _distinct(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids that occur, in no particular order, and the place of each id among them."""
    place, every = np.empty(IDS, np.int64), np.arange(len(ids))
    place[ids] = every
    first = np.flatnonzero(place.take(ids) == every)
    found = ids.take(first)
    place[found] = np.arange(len(found))
    return found, place.take(ids)


def gradients(tables: dict[str, np.ndarray], w: dict[str, np.ndarray], past: np.ndarray, target: np.ndarray) -> dict[str, np.ndarray]:
    """Mean gradient of the class's log loss over the targets of the windows: of one run of n + 1 blocks, or of several (runs, n + 1, 16)."""
    past, target = past.reshape(-1, *past.shape[-2:]), target.reshape(-1, *target.shape[-2:])
    e = tables["vectors"].take(past, axis=0)
    qk = (e.reshape(-1, DIM + 2) @ _key_weights(w)).reshape(*past.shape, -1)
    s, mean = _attention(e, qk, 0, (_MASK + w["r"][_DISTANCE]).astype(np.float32))
    last, target = past[:, 1:].ravel(), target[:, :-1].ravel()
    real = target != FILL
    inverse = 1 / np.maximum(mean[:, DIM : DIM + 1], np.float32(1e-30))
    mean = mean[:, :DIM] * inverse
    # what depends on the last id alone, once for each id that occurs
    ids, place = _distinct(last)
    alone = tables["bigram"].take(tables["bucket"].take(ids), axis=0)
    alone += tables["vectors"].take(ids, axis=0)[:, :DIM] @ w["wd"].astype(np.float32) + w["b"].astype(np.float32)
    d = mean @ w["wv"].astype(np.float32)
    d += alone.take(place, axis=0)
    d *= (real / _exp_sum(d))[:, None]
    d.ravel()[np.arange(0, d.size, CLASSES) + tables["classes"].take(target)] -= real
    # the column of ones beside a vector gives the gradient of the bias
    e_last = e[:, 1:].reshape(-1, DIM + 2)
    dl = e_last.T @ d
    # of weights p = s / total: ds = p * (dx . e - dx . mean), the second term by the column of ones
    dm = np.zeros((len(target), DIM + 2), np.float32)
    np.multiply(d @ w["wv"].T.astype(np.float32), inverse, out=dm[:, :DIM])
    dm[:, DIM] = -np.einsum("ij,ij->i", dm[:, :DIM], mean)
    s *= np.matmul(dm.reshape(*s.shape[:3], -1), _two(e, 0, DIM + 2).swapaxes(2, 3))
    # the sum of ds * query's vector x key's vector gives the gradients of both products
    both = e_last.T @ np.matmul(s, _two(e, 0, DIM)).reshape(-1, DIM)
    both, ones = both[:DIM], both[DIM]
    scale = np.float32(1 / max(int(real.sum()), 1))
    g = {
        "wq": both @ w["wk"], "bq": ones @ w["wk"], "wk": both.T @ w["wq"] + np.outer(ones, w["bq"]), "wv": mean.T @ d,
        "r": np.bincount(_GAP[_SEEN], s.sum(axis=(0, 1))[_SEEN], WINDOW), "wd": dl[:DIM], "b": dl[DIM],
    }
    return {name: scale * x for name, x in g.items()}


def _documents(cells: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Past and targets of documents one after another, and the rows of each."""
    unpack = zstandard.ZstdDecompressor().decompress
    ids = [np.frombuffer(unpack(cell), np.uint16) for cell in cells]
    sizes = np.array([len(x) for x in ids])
    return *blocks(np.concatenate(ids), sizes), -(-sizes // STRIDE) + 1


def _mixed_steps(past: np.ndarray, target: np.ndarray, rng: np.random.Generator, turn: int, rounds: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Steps of STEP windows made of runs of RUN windows from all over the documents, in random order; each window is in one step of one
    of the turns."""
    starts = rng.permutation(np.arange(0, len(past) - 1, RUN))
    for some in np.array_split(starts, max(rounds, round(len(starts) * RUN / STEP)))[turn::rounds]:
        at = some[:, None] + np.arange(RUN + 1)
        beyond = at >= len(past)
        at[beyond] = len(past) - 1
        run, end = past[at], target[at]
        run[beyond] = end[beyond] = FILL
        end[:, -1] = FILL  # the last block of a run is the first of another
        yield run, end


def _learn(tables, weights, turn: int, rounds: int, rate: float = 0.01):
    """Adam over this turn's steps of each batch of documents."""

    def run(rows):
        w = np.concatenate([weights[k].ravel() for k in SHAPES]).astype(np.float32)
        m, v = np.zeros_like(w), np.zeros_like(w)
        step = seen = 0
        rng = np.random.default_rng(1)  # the same order in every turn
        for batch in batches(rows, 500):
            past, target, _ = _documents(batch.column(0).to_pylist())
            for some_past, some_target in _mixed_steps(past, target, rng, turn, rounds):
                windows = int((some_target[..., 0] != FILL).sum())
                if not windows:
                    continue
                g = gradients(tables.value, _unflatten(w), some_past, some_target)
                g = np.concatenate([g[k].ravel() for k in SHAPES]).astype(np.float32)
                step += 1
                seen += windows
                m += np.float32(0.1) * (g - m)
                v += np.float32(0.01) * (g * g - v)
                scale = rate / math.sqrt(1 + step / 200) / (1 - 0.9**step)
                w = w - np.float32(scale) * m / (np.sqrt(v / np.float32(1 - 0.99**step)) + np.float32(1e-8))
        if seen:
            n = len(w)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(n, dtype=np.int32)), pa.array(w.astype(np.float64) * seen), pa.array(np.full(n, float(seen)))], names=["i", "wv", "n"])

    return run


def _unflatten(flat: np.ndarray) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for k, s in SHAPES.items():
        size = math.prod(s)
        out[k] = flat[at : at + size].reshape(s).astype(np.float32)
        at += size
    return out


def _score(scorer):
    def run(rows):
        s = scorer.value
        for batch in batches(rows, 500):
            past, target, n = _documents(batch.column(3).to_pylist())
            owner = np.repeat(np.arange(len(n)), n)
            per = [s.log_probabilities(past[a : a + STEP + 1], target[a : a + STEP + 1]).sum(axis=1, dtype=np.float64) for a in range(0, len(past) - 1, STEP)]
            totals = np.bincount(owner[:-1], np.concatenate(per), len(n))
            columns = [batch.column(i) for i in (0, 1, 2, 4, 5)] + [pa.array(totals / math.log(10))]
            yield pa.RecordBatch.from_arrays(columns, names=["a", "b", "n", "held", "y", "score"])

    return run


def _split(parts: int):
    """The word lists cut by ranges of keys: part, block, first place of the words in the block, keys, counts."""
    bounds = np.arange(1, parts, dtype=np.uint64) * np.uint64(((1 << 64) - 1) // parts)

    def run(rows):
        for batch in batches(rows, 20):
            out = [[], [], [], [], []]
            for block, x, y in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                keys, n = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint32)
                edges = np.concatenate([[0], np.searchsorted(keys, bounds), [len(keys)]])
                for p in np.flatnonzero(np.diff(edges)).tolist():
                    a, b = edges[p], edges[p + 1]
                    for held, value in zip(out, (p, block, a, keys[a:b].tobytes(), n[a:b].tobytes()), strict=True):
                        held.append(value)
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(out, kinds, strict=True)], names=["part", "b", "at", "x", "y"])

    return run


def _sum_counts(rows: pa.Table) -> pa.Table:
    """The words of one range of keys: each block's list with the counts of all blocks, and, once, how many words have any."""
    x = [np.frombuffer(c, np.uint64) for c in rows["x"].to_pylist()]
    _, which = np.unique(np.concatenate(x), return_inverse=True)
    total = np.bincount(which, np.concatenate([np.frombuffer(c, np.uint32) for c in rows["y"].to_pylist()])).astype(np.int64)
    ends = np.cumsum([len(c) for c in x])
    sums = [total[which[b - len(c) : b]].tobytes() for c, b in zip(x, ends, strict=True)]
    return pa.table({"b": rows["b"], "at": rows["at"], "totals": pa.array(sums, pa.binary()), "words": pa.array([int((total > 0).sum())] + [0] * (len(x) - 1), pa.int64())})


def _base(key, docs, words):
    """Per document of a block: known words, and the sum of log10(count + 1)."""
    lists = sorted(zip(words["at"].to_pylist(), words["totals"].to_pylist(), strict=True))
    totals = np.frombuffer(b"".join(x for _, x in lists), np.int64)
    logs, known = np.log10(totals + 1.0), totals > 0
    sums, n_known = np.zeros(docs.num_rows), np.zeros(docs.num_rows, np.int64)
    for i, cell in enumerate(docs["y"].to_pylist()):
        at = np.frombuffer(zstandard.ZstdDecompressor().decompress(cell), np.uint32)
        sums[i], n_known[i] = logs[at].sum(), known[at].sum()
    return pa.table({"a": docs["a"], "held": docs["held"], "n": docs["n"], "score": docs["score"], "known": n_known, "sums": sums})


def score(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", held_out: str = "held_out", vocabulary: str = VOCABULARY, rounds: int = 2
) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score. Rows with ``held_out``
    teach nothing. The training windows are dealt over the rounds by turns, so each is learned from once."""
    spark = docs.sparkSession
    scratch = Scratch(spark)
    with open(vocabulary, "rb") as f:
        sent = spark.sparkContext.broadcast(f.read())
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(held_out), F.lit(False)).alias("held"), F.col(text).cast("string").alias("text"))
    schema = "kind int, a long, b long, n long, held boolean, x binary, y binary, v array<int>"
    staged = scratch.keep(rows.mapInArrow(_read(sent), schema), "read", "kind")
    documents = staged.where(F.col("kind") == DOC)

    pairs = staged.where(F.col("kind") == PAIR).groupBy("a").agg(*[F.sum(F.col("v")[h]).alias(f"c{h}") for h in range(PART)]).toArrow()
    counts = np.zeros((IDS * BUCKETS // PART, PART))
    counts[np.asarray(pairs["a"])] = np.stack([np.asarray(pairs[f"c{h}"]) for h in range(PART)], axis=1)
    tables = tables_from_counts(counts.reshape(IDS, BUCKETS))
    shared, weights = spark.sparkContext.broadcast(tables), initial()
    for turn in range(rounds):
        learned = documents.where(~F.col("held")).select("x").mapInArrow(_learn(shared, weights, turn, rounds), "i int, wv double, n double")
        found = learned.groupBy("i").agg((F.sum("wv") / F.sum("n")).alias("w")).collect()
        if found:
            weights = _unflatten(np.array([r.w for r in sorted(found, key=lambda r: r.i)]))

    scorer = spark.sparkContext.broadcast(Scorer(tables, weights))
    scored = documents.select("a", "b", "n", "x", "held", "y").mapInArrow(_score(scorer), "a long, b long, n long, held boolean, y binary, score double")
    words = staged.where(F.col("kind") == WORD)
    listed = words.agg(F.coalesce(F.sum("a"), F.lit(0)).alias("n")).first().n
    split = words.select("b", "x", "y").mapInArrow(_split(-(-listed // PART_WORDS) or 1), "part long, b long, at long, x binary, y binary")
    words = scratch.keep(split.groupBy("part").applyInArrow(_sum_counts, "b long, at long, totals binary, words long"), "words")
    based = scored.groupBy("b").cogroup(words.select("b", "at", "totals").groupBy("b")).applyInArrow(_base, "a long, held boolean, n long, score double, known long, sums double")
    based = scratch.keep(based, "based")
    whole = based.agg(F.coalesce(F.sum(F.when(~F.col("held"), F.col("n") + 1)), F.lit(0)).alias("tokens"), F.count(F.when(~F.col("held"), 1)).alias("ends")).first()
    distinct = words.agg(F.coalesce(F.sum("words"), F.lit(0)).alias("n")).first().n + (whole.ends > 0)
    scratch.drop("read", "words")
    n_tokens = F.col("n") + 1
    return based.select(
        F.col("a").alias("doc_id"),
        F.col("held").alias("held_out"),
        n_tokens.alias("n_tokens"),
        (F.col("known") + (1 if whole.ends else 0)).alias("n_known"),
        F.lit(whole.tokens).cast("long").alias("train_tokens"),
        (F.col("sums") + math.log10(whole.ends + 1) - n_tokens * math.log10(whole.tokens + distinct + 1)).alias("base_score"),
        "score",
    )
