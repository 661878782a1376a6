"""Byte-level BPE by prefix dynamic programming: each byte prefix keeps the one token that its encoding ends with.

Of all tokens that end at a byte, exactly one follows the last token of the prefix before it in such a way that byte-pair merging
of the two gives the two again; that one is stored. The encoding of any prefix is read off by walking back over stored tokens. So
bytes can be appended without touching what is stored, and after an edit only the bytes near it are worked out again: a token
depends on as many prefixes before it as the longest token has bytes, and once that many agree with the old ones, all do.

Whether two tokens may stand side by side is found by undoing their merges along the seam, the later merge first: at each step no
merge across the seam may come before the one undone. Answers are kept per pair.

Texts are parted by the published pattern first and each part is encoded for itself, so an append or edit begins at the first part
whose match could see the change, and ends where the new parts fall on old boundaries again. Parts seen before are looked
up; that memo is bounded, and so is memory, whatever the texts.

The vocabulary file is read once by the driver and sent to the tasks: its size doesn't depend on the data. Nothing is shuffled.

Defined cases: null and empty texts encode to no ids and decode to no bytes. Texts of any length are encoded whole, a part without
end included. A part that is a token as a whole is that token. Repeated rows are encoded each. Ids that the vocabulary lacks, and
null ids, are an error in ``decode``; a null list decodes to no bytes. Bytes that are no UTF-8 are kept as bytes. An empty table gives an
empty result. Only the named columns are read; others pass through ``encode``, ``append``, ``edit`` and ``decode`` unless they bear an added name.
"""

from __future__ import annotations

import base64
import hashlib
from array import array
from bisect import bisect_left, bisect_right
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import batches, texts
from tidemark.llm.token_counts import PATTERN, VOCABULARY

#: Parts and pairs of tokens that a Python worker remembers; longer parts are not remembered.
MEMO_PARTS, MEMO_PAIRS, MEMO_CHARS = 600_000, 500_000, 64
#: A match sees one character beyond its end and, for the forms after an apostrophe, three from its beginning.
SEES_BEYOND, SEES_FROM_START = 1, 3


def read_ranks(vocabulary: bytes) -> dict[bytes, int]:
    """Token bytes to id, of lines "base64 id"."""
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, vocabulary.splitlines())}


class Vocabulary:
    def __init__(self, ranks: dict[bytes, int]):
        import ahocorasick

        self.ranks, self.longest = ranks, max(map(len, ranks))
        self.token = {i: t for t, i in ranks.items()}
        self.size = {i: len(t) for t, i in ranks.items()}
        #: Finds all tokens that end at each byte; bytes are the first 256 characters.
        self.finder = ahocorasick.Automaton()
        for t, i in ranks.items():
            self.finder.add_word(t.decode("latin-1"), i)
        self.finder.make_automaton()
        self.halves: dict[int, tuple[int, int] | None] = {}
        self.pairs: dict[int, bool] = {}  # by left * 2 ** 32 + right

    def merged(self, body: bytes, below: int) -> list[int]:
        """Byte-pair merging with the ranks under ``below`` only; for single tokens, so short."""
        parts = [body[i : i + 1] for i in range(len(body))]
        while len(parts) > 1:
            rank, at = min((self.ranks.get(a + b, below), i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False)))
            if rank >= below:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [self.ranks[p] for p in parts]

    def split(self, token: int) -> tuple[int, int] | None:
        """The two tokens whose merge gives this one; None for a single byte."""
        if token not in self.halves:
            body = self.token[token]
            parts = self.merged(body, token) if len(body) > 1 else ()
            self.halves[token] = (parts[0], parts[1]) if len(parts) == 2 else None
        return self.halves[token]

    def made_by_merging(self, token: int) -> bool:
        return len(self.token[token]) == 1 or self.split(token) is not None

    def follows(self, left: int, right: int) -> bool:
        """Whether merging the bytes of both gives just these two tokens; ``left`` is a prefix's last token, or -1 where there is none."""
        key = (left << 32) + right
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) >= MEMO_PAIRS:
                self.pairs.clear()
            known = self.pairs[key] = self.made_by_merging(right) and (left < 0 or self._seam_holds(left, right))
        return known

    def last_tokens(self, body: str) -> list[int]:
        """The last token of each prefix of a part, given with its bytes as characters."""
        size, known, follows, last, n = self.size, self.pairs.get, self.follows, [-1], 0
        for at, token in self.finder.iter(body):
            if at == n:
                left = last[at + 1 - size[token]]
                fits = known((left << 32) + token)
                if fits or (fits is None and follows(left, token)):
                    last.append(token)
                    n += 1
        if n < len(body):
            raise ValueError("the vocabulary lacks a byte")
        return last[1:]

    def walk_back(self, last: list[int]) -> list[int]:
        """The encoding that the last tokens stand for."""
        out, at, size = [], len(last), self.size
        while at:
            token = last[at - 1]
            out.append(token)
            at -= size[token]
        out.reverse()
        return out

    def _seam_holds(self, left: int, right: int) -> bool:
        # the merge across the seam loses ties against one on its left, which merging does first, and wins them against one on its right
        undone, wins_ties = None, False
        token, ranks = self.token, self.ranks
        while True:
            across = ranks.get(token[left] + token[right])
            if across is not None and (undone is None or across < undone or (wins_ties and across == undone)):
                return False
            first, second = self.split(left), self.split(right)
            if first is None and second is None:
                return True
            if second is None or (first is not None and left > right):
                undone, wins_ties, left = left, False, first[1]
            else:
                undone, wins_ties, right = right, True, second[0]


class Prefixes:
    """The last token of every byte prefix of one part. Bytes can be appended or replaced."""

    def __init__(self, vocabulary: Vocabulary, body: bytes = b""):
        self.vocabulary, self.body, self.last = vocabulary, b"", []
        #: Prefixes worked out by the last change.
        self.worked = 0
        self.append(body)

    def copy(self) -> Prefixes:
        out = Prefixes(self.vocabulary)
        out.body, out.last = self.body, list(self.last)
        return out

    def _walk(self, begin: int, last: list[int]) -> Iterator[int]:
        """Store the tokens of the prefixes of more than ``begin`` bytes in ``last``, one after the other; their ends."""
        v, end = self.vocabulary, begin
        shift = max(0, begin - v.longest)
        for at, token in v.finder.iter(self.body[shift:].decode("latin-1")):
            if at + shift == end:
                start = end + 1 - v.size[token]
                if v.follows(last[start - 1] if start else -1, token):
                    last.append(token)
                    end += 1
                    yield end
        if end < len(self.body):
            raise ValueError("the vocabulary lacks a byte")

    def append(self, more: bytes) -> None:
        begin = len(self.body)
        self.body += more
        self.worked = sum(1 for _ in self._walk(begin, self.last))

    def replace(self, start: int, stop: int, new: bytes) -> None:
        """Put ``new`` for the bytes from ``start`` to ``stop``; later prefixes are worked out until they agree with the old ones."""
        old, shift = self.last, len(new) - (stop - start)
        self.body = self.body[:start] + new + self.body[stop:]
        last, agree = old[:start], 0
        for end in self._walk(start, last):
            before = end - 1 - shift
            agree = agree + 1 if before >= stop and old[before] == last[-1] else 0
            if agree >= self.vocabulary.longest:
                break
        self.worked = len(last) - start
        self.last = last + old[len(last) - shift :]

    def ids(self) -> list[int]:
        """The encoding: stored tokens from the end to the beginning. A part that is a token as a whole is that token."""
        whole = self.vocabulary.ranks.get(self.body)
        return [whole] if whole is not None else self.vocabulary.walk_back(self.last)


class Encoder:
    """Encodes texts part by part. Parts that are tokens are looked up; others are remembered in two halves, of which the older is
    dropped when the newer is full."""

    def __init__(self, vocabulary: bytes, pattern: str = PATTERN):
        import regex

        self.vocabulary = Vocabulary(read_ranks(vocabulary))
        self.parts = regex.compile(pattern).findall
        self.matches = regex.compile(pattern).finditer
        self.whole = {}
        for t, i in self.vocabulary.ranks.items():
            try:
                self.whole[t.decode()] = i.to_bytes(4, "little")
            except UnicodeDecodeError:
                pass
        self.newer: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def part(self, part: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers, of a part that is no token."""
        ids = self.newer.get(part) or self.older.get(part)
        if ids is None:
            v = self.vocabulary
            body = part if part.isascii() else part.encode().decode("latin-1")
            ids = array("I", v.walk_back(v.last_tokens(body))).tobytes()
        if len(part) <= MEMO_CHARS:
            if len(self.newer) >= MEMO_PARTS // 2:
                self.older, self.newer = self.newer, {}
            self.newer[part] = ids
        return ids

    def packed(self, text: str) -> bytes:
        whole, seen, part = self.whole.get, self.newer.get, self.part
        return b"".join([whole(p) or seen(p) or part(p) for p in self.parts(text)])

    def ids(self, text: str) -> list[int]:
        return np.frombuffer(self.packed(text), "<u4").tolist()

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.vocabulary.token.__getitem__, ids))


class Edited:
    """A text with its parts' boundaries (in characters) and prefixes: appends and edits encode only the parts that they change."""

    def __init__(self, encoder: Encoder, text: str = ""):
        self.encoder, self.text, self.ends, self.parts = encoder, "", [], []
        #: Byte prefixes worked out by the last change.
        self.worked = 0
        self.replace(0, 0, text)

    @classmethod
    def restored(cls, encoder: Encoder, text: str, ids: list[int]) -> Edited:
        """From a text and its ids: boundaries are found by the pattern, ids are dealt out by their bytes, nothing is encoded again."""
        self = cls(encoder)
        self.text, at = text, 0
        for match in encoder.matches(text):
            size, begin = len(match[0].encode()), at
            while size:
                size -= len(encoder.vocabulary.token[ids[at]])
                at += 1
            self.ends.append(match.end())
            self.parts.append(ids[begin:at])
        return self

    def append(self, more: str) -> None:
        self.replace(len(self.text), len(self.text), more)

    def replace(self, start: int, stop: int, new: str) -> None:
        shift = len(new) - (stop - start)
        self.text = self.text[:start] + new + self.text[stop:]
        first = bisect_right(self.ends, start - SEES_BEYOND)
        begins = lambda k: self.ends[k - 1] if k else 0
        while first and begins(first - 1) + SEES_FROM_START > start:
            first -= 1
        ends, parts, rest, self.worked = [], [], len(self.ends), 0
        for match in self.encoder.matches(self.text, begins(first)):
            at = match.end()
            ends.append(at)
            parts.append(self._encoded(match[0], first + len(parts)))
            if at - shift >= stop:
                same = bisect_left(self.ends, at - shift)
                if same < len(self.ends) and self.ends[same] == at - shift:
                    rest = same + 1
                    break
        self.parts[first:] = parts + self.parts[rest:]
        self.ends[first:] = ends + [e + shift for e in self.ends[rest:]]

    def _encoded(self, part: str, k: int) -> Prefixes | list[int]:
        """A long part goes on from the prefixes of the one that stood at its place."""
        old = self.parts[k] if k < len(self.parts) else None
        body = part.encode()
        if isinstance(old, Prefixes) and len(body) > MEMO_CHARS:
            head = 0
            limit = min(len(body), len(old.body))
            while head < limit and body[head : head + 64] == old.body[head : head + 64]:
                head = min(head + 64, limit)
            while head < limit and body[head] == old.body[head]:
                head += 1
            tail = 0
            while tail < limit - head and body[-1 - tail] == old.body[-1 - tail]:
                tail += 1
            fresh = old.copy()
            fresh.replace(head, len(old.body) - tail, body[head : len(body) - tail])
            self.worked += fresh.worked
            return fresh
        self.worked += len(body)
        return Prefixes(self.encoder.vocabulary, body) if len(body) > MEMO_CHARS else np.frombuffer(self.encoder.packed(part), "<u4").tolist()

    def ids(self) -> list[int]:
        return [i for p in self.parts for i in (p.ids() if isinstance(p, Prefixes) else p)]


@lru_cache(maxsize=1)
def encoder(vocabulary: bytes) -> Encoder:
    """A Python worker keeps its encoder from task to task."""
    return Encoder(vocabulary)


def _sent(docs: DataFrame, vocabulary: str) -> Broadcast:
    with open(vocabulary, "rb") as f:
        return docs.sparkSession.sparkContext.broadcast(f.read())


def _with_column(docs: DataFrame, read: list, added: str, kind: str, make: Callable) -> DataFrame:
    """``docs`` with a column that ``make(encoder)(values of read...)`` gives; the other columns pass through as they are."""
    kept = [c for c in docs.columns if c != added]
    names = [f"__read{i}" for i in range(len(read))]
    rows = docs.select(*[F.col(f"`{c}`") for c in kept], *[c.alias(n) for c, n in zip(read, names, strict=True)])
    held = rows.select(*kept).schema if kept else None
    out = [f"`{f.name}` {f.dataType.simpleString()}" for f in (held or [])] + [f"`{added}` {kind}"]

    def run(parts):
        value = make()
        for batch in batches(parts, 500):
            columns = list(batch.columns)
            made = [value(*row) for row in zip(*(c.to_pylist() for c in columns[len(kept) :]), strict=True)]
            array = pa.array(made, pa.binary() if kind == "binary" else pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([*columns[: len(kept)], array], names=[*kept, added])

    return rows.mapInArrow(run, ", ".join(out))


def encode(docs: DataFrame, text: str = "text", ids: str = "ids", vocabulary: str = VOCABULARY) -> DataFrame:
    """``docs`` with the ids of each whole text."""
    sent = _sent(docs, vocabulary)

    def make():
        encode = encoder(sent.value).ids
        return lambda body: encode(body or "")

    return _with_column(docs, [F.col(f"`{text}`").cast("string")], ids, "array<int>", make)


def decode(encoded: DataFrame, ids: str = "ids", bytes_: str = "bytes", vocabulary: str = VOCABULARY) -> DataFrame:
    """``encoded`` with the bytes that the ids stand for."""
    sent = _sent(encoded, vocabulary)

    def make():
        token = {i: t for t, i in read_ranks(sent.value).items()}
        return lambda one: b"".join(map(token.__getitem__, one or ()))

    return _with_column(encoded, [F.col(f"`{ids}`")], bytes_, "binary", make)


def edit(encoded: DataFrame, start: str, stop: str, new: str, text: str = "text", ids: str = "ids", vocabulary: str = VOCABULARY) -> DataFrame:
    """``encoded`` (as of ``encode``) with text and ids after the characters from column ``start`` to column ``stop`` have become
    column ``new``. Parts that don't see the change keep their ids. A null place is the text's end, a null ``new`` is empty."""
    sent = _sent(encoded, vocabulary)

    def make():
        own = encoder(sent.value)

        def value(body, had, a, b, fresh):
            edited = Edited.restored(own, body or "", had or [])
            n = len(edited.text)
            a = n if a is None else min(max(a, 0), n)
            b = n if b is None else min(max(b, a), n)
            edited.replace(a, b, fresh or "")
            return edited.ids()

        return value

    read = [F.col(f"`{text}`").cast("string"), F.col(f"`{ids}`"), F.col(f"`{start}`").cast("long"), F.col(f"`{stop}`").cast("long"), F.col(f"`{new}`").cast("string")]
    out = _with_column(encoded, read, "__ids", "array<int>", make)
    body, fresh = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")), F.coalesce(F.col(f"`{new}`").cast("string"), F.lit(""))
    n = F.length(body)
    a = F.least(F.greatest(F.coalesce(F.col(f"`{start}`").cast("long"), n), F.lit(0)), n)
    b = F.least(F.greatest(F.coalesce(F.col(f"`{stop}`").cast("long"), n), a), n)
    whole = F.concat(F.substring(body, F.lit(1), a.cast("int")), fresh, F.substring(body, (b + 1).cast("int"), n))
    changed = {text: whole.alias(text), ids: F.col("__ids").alias(ids)}
    return out.select(*[changed.get(c, F.col(f"`{c}`")) for c in encoded.columns])


def append(encoded: DataFrame, more: str, text: str = "text", ids: str = "ids", vocabulary: str = VOCABULARY) -> DataFrame:
    """``encoded`` with column ``more`` at the end of each text; only the last parts are encoded again."""
    at_end = encoded.withColumn("__end", F.lit(None).cast("long"))
    return edit(at_end, "__end", "__end", more, text, ids, vocabulary).drop("__end")


def report(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", vocabulary: str = VOCABULARY) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 (ids as little-endian unsigned 32-bit integers), decoded_sha256 (bytes that the ids decode to)."""
    sent = _sent(docs, vocabulary)

    def run(parts):
        own = encoder(sent.value)
        for batch in batches(parts, 500):
            n, of_ids, of_bytes = [], [], []
            for body in texts(batch.column(1)):
                packed = own.packed(body)
                n.append(len(packed) // 4)
                of_ids.append(hashlib.sha256(packed).hexdigest())
                of_bytes.append(hashlib.sha256(own.decode(np.frombuffer(packed, "<u4").tolist())).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_bytes, pa.string())], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, n_tokens long, ids_sha256 string, decoded_sha256 string")
