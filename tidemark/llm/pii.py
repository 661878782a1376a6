"""Personal data: patterns, and the terms that give the protected kind away.

Patterns find e-mail addresses, IP addresses, card numbers and phone numbers; opaque runs of letters and digits (keys, tokens,
hashes) are protected beside them. The corpus then tells how strongly terms reveal a kind. With W observations in the
corpus, W_k of them beside a value of kind k, and a term that is observed c times, c_k of them there, the information the term
gives is PMI = log2((c_k / c) / (W_k / W)), and what there is to give is IC = -log2(W_k / W). PMI / IC is the share of the
kind's information that the term discloses: 1 for a term that occurs nowhere else. Two scopes are counted:

- near: an observation is a word, and is beside a value when it is one of ``reach`` words before or after it;
- document: an observation is a document, and is beside a value when it holds one.

Terms at or over ``remove_at`` in either scope are removed, those at or over ``generalise_at`` are generalised, wherever they stand
in a document that holds a value of the kind. A term counts only with evidence that is the same for any size of corpus: near
values in at least ``min_contexts`` different contexts, or in documents with as many different values, so copies of one text
prove nothing; in the document scope chance must also be ruled out, c * KL(c_k / c, W_k / W) being ``min_bits`` bits at least.

Counts and PMI are tables. Disclosing terms are sent to every task up to ``max_sent`` of them; were there more, the terms of
each document with values would meet them by a shuffle, with the same result.

Defined cases: a null or empty text has no spans. Repeated rows get the same spans. A corpus without values has no terms. Texts
of any length are read whole, and a context reaches as far as its words do. Equal shares are settled by the thresholds alone. Only
the named columns are read, so further columns of any name do no harm; ids keep their type.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from bisect import bisect_left
from collections import Counter
from itertools import repeat

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import Scratch, batches, texts

KINDS = ("email", "ip", "card", "phone")
#: What is protected: the four kinds and opaque runs.
PROTECTED = (*KINDS, "secret")
SECRET = 4
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]+")
_TERM = re.compile(r"[^\W\d_]+")
_OPAQUE = re.compile(r"(?<![A-Za-z0-9_])[A-Za-z0-9_]{20,}(?![A-Za-z0-9_])")
NEAR, DOCUMENT = range(2)


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _emails(text: str) -> list[tuple[int, int]]:
    out, end, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at) if start < at else None
        if m:
            end = m.end()
            out.append((start, end))
        at = text.find("@", m.end() if m else at + 1)
    return out


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind's place in KINDS, start, end) of all values, by kind, then start."""
    out = [(0, a, b) for a, b in _emails(text)] if "@" in text else []
    if not _DIGIT.search(text):
        return out
    if "." in text:
        out += [(1, *m.span()) for m in _IP.finditer(text) if all(int(p) <= 255 for p in _clipped(m[0]))]
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13:
            digits = _NOT_DIGIT.sub("", m[0])
            if 13 <= len(digits) <= 19 and luhn(digits):
                out.append((2, *m.span()))
    if "+" in text:
        out += [(3, *m.span()) for m in _PHONE.finditer(text) if 9 <= len(_NOT_DIGIT.sub("", m[0])) <= 15]
    return out


def _clipped(ip: str) -> list[str]:
    # parts of many digits are over 255 unless zeros lead
    return [p.lstrip("0")[:4] or "0" for p in ip.split(".")]


def secret_spans(text: str, taken: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Runs of 20 or more letters and digits, four of each at least and of ten different ones, outside the values found so far."""
    out = []
    for m in _OPAQUE.finditer(text):
        digits = sum(c.isdigit() for c in m[0])
        if digits >= 4 and len(m[0]) - digits >= 4 and len(set(m[0])) >= 10 and not any(a < m.end() and m.start() < b for _, a, b in taken):
            out.append((SECRET, *m.span()))
    return out


def protected_spans(text: str) -> list[tuple[int, int, int]]:
    """Values of the four kinds, then opaque runs."""
    base = base_spans(text)
    return base + secret_spans(text, base)


def masked_terms(text: str, spans: list[tuple[int, int, int]]) -> list[tuple[str, int, int]]:
    """Lower-case terms of the text with their places. Values are no terms."""
    parts, end = [], 0
    for a, b in sorted(s[1:] for s in spans):
        if b > end:
            parts += [text[end : max(a, end)], "\x00" * (b - max(a, end))]
            end = b
    return [(m[0].lower(), m.start(), m.end()) for m in _TERM.finditer("".join([*parts, text[end:]]))]


def contexts(spans: list[tuple[int, int, int]], terms: list[tuple[str, int, int]], reach: int) -> list[tuple[int, list[str]]]:
    """For each value its kind and the terms within reach of it."""
    starts = [a for _, a, _ in terms]
    out = []
    for kind, a, b in spans:
        before, after = bisect_left(starts, a), bisect_left(starts, b)
        out.append((kind, [w for w, _, _ in terms[max(0, before - reach) : before] + terms[after : after + reach]]))
    return out


def _hash(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text) - (1 << 63)


_SEEN = "scope int, kind int, term string, n long, marks array<long>"


def _observed(reach: int, least: int, flush: int = 200_000):
    """Per task: of each scope, kind and term the observations beside values, and the ``least`` smallest of its marks. A mark
    is a context's words (near), or a value (document). A row without a term stands for all observations beside the kind.
    A few marks are enough to tell whether there are ``least`` different ones."""

    def run(rows):
        n: Counter = Counter()
        marks: dict[tuple, set[int]] = {}

        def see(key, times, found):
            n[key] += times
            held = marks.setdefault(key, set())
            held |= found
            if len(held) > 4 * least:
                marks[key] = set(heapq.nsmallest(least, held))

        def out():
            keys = list(n)
            columns = [pa.array([k[0] for k in keys], pa.int32()), pa.array([k[1] for k in keys], pa.int32()), pa.array([k[2] for k in keys], pa.string())]
            columns += [pa.array([n[k] for k in keys], pa.int64()), pa.array([heapq.nsmallest(least, marks[k]) for k in keys], pa.list_(pa.int64()))]
            n.clear()
            marks.clear()
            return pa.RecordBatch.from_arrays(columns, names=["scope", "kind", "term", "n", "marks"])

        for batch in batches(rows):
            for text in texts(batch.column(0)):
                spans = protected_spans(text)
                if not spans:
                    continue
                terms = masked_terms(text, spans)
                for kind, words in contexts(spans, terms, reach):
                    mark = {_hash(" ".join(words))}
                    see((NEAR, kind, None), len(words), mark)
                    for term, times in Counter(words).items():
                        see((NEAR, kind, term), times, mark)
                distinct = {w for w, _, _ in terms}
                for kind in {k for k, _, _ in spans}:
                    values = {_hash(text[a:b]) for k, a, b in spans if k == kind}
                    see((DOCUMENT, kind, None), 1, values)
                    for term in distinct:
                        see((DOCUMENT, kind, term), 1, values)
                if len(n) > flush:
                    yield out()
        yield out()

    return run


def _totals(rows):
    """Per batch: how often each term is observed, as a word and by documents; without a term: all observations."""
    for batch in batches(rows):
        words, docs, size = Counter(), Counter(), 0
        for body in texts(batch.column(0)):
            found = Counter(_TERM.findall(body.lower()))
            words.update(found)
            docs.update(found.keys())
            size += 1
        keys = list(words)
        columns = [pa.array([None, *keys], pa.string()), pa.array([words.total(), *words.values()], pa.int64()), pa.array([size, *(docs[k] for k in keys)], pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, names=["term", "words", "docs"])


def disclosures(docs: DataFrame, text: str, reach: int, min_contexts: int, min_bits: float, scratch: Scratch) -> DataFrame:
    """kind, term, disclosed: the larger PMI / IC of the two scopes, of all terms with evidence enough. Counts cover all of ``docs``."""
    bodies = docs.select(F.col(text).cast("string").alias("text"))
    seen = bodies.mapInArrow(_observed(reach, min_contexts), _SEEN)
    # a task says a term once or a few times, with few marks; salted all the same, as every task says the common ones
    least = F.slice(F.array_sort(F.array_distinct(F.flatten(F.collect_list("marks")))), 1, min_contexts)
    salt = F.pmod(F.xxhash64("marks"), F.lit(64))
    first = seen.groupBy("scope", "kind", "term", salt.alias("salt")).agg(F.sum("n").alias("n"), least.alias("marks"))
    seen = scratch.keep(first.groupBy("scope", "kind", "term").agg(F.sum("n").alias("n"), F.size(least).alias("contexts")), "seen")
    near_terms = seen.where(F.col("term").isNotNull() & (F.col("contexts") >= min_contexts))
    totals = bodies.mapInArrow(_totals, "term string, words long, docs long").groupBy("term").agg(F.sum("words").alias("words"), F.sum("docs").alias("docs"))
    wanted = near_terms.select("term").distinct().withColumn("wanted", F.lit(True))
    totals = scratch.keep(totals.join(wanted, "term", "left").where("wanted OR term IS NULL").drop("wanted"), "totals")
    size = lambda: F.when(F.col("scope") == NEAR, F.col("words")).otherwise(F.col("docs"))
    whole = seen.where(F.col("term").isNull()).crossJoin(F.broadcast(totals.where(F.col("term").isNull()).select("words", "docs")))
    shares = whole.select("scope", "kind", (F.col("n") / size()).alias("share")).where("share > 0 AND share < 1")
    within = F.least(F.lit(1.0), F.col("n") / F.greatest(F.coalesce(size(), F.lit(0)), F.col("n")))
    told = near_terms.join(totals, "term").join(F.broadcast(shares), ["scope", "kind"]).withColumn("within", within)
    p, q = F.col("share"), F.col("within")
    # the rest of the divergence is 0 where the term never stands elsewhere
    apart = q * F.log2(q / p) + F.when(q < 1, (1 - q) * F.log2((1 - q) / (1 - p))).otherwise(0.0)
    sure = (F.col("scope") == NEAR) | ((q > p) & (size() * apart >= min_bits))
    return told.where(sure).groupBy("kind", "term").agg(F.max(F.log2(q / p) / -F.log2(p)).alias("disclosed"))


def disclosing_table(
    docs: DataFrame,
    text: str = "text",
    reach: int = 5,
    min_contexts: int = 5,
    min_bits: float = 25.0,
    generalise_at: float = 0.8,
    remove_at: float = 0.9,
) -> DataFrame:
    """kind, term, gone of all disclosing terms; gone: remove, else generalise."""
    scratch = Scratch(docs.sparkSession)
    told = disclosures(docs, text, reach, min_contexts, min_bits, scratch).where(F.col("disclosed") >= generalise_at)
    out = scratch.keep(told.select("kind", "term", (F.col("disclosed") >= remove_at).alias("gone")), "disclosing")
    scratch.drop("seen", "totals")
    return out


def disclosing_terms(docs: DataFrame, text: str = "text", **parameters) -> dict[tuple[int, str], bool]:
    """(kind, term) of all disclosing terms; True: remove, False: generalise."""
    return {(r.kind, r.term): r.gone for r in disclosing_table(docs, text, **parameters).toLocalIterator()}


def _term_spans(terms: list[tuple[str, int, int]], kinds: set[int], disclosing: dict) -> list[tuple[int, int, bool]]:
    """Places of the terms that disclose one of the kinds."""
    out = []
    for word, a, b in terms:
        gone = [disclosing[k, word] for k in kinds if (k, word) in disclosing]
        if gone:
            out.append((a, b, any(gone)))
    return out


def found_spans(text: str, disclosing: dict) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, bool]]]:
    """Protected values, and terms that disclose them."""
    spans = protected_spans(text)
    if not spans or not disclosing:
        return spans, []
    return spans, _term_spans(masked_terms(text, spans), {k for k, _, _ in spans}, disclosing)


#: Disclosing terms that every task is sent at most.
MAX_SENT = 100_000


def _own_terms(rows):
    """Of each document with values: its row, and the kinds and terms it could disclose by."""
    for batch in batches(rows):
        out = [[], [], []]
        for row, text in zip(batch.column(0).to_pylist(), texts(batch.column(1)), strict=True):
            if spans := protected_spans(text):
                for word in {w for w, _, _ in masked_terms(text, spans)}:
                    for kind in {k for k, _, _ in spans}:
                        for held, value in zip(out, (row, kind, word), strict=True):
                            held.append(value)
        yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int32()), pa.array(out[2], pa.string())], names=["__row", "kind", "term"])


def with_disclosing(docs: DataFrame, text: str, max_sent: int, **parameters):
    """``docs``, and a function from a batch to the disclosing terms of each of its rows: one list for all, sent to the tasks, or, when
    that would be too long, a last column of ``docs`` with each row's own."""
    found = disclosing_table(docs, text, **parameters)
    if found.limit(max_sent + 1).count() <= max_sent:
        sent = docs.sparkSession.sparkContext.broadcast({(r.kind, r.term): r.gone for r in found.collect()})
        return docs, lambda batch: repeat(sent.value, batch.num_rows)
    staged = Scratch(docs.sparkSession).keep(docs.withColumn("__row", F.monotonically_increasing_id()), "rows")
    own = staged.select("__row", F.col(text).cast("string")).mapInArrow(_own_terms, "__row long, kind int, term string").join(found, ["kind", "term"])
    own = own.groupBy("__row").agg(F.collect_list(F.struct("kind", "term", "gone")).alias("__terms"))
    docs = staged.join(own, "__row", "left").drop("__row")
    return docs, lambda batch: [{(x["kind"], x["term"]): x["gone"] for x in row or ()} for row in batch.column(batch.num_columns - 1).to_pylist()]


def report(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", max_sent: int = MAX_SENT, **parameters) -> DataFrame:
    """One row per document: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_secret, n_term. In ``spans`` opaque runs come
    after the kinds, and terms last."""
    rows, known = with_disclosing(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text")), "text", max_sent, **parameters)

    def run(parts):
        for batch in batches(parts):
            counts: list[list[int]] = [[] for _ in PROTECTED]
            digests, joined, n_terms = [], [], []
            for body, disclosing in zip(texts(batch.column(1)), known(batch), strict=True):
                spans, terms = found_spans(body, disclosing)
                n = Counter(k for k, _, _ in spans)
                for k, held in enumerate(counts):
                    held.append(n[k])
                n_terms.append(len(terms))
                said = [f"{PROTECTED[k]}:{a}:{b}" for k, a, b in spans]
                digests.append(hashlib.sha256(",".join(said[: len(said) - n[SECRET]]).encode()).hexdigest())
                joined.append(",".join(said + [f"term:{a}:{b}" for a, b, _ in terms]))
            arrays = [batch.column(0), *(pa.array(c, pa.int64()) for c in counts[:4]), pa.array(digests, pa.string()), pa.array(joined, pa.string())]
            arrays += [pa.array(counts[SECRET], pa.int64()), pa.array(n_terms, pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    names = ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_secret", "n_term"]
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_secret long, n_term long"
    return rows.mapInArrow(run, schema)


def redacted(text: str, disclosing: dict) -> str:
    """The text with each value as its kind in brackets, generalised terms as [TERM], and removed terms gone."""
    spans, terms = found_spans(text, disclosing)
    if not spans:
        return text
    marks = [(a, b, f"[{PROTECTED[k].upper()}]") for k, a, b in spans]
    marks += [(a, b, "" if gone else "[TERM]") for a, b, gone in terms]
    parts, end = [], 0
    for a, b, mark in sorted(marks):
        if a < end:
            end = max(end, b)  # values that overlap go as one
            continue
        parts += [text[end:a], mark]
        end = b
    return "".join([*parts, text[end:]])


def sanitise(docs: DataFrame, text: str = "text", max_sent: int = MAX_SENT, **parameters) -> DataFrame:
    """``docs`` with values and disclosing terms generalised or removed; other texts stay as they are, null ones too."""
    rows, known = with_disclosing(docs, text, max_sent, **parameters)
    at, names = docs.columns.index(text), docs.columns

    def run(parts):
        for batch in batches(parts):
            bodies = [x and redacted(x, own) for x, own in zip(batch.column(at).to_pylist(), known(batch), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(bodies, pa.string()) if i == at else batch.column(i) for i in range(len(names))], names=names)

    return rows.mapInArrow(run, docs.schema)
