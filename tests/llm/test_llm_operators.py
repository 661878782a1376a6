"""The numbered operators against brute force, and their edge cases: nulls, empty and long texts, ties, repeated rows, empty
tables and further columns with clashing names."""

import hashlib
import inspect
import math
import random
import re
import zlib
from collections import Counter
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
import zstandard
from pyspark.sql import functions as F

from tests.conftest import rows_of
from tidemark.llm import bitsliced_topk, decontaminate, jaccard_join, language_id, license_scan, lm_score, pii, source_mix, token_counts, toxicity
from tidemark.llm import queries as Q

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def word(rng, k=3):
    return "".join(rng.choice(["ka", "lo", "mi", "ten", "sur", "a", "vor"]) for _ in range(rng.randint(1, k)))


def corpus(seed=0, n=60):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        text = " ".join(word(rng) for _ in range(rng.choice([0, 1, 2, 5, 40, 120])))
        rows.append((i, text, rng.choice(["xx", "yy", None]), rng.choice(["s1", "s2", "s3", None]), len(text)))
    rows += [(n, None, None, None, None), (n + 1, "", "xx", "s1", 0), (n + 2, "123 456 !!", "xx", "s2", 10), (None, "no id here at all", "yy", None, 17)]
    rows += [(n + 3, " ".join(word(rng) for _ in range(4000)), "xx", "s1", 1), (n + 4, rows[5][1], "yy", "s2", 1), rows[7], rows[7]]
    return rows


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(corpus(), SCHEMA).repartition(3)


def clashing(df):
    """Further columns that have the names operators use."""
    for name in ("word", "n", "kind", "score", "spans", "items", "size", "block", "lang_pred", "n_words", "place", "node", "held_out"):
        df = df.withColumn(name, F.lit(7))
    return df


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.mark.parametrize("name", [n for n in Q.ORACLES])
def test_oracles(name, spark, small, duck):
    out = Q.QUERIES[name](spark, small)
    names = sorted(out.columns)
    cur = duck.execute(Q.ORACLES[name])
    columns = [d[0] for d in cur.description]
    assert sorted(columns) == names
    assert rows_of(out.collect(), out.columns, names) == rows_of(cur.fetchall(), columns, names)


# --- op1


def test_license_scan(spark):
    mit = (license_scan.TEXTS / "MIT.txt").read_text().removeprefix("MIT License\n")
    rows = [(1, "Copyright (c) 2020 Someone\n\n" + mit.upper()), (2, mit.replace(",", " ;") + "\n"), (3, "This software has no licence"), (4, None), (5, ""), (2, mit), (6, mit + " x")]
    got = [(r.doc_id, r.license_id) for r in license_scan.scan(clashing(spark.createDataFrame(rows, "doc_id long, text string"))).collect()]
    assert sorted(got, key=str) == sorted([(1, "MIT"), (2, "MIT"), (3, None), (4, None), (5, None), (2, "MIT"), (6, None)], key=str)
    assert license_scan.canonical(b"The licence, organisation") == b"the license organization"
    assert license_scan.canonical(b"wilful willful") == b"willful willful"
    assert license_scan.scan(empty(spark)).count() == 0


def test_every_known_licence_is_found(spark):
    texts = {p.stem: p.read_text(encoding="utf-8") for p in license_scan.TEXTS.glob("*.txt")}
    assert len(texts) >= 20
    rows, want = [], {}
    for name, text in texts.items():
        shapes = [text, text.upper(), "\n".join("  * " + x for x in text.split("\n")), "Copyright 2019 A. Person\n" + text, re.sub(r"\blicense\b", "licence", text)]
        # on one line a copyright line can't be told from the text
        shapes += [] if license_scan._NOTICE.search(text.lower().encode()) else [" ".join(text.split())]
        title = license_scan.TITLES.get(name, ("",))
        shapes += [f"{t}\n\nCopyright (c) 2001-2020 Some Firm\nAll rights reserved.\n\n" + text.removeprefix(title[0]) for t in title]
        shapes += ["\n".join("Copyright 2020 Me" if "Copyright [yyyy]" in x else x for x in text.split("\n"))] if name == "Apache-2.0" else []
        for shape in shapes:
            rows.append((len(rows), shape))
            want[len(rows) - 1] = name
        rows.append((len(rows), text + "\nOne more condition."))
        want[len(rows) - 1] = None
    got = {r.doc_id: r.license_id for r in license_scan.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == want
    # forms of different licences never collide
    seen = Counter(d for name, text in texts.items() for d in {license_scan.digest(f.encode()) for f in license_scan.forms(name, text)})
    assert max(seen.values()) == 1


# --- op2

_BASE = {
    "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m.split("."))),
    "card": (r"[0-9]([\x20-]?[0-9])+", lambda m: 13 <= len(re.sub(r"\D", "", m)) <= 19 and pii.luhn(re.sub(r"\D", "", m))),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(re.sub(r"\D", "", m)) <= 15),
}


def base_by_pattern(text):
    return [f"{k}:{m.start()}:{m.end()}" for k, (p, ok) in _BASE.items() for m in re.finditer(p, text, re.ASCII) if ok(m[0])]


def test_base_spans_match_the_patterns():
    rng = random.Random(3)
    pieces = ["a.b@c.de", "x@y", "@", "1.2.3.4", "1.2.3.4.5", "999.1.1.1", "4111 1111 1111 1111", "4111-1111-1111-1111", "+1 (555) 123-4567", "+1", "é", " ", ".", "-", "00.1.2.3", "a@b@c.d", "12", "%"]
    for _ in range(3000):
        text = "".join(rng.choice(pieces) for _ in range(rng.randint(0, 12)))
        assert [f"{pii.KINDS[k]}:{a}:{b}" for k, a, b in pii.base_spans(text)] == base_by_pattern(text), text
    for text in ("a" * 200_000, "1" * 200_000, "1." * 100_000, "+1" + "(" * 100_000, "a@" * 50_000):
        pii.base_spans(text)


def personal(n=40):
    rng = random.Random(5)
    rows = [(i, f"{word(rng)} {word(rng)} callme{i % 3} now at +1 (555) {i:03d}-1234 {word(rng)} {word(rng)}") for i in range(n)]
    return rows + [(n + i, " ".join(word(rng) for _ in range(30))) for i in range(200)] + [(900, None), (901, ""), (902, "callme1 alone stays")]


def test_seldom_terms_disclose_in_a_large_corpus_too(spark):
    rng = random.Random(8)
    name = lambda: "".join(rng.choice("abcdefghij") for _ in range(3))
    rows = [(i, f"{name()} {name()} {name()} {'zorblax ' if i % 2000 == 0 and i < 12_000 else ''}+1 (555) 123-4567") for i in range(14_000)]
    rows += [(20_000 + i, " ".join(name() for _ in range(1000))) for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert pii.disclosing_terms(df).get((pii.KINDS.index("phone"), "zorblax")) is True


def test_disclosing_terms_go_and_clean_texts_stay(spark):
    df = spark.createDataFrame(personal(), "doc_id long, text string").repartition(3)
    got = {r.doc_id: r for r in pii.report(clashing(df)).collect()}
    assert len(got) == 243
    for i, text in personal():
        base = base_by_pattern(text or "")
        assert got[i].base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest()
        assert got[i].n_phone == (1 if i < 40 else 0)
        extra = got[i].spans.split(",")[len(base) :] if got[i].spans else []
        assert got[i].spans.startswith(",".join(base)) and (not extra or base)
    assert any("term:" in got[i].spans for i in range(40))
    clean = {r.doc_id: r.text for r in pii.sanitise(clashing(df)).select("doc_id", "text").collect()}
    for i, text in personal():
        assert (clean[i] == text) if i >= 40 else ("555" not in clean[i] and "callme" not in clean[i] and "[PHONE]" in clean[i])
    assert pii.report(empty(spark)).count() == 0 and pii.sanitise(empty(spark)).count() == 0


def test_disclosure_by_hand(spark):
    """PMI / IC of both scopes recomputed word by word, over copies, secrets and values far from terms."""
    rng = random.Random(11)
    names = ["key", "apikey", "alpha", "beta", "gamma", "delta", "eps", "zeta"]
    rows = []
    for i in range(300):
        words = [rng.choice(names[2:]) for _ in range(rng.randint(0, 30))]
        if i % 6 == 0:
            words[len(words) // 2 : len(words) // 2] = ["apikey", "=", "".join(rng.choice("0123456789abcdef") for _ in range(32)) + "0a1b2c3d"]
        if i % 9 == 0:
            words.insert(0, f"10.0.{i % 256}.7")
            words.append("farlink")
        rows.append((i, " ".join(words)))
    rows += [rows[6], rows[6], rows[9], (500, None), (501, ""), (502, "apikey without a value"), (503, "plain beta " * 20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    reach, least, bits = 3, 5, 25.0
    found, n, total, whole, beside = {}, Counter(), Counter(), Counter(), Counter()
    for _, text in rows:
        text = text or ""
        spans = pii.protected_spans(text)
        assert [s for s in spans if s[0] < 4] == [(pii.KINDS.index(k), int(a), int(b)) for k, a, b in (x.split(":") for x in base_by_pattern(text))]
        inside = {j for _, a, b in spans for j in range(a, b)}
        terms = [(m[0].lower(), m.start(), m.end()) for m in re.finditer(r"[^\W\d_]+", text) if m.start() not in inside]
        plain = re.findall(r"[^\W\d_]+", text.lower())
        whole["near"] += len(plain)
        whole["doc"] += 1
        for w in plain:
            total["near", w] += 1
        for w in set(plain):
            total["doc", w] += 1
        for kind, a, b in spans:
            ctx = [w for w, x, _ in terms if x < a][-reach:] + [w for w, x, _ in terms if x >= b][:reach]
            beside["near", kind] += len(ctx)
            for w in ctx:
                n["near", kind, w] += 1
                found.setdefault(("near", kind, w), set()).add(" ".join(ctx))
        for kind in {k for k, *_ in spans}:
            beside["doc", kind] += 1
            for w in {w for w, *_ in terms}:
                n["doc", kind, w] += 1
                found.setdefault(("doc", kind, w), set()).update(text[a:b] for k, a, b in spans if k == kind)
    want = {}
    for (scope, kind, w), marks in found.items():
        p, q = beside[scope, kind] / whole[scope], n[scope, kind, w] / total[scope, w]
        kl = q * math.log2(q / p) + ((1 - q) * math.log2((1 - q) / (1 - p)) if q < 1 else 0)
        if len(marks) >= least and (scope == "near" or (q > p and total[scope, w] * kl >= bits)):
            want[kind, w] = max(want.get((kind, w), -9), math.log2(q / p) / -math.log2(p))
    scratch = pii.Scratch(spark)
    got = {(r.kind, r.term): r.disclosed for r in pii.disclosures(docs, "text", reach, least, bits, scratch).collect()}
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k]) for k in want)
    assert want[pii.SECRET, "apikey"] > 0.9 and want[pii.KINDS.index("ip"), "farlink"] == pytest.approx(1.0)
    # a term goes wherever it stands in a document with a value of its kind, and nowhere else; more terms than are sent give the same
    few, many = ({r.doc_id: r for r in pii.report(docs, reach=reach, max_sent=m).collect()} for m in (pii.MAX_SENT, 0))
    assert few == many and few[502].n_term == 0 and few[503].spans == ""
    assert few[9].n_ip == 1 and few[9].n_term >= 1 and few[6].n_secret == 1 and few[6].spans.count("secret:") == 1
    a, b = (sorted(map(str, pii.sanitise(docs, reach=reach, max_sent=m).collect())) for m in (pii.MAX_SENT, 0))
    assert a == b and not any("0a1b2c3d" in x for x in a)


def test_secrets_are_opaque_runs():
    spans = lambda t: [t[a:b] for k, a, b in pii.protected_spans(t) if k == pii.SECRET]
    assert spans('token = "04dbebab91ab85687d33eeaaf9ac699e1188f962" x') == ["04dbebab91ab85687d33eeaaf9ac699e1188f962"]
    for text in ("a" * 40, "1234567890" * 4, "internationalisation_of_everything", "user12@host1234567890abcdef12345.com", "ab12" * 10, "x" * 200_000 + "1"):
        assert spans(text) == []


# --- op3


def test_lm_scores(spark, docs):
    rows = corpus()
    df = clashing(docs).drop("held_out").withColumn("held_out", F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 7 == 2)
    got = lm_score.score(df).collect()
    assert len(got) == len(rows)
    counts = Counter()
    fold = lambda i: zlib.crc32(b"" if i is None else str(i).encode()) % 7 == 2
    tokens = lambda t: (t or "").encode().lower().split() + [None]
    for i, t, *_ in rows:
        if not fold(i):
            counts.update(tokens(t))
    total, v = sum(counts.values()), len(counts)
    want = Counter((i, fold(i), len(tokens(t)), sum(counts[w] > 0 for w in tokens(t)), total, round(sum(math.log10((counts[w] + 1) / (total + v + 1)) for w in tokens(t)), 6)) for i, t, *_ in rows)
    assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == want
    assert all(r.score < 0 and math.isfinite(r.score) for r in got)
    assert lm_score.score(empty(spark).withColumn("held_out", F.lit(False))).count() == 0


def test_lm_probabilities_sum_to_one_and_windows_agree():
    rng = np.random.default_rng(0)
    pairs = np.zeros((lm_score.IDS, lm_score.BUCKETS))
    ids = rng.integers(0, 300, 20_000)
    np.add.at(pairs, (ids[1:], lm_score.bucket(ids[:-1]).astype(int)), 1)
    tables, w = lm_score.tables_from_counts(pairs), lm_score.initial()
    w["wv"] += 0.3 * rng.standard_normal(w["wv"].shape).astype(np.float32)
    s = lm_score.Scorer(tables, w)
    past, target = lm_score.blocks(ids[:40])
    assert (target != lm_score.FILL).sum() == 40 and (target[target != lm_score.FILL] == ids[:40]).all()
    every = np.arange(lm_score.IDS - 2)
    total = 0.0
    for part in np.array_split(every, 40):
        p, t = np.repeat(past[None, 1:3], len(part), axis=0), np.full((len(part), 2, lm_score.STRIDE), lm_score.FILL)
        t[:, 0, 5] = part
        total += np.exp(s.log_probabilities(p.reshape(-1, 16), t.reshape(-1, 16))[::2, 5].astype(float)).sum()
    assert total == pytest.approx(1.0, abs=1e-3)
    # what comes later changes no earlier score, nor do other documents before and after
    other = ids[:40].copy()
    other[30:] = 7
    a, b = s.log_probabilities(past, target).ravel()[:30], s.log_probabilities(*lm_score.blocks(other)).ravel()[:30]
    assert np.allclose(a, b)
    among = [lm_score.blocks(x) for x in (ids[100:121], ids[:40], ids[200:203])]
    c = s.log_probabilities(*(np.concatenate(x) for x in zip(*among, strict=True)))
    first = len(among[0][0])
    assert np.allclose(c[first : first + 3].ravel()[:40], s.log_probabilities(past, target).ravel()[:40]) and (c[first - 1] == 0).all()


def test_lm_gradients_match_differences():
    rng = np.random.default_rng(1)
    ids = rng.integers(0, 200, 64)
    pairs = np.zeros((lm_score.IDS, lm_score.BUCKETS))
    np.add.at(pairs, (ids[1:], lm_score.bucket(ids[:-1]).astype(int)), 1)
    tables = lm_score.tables_from_counts(pairs)
    w = {k: (rng.standard_normal(s) * 0.3).astype(np.float64) for k, s in lm_score.SHAPES.items()}
    past, target = lm_score.blocks(ids)
    g = lm_score.gradients(tables, w, past, target)
    near, own = lm_score.bucket(past[1:]).astype(int), target[:-1]

    def loss(w):
        s = lm_score.Scorer(tables, w)
        within = np.log(np.maximum(tables["pairs"][tables["row"][own], near] + tables["share"][own], 1e-30)) - tables["norm"][tables["classes"][own], near]
        return -(s.log_probabilities(past, target).astype(float) - within).mean()

    for k in ("wq", "bq", "wk", "wv", "r", "wd", "b"):
        at = np.unravel_index(np.abs(g[k]).argmax(), g[k].shape)
        up, down = ({n: v.copy() for n, v in w.items()} for _ in range(2))
        up[k][at] += 1e-2
        down[k][at] -= 1e-2
        assert (loss(up) - loss(down)) / 2e-2 == pytest.approx(g[k][at], rel=0.1, abs=2e-4)


def test_lm_exponentials_are_cut_only_where_they_must_be():
    for top in (-3.0, 60.0, 61.0, 500.0):
        x = np.array([[-1e9, -1.5, 0.0], [2.0, 3.0, top]], np.float32)
        want = np.exp(np.minimum(x, np.float32(60)))
        lm_score._exp(x, 60)
        assert (x == want).all() and np.isfinite(x).all()
    lm_score._exp(np.zeros((0, 4), np.float32), 60)


def test_lm_learns_from_every_window():
    rounds = inspect.signature(lm_score.score).parameters["rounds"].default
    rng = np.random.default_rng(3)
    docs = [rng.integers(0, 200, n) for n in (1, 16, 17, 500, 3, 3000, 9000)]
    pairs = np.zeros((lm_score.IDS, lm_score.BUCKETS))
    for ids in docs:
        np.add.at(pairs, (ids[1:], lm_score.bucket(ids[:-1]).astype(int)), 1)
    tables, pack = SimpleNamespace(value=lm_score.tables_from_counts(pairs)), zstandard.ZstdCompressor().compress
    rows = [pa.record_batch({"x": pa.array([pack(ids.astype(np.uint16).tobytes()) for ids in docs], pa.binary())})]
    learned = [next(lm_score._learn(tables, lm_score.initial(), turn, rounds)(rows)) for turn in range(rounds)]
    assert sum(b["n"][0].as_py() for b in learned) == sum(-(-len(ids) // lm_score.STRIDE) for ids in docs)


def test_lm_runs_are_learned_from_without_windows_between_them():
    rng = np.random.default_rng(4)
    docs = [rng.integers(0, 200, n) for n in (1, 16, 17, 700, 32, 300)]
    pairs = np.zeros((lm_score.IDS, lm_score.BUCKETS))
    for ids in docs:
        np.add.at(pairs, (ids[1:], lm_score.bucket(ids[:-1]).astype(int)), 1)
    past, target = lm_score.blocks(np.concatenate(docs), np.array([len(ids) for ids in docs]))
    for got, apart in zip((past, target), zip(*(lm_score.blocks(ids) for ids in docs), strict=True), strict=True):
        assert (got == np.concatenate(apart)).all()
    tables = lm_score.tables_from_counts(pairs)
    w = {k: (rng.standard_normal(s) * 0.3).astype(np.float32) for k, s in lm_score.SHAPES.items()}
    (some_past, some_target), *more = lm_score._mixed_steps(past, target, rng, 0, 1)
    assert not more and some_past.shape == (-(-(len(past) - 1) // lm_score.RUN), lm_score.RUN + 1, lm_score.STRIDE)
    g, n = lm_score.gradients(tables, w, some_past, some_target), [(t[:-1] != lm_score.FILL).sum() for t in some_target]
    assert sum(n) == sum(map(len, docs))
    runs = [lm_score.gradients(tables, w, p, t) for p, t in zip(some_past, some_target, strict=True)]
    for k in lm_score.SHAPES:
        assert np.allclose(g[k], sum(m * r[k] for m, r in zip(n, runs, strict=True)) / sum(n), rtol=1e-3, atol=1e-6)


def lm_words(rng):
    """Texts in which a word tells the next one's kind, so that what came before helps."""
    kinds = [[f"{a}{b}" for b in ("river", "stone", "cloud", "grass")] for a in ("red ", "old ", "big ")]
    return " ".join(rng.choice(kinds[k % 3]) for k in range(rng.randint(5, 80)))


def test_lm_beats_a_unigram_model_of_the_same_ids(spark):
    rng = random.Random(9)
    rows = [(i, lm_words(rng), i % 5 == 0) for i in range(400)]
    got = {r.doc_id: r.score for r in lm_score.score(spark.createDataFrame(rows, "doc_id long, text string, held_out boolean")).collect()}
    with open(lm_score.VOCABULARY, "rb") as f:
        encoder = token_counts.encoding(f.read())
    ids = {i: [x for w in t.split() for x in encoder.encode_ordinary(" " + w)] + [lm_score.END] for i, t, _ in rows}
    counts = Counter(x for i, _, held in rows if not held for x in ids[i])
    total = sum(counts.values()) + len(counts) + 1
    held = [i for i, _, h in rows if h]
    unigram = sum(math.log10((counts[x] + 1) / total) for i in held for x in ids[i])
    assert sum(got[i] for i in held) > unigram * 0.8
    # learning from words, not from their pieces: a text encoded whole gives the same ids
    assert all(ids[i] == encoder.encode_ordinary(" " + t) + [lm_score.END] for i, t, _ in rows[:20])


def test_lm_words_are_encoded_as_if_alone():
    with open(lm_score.VOCABULARY, "rb") as f:
        encoder = token_counts.encoding(f.read())
    opens = np.zeros(lm_score.END + 1, bool)
    opens[[i for i in range(lm_score.END) if encoder.decode_single_token_bytes(i)[:1] == b" "]] = True
    for words in (["plain", "don't", "a\u00a0b", "\u2003", "12,5", "\u00e9t\u00e9", "<|endoftext|>", "x" * 300], ["plain", "don't", "12,5", "'s", "__"]):
        ids, n = lm_score.encoded(encoder, opens, words)
        alone = [encoder.encode_ordinary(" " + w) for w in words]
        assert n.tolist() == [len(x) for x in alone] and ids.tolist() == [y for x in alone for y in x]
    counts, words = lm_score.words_of(pa.array(["  A b\tC\u00a0\u00c4 ", None, "", "\x0b\x0cz\n\n", "\x1cq \x1f"]))
    assert counts.tolist() == [3, 0, 0, 1, 2] and words.to_pylist() == ["a", "b", "c\u00a0\u00c4", "z", "\x1cq", "\x1f"]


# --- op4


def hits_by_hand(text, items, window=10):
    words = [w.lower() for w in re.findall(rb"[0-9A-Za-z\x80-\xff]+", (text or "").encode())]
    hit, found = set(), set()
    for item, body in items:
        w = [x.lower() for x in re.findall(rb"[0-9A-Za-z\x80-\xff]+", (body or "").encode())]
        k = min(window, len(w))
        for j in range(len(w) - k + 1 if k else 0):
            for i in range(len(words) - k + 1):
                if words[i : i + k] == w[j : j + k]:
                    hit.update(range(i, i + k))
                    found.add(item)
    return len(words), len(hit), found


def test_decontamination_against_brute_force(spark):
    rng = random.Random(2)
    vocab = ["a", "b", "ab", "É", "c"]
    items = [(i, " ".join(rng.choice(vocab) for _ in range(rng.choice([0, 2, 3, 9, 12, 20])))) for i in range(12)] + [(50, None), (51, "c c c"), (3, "b b ab")]
    rows = [(i, " ".join(rng.choice(vocab) for _ in range(rng.choice([0, 3, 30, 60])))) for i in range(40)] + [(100, None), (101, ""), (102, items[5][1]), (5, "x " + (items[4][1] or "") + " y")]
    df, bench = spark.createDataFrame(rows, "doc_id long, text string").repartition(2), spark.createDataFrame(items, "item_id long, text string")
    want = Counter()
    for i, t in rows:
        n, h, f = hits_by_hand(t, items)
        want[i, n, h, len(f), hashlib.sha256(",".join(sorted(map(str, f))).encode()).hexdigest(), h > 0] += 1
    for shard in (decontaminate.SHARD_WORDS, 15):
        found = decontaminate.benchmark_hits(clashing(df).drop("n_words", "spans", "items"), bench, shard_words=shard).select("doc_id", "n_words", "spans", "items").collect()
        got = Counter((r.doc_id, r.n_words, sum(s.end - s.start for s in r.spans), len(r["items"]), hashlib.sha256(",".join(sorted(map(str, r["items"]))).encode()).hexdigest(), bool(r.spans)) for r in found)
        assert got == want
    assert Counter(map(tuple, decontaminate.report(clashing(df), clashing(bench)).collect())) == want
    assert decontaminate.report(df, bench.where("false")).where("contaminated").count() == 0
    assert decontaminate.report(df.where("false"), bench).count() == 0


def test_decontamination_takes_any_ids_and_long_texts(spark):
    rng = random.Random(4)
    items = [("b", "one two three four five six seven eight nine ten eleven"), ("a", "three words only"), (None, "no id here")]
    long = " ".join(word(rng) for _ in range(50_000))
    rows = [("x1", long + " " + items[0][1]), ("x2", "well Three WORDS only, no id here"), (None, "three words only"), ("x2", "clean")]
    df, bench = spark.createDataFrame(rows, "doc_id string, text string"), spark.createDataFrame(items, "item_id string, text string")
    for shard in (decontaminate.SHARD_WORDS, 4):
        found = decontaminate.benchmark_hits(df, bench, shard_words=shard).collect()
        got = sorted((str(r.doc_id), r.n_words, sum(x.end - x.start for x in r.spans), tuple(map(str, r["items"]))) for r in found)
        assert got == sorted([("x1", 50_011, 11, ("b",)), ("x2", 7, 6, ("a", "None")), ("None", 3, 3, ("a",)), ("x2", 1, 0, ())])


def test_decontaminate_cuts_runs(spark):
    passage = " ".join(f"w{i}" for i in range(12))
    rows = [(1, f"Keep this part, {passage}; and that part too with a good many words more than the passage itself has got, see."), (2, passage), (3, None), (4, "Clean,  text.")]
    out = clashing(spark.createDataFrame(rows, "doc_id long, text string"))
    got = {r.doc_id: r.text for r in decontaminate.decontaminate(out, spark.createDataFrame([(1, passage)], "item_id long, text string")).collect()}
    assert got == {1: "Keep this part, ; and that part too with a good many words more than the passage itself has got, see.".replace(", ;", ", ;"), 3: None, 4: "Clean,  text."}


# --- op5


def test_toxicity_separates_and_ignores_held_out_labels(spark):
    rng = random.Random(4)
    rows, labels = [], []
    for i in range(900):
        toxic = i % 4 == 0
        words = [word(rng) for _ in range(40)]
        if toxic:
            words[rng.randrange(40)] = rng.choice(["grolk", "snarf", "bleeb"]) + rng.choice(["", "en", "ung"])
            words[3] = "you"
        rows.append((i, " ".join(words)))
        labels.append((i, 1, int(toxic)))
    rows += [(2000, None), (2001, ""), (2001, "")]
    labels += [(5, 1, None), (None, 1, 1)]
    df, marks = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    learn = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 != 1
    out = toxicity.score(df, toxicity.train(df, marks, learn)).collect()
    assert len(out) == len(rows) and all(0 <= r.score <= 1 for r in out)
    held = [r for r in out if r.doc_id < 900 and zlib.crc32(str(r.doc_id).encode()) % 3 == 1]
    assert sum((r.score >= 0.7) == (r.doc_id % 4 == 0) for r in held) / len(held) > 0.95
    flipped = marks.withColumn("toxic", F.when(learn, F.col("toxic")).otherwise(1 - F.col("toxic")))
    again = toxicity.score(df, toxicity.train(df, flipped, learn)).collect()
    assert sorted(map(str, again)) == sorted(map(str, out))
    none = toxicity.score(df, toxicity.train(df, marks.where("false"), learn)).collect()
    assert {r.score for r in none} == {0.0}
    assert toxicity.score(df.where("false"), toxicity.train(df, marks, learn)).count() == 0


def features_by_hand(text, whole, begin):
    words = re.findall(r"[^\W\d_]+", text.lower())
    n = max(len(words), 1)
    hits, stems = [whole[w] for w in words if w in whole], [begin[w[:5]] for w in words if w[:5] in begin]
    places = [i for i, w in enumerate(words) if w in whole or w[:5] in begin]
    you = [i for i, w in enumerate(words) if w in toxicity.SECOND_PERSON]
    gaps = [min(abs(i - j) for j in you) for i in places] if you else []
    odd = re.findall(r"[^\W\d_]+[0-9@$!*+]+[^\W_][\w@$!*+]*", text)
    plain = [w.lower().translate(toxicity.LEET) for w in odd]
    size = len(text)
    ascii_marks = [c for c in text if c in "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"]
    return [
        len(hits) / n, math.log1p(len(hits)), sum(hits) / n, max(hits, default=0), len(stems) / n, math.log1p(len(stems)), sum(stems) / n, max(stems, default=0),
        sum(g <= 5 for g in gaps) / n, 1 / (1 + min(gaps)) if gaps else 0, len(you) / n, sum("A" <= c <= "Z" for c in text) / size,
        len(re.findall(r"\b[A-Z]{3,}\b", text)) / n, text.count("!") / size, text.count("?") / size, len(ascii_marks) / size, sum("0" <= c <= "9" for c in text) / size,
        len(odd) / n, math.log1p(sum(w in whole or w[:5] in begin for w in plain)), math.log1p(len(words)), sum(map(len, words)) / n,
    ]


def test_toxicity_features_by_hand():
    rng = random.Random(12)
    whole, begin = {"grolk": 2.5, "bad": 1.7}, {"snarf": 3.0, "grolk": 2.0}
    pieces = ["you", "GROLK", "gr0lk", "b@d!", "snarfing", "snarf", "Du", "été", "12", "?!", "STOP", "ok", "a_b", "grolkish", "...", "ÉTÉ", "x1y"]
    for _ in range(400):
        text = " ".join(rng.choice(pieces) for _ in range(rng.randint(1, 25)))
        assert toxicity.features(text, (whole, begin)) == pytest.approx(features_by_hand(text, whole, begin), abs=1e-9), text
    long = " ".join(rng.choice(pieces) for _ in range(50_000))
    assert toxicity.features(long, (whole, begin))[:8] == pytest.approx(features_by_hand(long, whole, begin)[:8])
    assert toxicity.features("", (whole, begin)) == [0.0] * len(toxicity.FEATURES)


def test_toxicity_lexicon_and_odd_tables(spark):
    rng = random.Random(13)
    rows = [(i, " ".join(rng.choice(["grolken", "zap"] if i % 3 == 0 and rng.random() < 0.3 else ["plain", "words", "only", word(rng)]) for _ in range(20))) for i in range(300)]
    labels = [(i, int(i % 3 == 0)) for i in range(300)]
    docs = spark.createDataFrame([*rows, (4, "a lesser text"), (5, None)], "doc_id long, text string").withColumn("score", F.lit(5)).withColumn("toxic", F.lit("x"))
    model = toxicity.train(docs, spark.createDataFrame(labels, "doc_id long, toxic int"), F.lit(True))
    half = {r.doc_id: r.h for r in docs.select("doc_id", F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(2)).alias("h")).distinct().collect()}
    texts = dict(rows) | {4: min(rows[4][1], "a lesser text"), 5: ""}
    counts, n = Counter(), Counter()
    for i, toxic in labels:
        if half[i] == 0:
            n[toxic] += 1
            for term in toxicity.lexicon_terms(texts[i]):
                counts[toxic, *term] += 1
    want = ({}, {})
    for (toxic, begin, term), k in counts.items():
        if toxic and k >= max(4, 0.004 * n[1]):
            weight = math.log((k + 0.5) / (n[1] + 1)) - math.log((counts[0, begin, term] + 0.5) / (n[0] + 1))
            if weight > 1.5:
                want[begin][term] = pytest.approx(weight)
    assert model["lexicon"] == want and want[0] and want[1]
    out = toxicity.score(docs, model)
    assert out.columns == ["doc_id", "text", "toxic", "score"] and out.count() == 302 and all(0 <= r.score <= 1 for r in out.collect())


def test_a_tree_takes_the_best_split():
    rng = np.random.default_rng(5)
    x, y = np.round(rng.normal(size=(200, 3)), 1), (rng.random(200) < 0.4).astype(float)
    y[x[:, 1] > 0.4] = 1
    t = toxicity.Trees(trees=1, depth=1).fit(x, y)
    p = y.mean()
    best = (0, None, None)
    for f in range(3):
        for edge in np.unique(np.quantile(x[:, f], np.linspace(0, 1, 65)[1:-1])):
            left = x[:, f] <= edge
            parts = [(s, (p - y[s]).sum(), p * (1 - p) * s.sum()) for s in (left, ~left)]
            if min(h for _, _, h in parts) >= 1:
                gain = sum(g * g / (h + 1) for _, g, h in parts)
                if gain > best[0] + 1e-12:
                    best = (gain, f, edge)
    assert (t.found[0][0][0], t.found[0][1][0]) == best[1:]
    left = x[:, best[1]] <= best[2]
    want = np.where(left, *[math.log(p / (1 - p)) - 0.15 * (p - y[s]).sum() / (p * (1 - p) * s.sum() + 1) for s in (left, ~left)])
    assert np.allclose(t.margin(x), want)


def test_isotonic_is_monotone_and_pools():
    x, y = np.array([0.0, 1, 2, 3, 3, 4]), np.array([0.0, 1, 0, 1, 0, 1])
    knots, values = toxicity.isotonic(x, y)
    assert (np.diff(values) >= 0).all() and (np.diff(knots) >= 0).all()
    assert np.interp([0, 1.5, 4], knots, values).tolist() == [0.0, 0.5, 1.0]


# --- op6


def test_token_counts(spark, docs):
    encode = token_counts.encoding(open(token_counts.VOCABULARY, "rb").read()).encode_ordinary
    lengths = [len(encode(t or "")) for _, t, *_ in corpus()]
    table = token_counts.limits(token_counts.length_histogram(clashing(docs)))
    assert {r.context_limit for r in table.collect()} == set(lengths) | set(token_counts.LIMITS)
    for r in table.collect():
        n = r.context_limit
        assert (r.docs, r.docs_at_least, r.tokens_at_least) == (lengths.count(n), sum(x >= n for x in lengths), sum(x for x in lengths if x >= n))
        assert (r.total_docs, r.total_tokens, r.truncated_total) == (len(lengths), sum(lengths), sum(min(x, n) for x in lengths))
        assert r.share_that_fits == pytest.approx(sum(x <= n for x in lengths) / len(lengths))
    for limit in (0, 1, 77, 10**6):
        assert token_counts.truncated_total(table, limit).first()[0] == sum(min(x, limit) for x in lengths)
    assert token_counts.quantile(table, 0.5).first()[0] == sorted(lengths)[math.ceil(len(lengths) / 2) - 1]
    assert token_counts.limits(token_counts.length_histogram(empty(spark))).count() == 0


# --- op7


def test_top_k_against_brute_force(spark):
    rng = np.random.default_rng(0)
    vectors = [(i, [float(x) for x in rng.choice([-0.5, -0.1, 0.0, 0.02, 0.3], 6)]) for i in range(150)]
    vectors += [(200, None), (201, [0.1, None, 0.2, 0.1, 0.1, 0.1]), (202, [float("nan")] * 6), (203, [float("inf")] + [0.0] * 5), (204, []), (None, [0.1] * 6), (220, [0.3] * 6), (240, [0.3] * 5)]
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<float>").repartition(3)
    good = {i: [math.floor(64 * float(np.float32(x))) for x in v] for i, v in vectors if i is not None and v and all(x is not None and math.isfinite(x) for x in v)}
    want = set()
    for q, v in good.items():
        if q % 20 == 0:
            best = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in good.items() if i != q and len(w) == len(v))[:20]
            want |= {(q, r + 1, i, -s) for r, (s, i) in enumerate(best)}
    for block, group in ((65_536, 128), (40, 3)):
        got = bitsliced_topk.exact_top_k(clashing(df), F.col("vec_id") % 20 == 0, block_rows=block, query_group=group)
        assert {tuple(r) for r in got.collect()} == want
    assert bitsliced_topk.exact_top_k(df.where("false"), F.col("vec_id") % 20 == 0).count() == 0


# --- op8


def links_by_hand(rows, length, percent):
    sets = {}
    for i, t, *_ in rows:
        w = (t or "").encode().lower().split()
        sets[i] = {tuple(w[k : k + length]) for k in range(max(1, len(w) - length + 1))} if w else set()
    parent = {i: i for i in sets}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b]:
                both = len(sets[a] & sets[b])
                if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                    x, y = find(a), find(b)
                    parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in sets}


def families(seed=0):
    rng = random.Random(seed)
    rows = []
    for f in range(6):
        base = [word(rng) + str(rng.randrange(50)) for _ in range(rng.choice([4, 12, 30, 120]))]
        for _ in range(rng.choice([3, 10, 60])):
            copy = list(base)
            for _ in range(rng.randint(0, 3)):
                copy[rng.randrange(len(copy))] = word(rng)
            rows.append((len(rows), " ".join(copy)))
            if rng.random() < 0.2:
                base = copy
    return rows + [(len(rows) + k, t) for k, t in enumerate([None, "", "  \n", "one", "ONE", "one two", "one  two", "A b c", "a B c"])]


@pytest.mark.parametrize(("length", "percent", "block"), [(3, 90, 256), (3, 90, 4), (5, 80, 256), (5, 80, 7), (2, 50, 5)])
def test_jaccard_join_against_brute_force(spark, length, percent, block):
    rows = families(percent + block)
    df = clashing(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.near_duplicates(df, length, percent, block_docs=block).collect()}
    assert got == links_by_hand(rows, length, percent)


@pytest.mark.parametrize(("length", "percent", "own"), [(3, 90, 4), (5, 80, 4)])
def test_jaccard_join_cells_stay_small_without_a_main_component(spark, monkeypatch, length, percent, own):
    # pairs of one template: each pair links, no two pairs do, and all are one candidate group
    rng = random.Random(length)
    base = [f"t{i}" for i in range(160)]
    rows = []
    for k in range(100):
        words = list(base)
        for at in rng.sample(range(0, 160, 8), own):
            words[at] = f"own{k}-{at}"
        rows += [(2 * k, " ".join(words)), (2 * k + 1, " ".join([*words[:-1], f"end{k}"]))]
    block, search = 8, jaccard_join._search

    def watched(length, percent):
        run = search(length, percent)

        def checked(parts):
            cells = Counter()
            for batch in parts:
                cells.update(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()))
                yield from run(iter([batch]))
            if cells:
                assert max(cells.values()) <= 8 * block, max(cells.values())

        return checked

    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    want = {(r.doc_id, r.component_id) for r in jaccard_join.near_duplicates(df, length, percent).collect()}
    assert len({c for _, c in want}) > 1
    monkeypatch.setattr(jaccard_join, "_search", watched)
    assert {(r.doc_id, r.component_id) for r in jaccard_join.near_duplicates(df, length, percent, block_docs=block).collect()} == want


def test_jaccard_join_reads_long_texts_whole(spark):
    rng = random.Random(6)
    base = [word(rng) + str(rng.randrange(1000)) for _ in range(60_000)]
    near, far = list(base), list(base)
    for at in rng.sample(range(60_000), 500):
        near[at] = "other"
    for at in rng.sample(range(60_000), 5000):
        far[at] = "other"
    rows = [(5, " ".join(base)), (2, " ".join(near)), (1, " ".join(far)), (9, " ".join(base[:30_000]))]
    got = {r.doc_id: r.component_id for r in jaccard_join.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 3, 90).collect()}
    assert got == {i: c for i, (_, c) in links_by_hand(rows, 3, 90).items()} == {5: 2, 2: 2, 1: 1, 9: 9}


def test_deduplicated_keeps_one_row_of_an_id(spark):
    text = "one two three four five six seven eight nine ten"
    rows = [(3, "zz " + text, "a"), (3, text, "b"), (3, None, "c"), (4, text, "d"), (None, text, "e"), (None, text, "f"), (7, "alone here", "g"), (8, None, "h"), (8, None, "i")]
    df = clashing(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    got = [sorted(map(tuple, jaccard_join.deduplicated(df.repartition(n)).select("doc_id", "text", "lang").collect()), key=str) for n in (1, 4)]
    assert got[0] == got[1] and len(got[0]) == 5
    assert {r for r in got[0] if r[0] != 8} == {(3, text, "b"), (None, text, "e"), (None, text, "f"), (7, "alone here", "g")}


def test_jaccard_join_edges(spark):
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (None, "a b c d e f"), (2, "a b c d e f"), (3, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(map(tuple, jaccard_join.near_duplicates(df, 3, 90).collect()), key=str) == sorted([(1, 4, 1), (1, 4, 1), (None, 4, None), (2, 4, 1), (3, 0, 3)], key=str)
    assert sorted((r.doc_id for r in jaccard_join.deduplicated(df).collect()), key=str) == [1, 3, None]
    assert jaccard_join.near_duplicates(df.where("false")).count() == 0


def test_t_occurrence_is_exact():
    rng = random.Random(1)
    for _ in range(300):
        lists = [sorted(rng.sample(range(40), rng.randint(1, 40))) for _ in range(rng.randint(1, 30))]
        t = rng.randint(1, len(lists))
        counts = Counter(x for one in lists for x in one)
        assert sorted(jaccard_join.t_occurrence(lists, t)) == sorted((d, c) for d, c in counts.items() if c >= t)


# --- op9


def test_source_mix(spark, docs):
    rows = corpus()
    size = [len(re.findall(r"[^\x20\x09-\x0D]+", t or "", re.ASCII)) for _, t, *_ in rows]
    per = Counter()
    for r, n in zip(rows, size):
        per[r[3]] += n
    names = sorted(per, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    target, left, open_ = {}, float(sum(size)), set(names)
    while open_:
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = [s for s in open_ if share[s] > 3 * per[s]]
        if not over:
            target |= share
            break
        for s in over:
            target[s] = 3.0 * per[s]
            left -= target[s]
            open_.discard(s)
    for kwargs in ({}, {"bucket_docs": 5, "block_words": 8}):
        mix = source_mix.Mix(clashing(docs).drop("size"), **kwargs)
        got = mix.report().collect()
        assert sorted((r.doc_id, r.size) for r in got if r.doc_id is not None) == sorted((r[0], n) for r, n in zip(rows, size) if r[0] is not None)
        assert all(r.taken <= 3 * r.size for r in got)
        taken = Counter()
        for r in got:
            s = next(x for x in names if per[x] == r.source_size)
            assert r.target == pytest.approx(target[s])
            taken[s] += r.taken
        assert all(abs(taken[s] - target[s]) <= 64 + 0.02 * target[s] for s in names)
        assert sorted(map(str, source_mix.Mix(docs.repartition(2), **kwargs).report().collect())) == sorted(map(str, got))
        assert mix.output().agg(F.sum("words")).first()[0] == sum(taken.values())
        # slots are what was drawn: so many of each source in each shard, numbered without gaps
        drawn = {(r.place, r.shard): (r.n, r.first) for r in mix.shard_counts().collect()}
        slots = mix.slots().collect()
        assert Counter((r.place, r.shard) for r in slots) == {k: n for k, (n, _) in drawn.items()}
        assert all(drawn[r.place, r.shard][1] <= r.slot < sum(drawn[r.place, r.shard]) for r in slots)
        quota = {r.place: r.slots for r in mix.quota.collect()}
        assert all(sorted(r.slot for r in slots if r.place == p) == list(range(n)) for p, n in quota.items())
    assert source_mix.Mix(empty(spark)).report().count() == 0


def test_source_mix_draws_shards_alike(spark):
    df = spark.range(3000).select(F.col("id").alias("doc_id"), F.repeat(F.lit("w "), 200).alias("text"), (F.col("id") % 3).cast("string").alias("source"))
    mix = source_mix.Mix(df, block_words=8, shard_slots=1000)
    counts, total = {(r.place, r.shard): r.n for r in mix.shard_counts().collect()}, mix.quota.agg(F.sum("slots")).first()[0]
    shards = -(-total // 1000)
    for r in mix.quota.collect():  # a multinomial draw of its slots over the shards: means and spread
        own = np.array([counts.get((r.place, h), 0) for h in range(shards)])
        mean, sd = r.slots / shards, math.sqrt(r.slots / shards * (1 - 1 / shards))
        assert own.sum() == r.slots and np.abs(own - mean).max() < 5 * sd and 0.6 * sd < own.std() < 1.4 * sd
    # bands of shards number slots as one running sum would
    before = source_mix.BAND_SHARDS
    try:
        source_mix.BAND_SHARDS, mix.drawn = 7, None
        assert sorted(map(tuple, mix.shard_counts().select("place", "shard", "n", "first").collect())) == sorted((p, h, n, sum(counts.get((p, j), 0) for j in range(h))) for (p, h), n in counts.items())
    finally:
        source_mix.BAND_SHARDS = before


def test_mixed_texts_are_the_words_taken(spark, docs):
    mix = source_mix.Mix(docs, block_words=8, with_text=True)
    pieces = mix.mixed_texts().collect()
    words = {r[0]: (r[1] or "").split() for r in corpus() if r[0] is not None}
    assert all(p.text.split() == words[p.doc_id][p.first_word : p.first_word + len(p.text.split())] and p.text for p in pieces if p.doc_id is not None)
    taken = Counter()
    for p in pieces:
        taken[p.doc_id] += len(p.text.split())
    want = Counter()
    for r in mix.report().collect():
        want[r.doc_id] += r.taken
    assert taken == +want and max(Counter((p.source, p.slot) for p in pieces).values()) <= 8
    assert source_mix.Mix(empty(spark), with_text=True).mixed_texts().count() == 0


def test_permutation_is_a_bijection(spark):
    for n in (1, 2, 7, 1000):
        df = spark.range(n).select(F.col("id").alias("i"), F.lit(n).cast("long").alias("m"), F.lit(3).cast("long").alias("k"))
        assert sorted(r.o for r in source_mix.permuted(df, "i", "m", ["k"], 1, "o").collect()) == list(range(n))


# --- op10


def test_language_vectors_against_plain_grams(spark):
    rng = random.Random(6)
    rows = [(i, " ".join(rng.choice(["ab", "cd", "ef"] if i % 2 else ["xy", "zw", "uv"]) * rng.randint(1, 2) for _ in range(20)), "b" if i % 2 else "z", "s", 1) for i in range(40)]
    rows += [(100, None, "b", "s", 0), (101, "12 3!", "b", "s", 0), (102, "abab xyq", None, "s", 0), (103, "qqq", None, "s", 0), (104, "", None, None, None)]
    df = spark.createDataFrame(rows, SCHEMA)
    model = language_id.train(df)
    totals = Counter()
    grams = Counter()
    for _, t, lang, *_ in rows:
        for w in language_id.letter_words(t or "") if lang else []:
            for n in range(1, 5):
                p = f" {w} "
                for g in ([c for c in w] if n == 1 else [p[i : i + n] for i in range(len(p) - n + 1)]):
                    grams[lang, n, g] += 1
                    totals[lang, n] += 1
    lack = math.log10(2e-5) - 1

    def by_hand(w):
        for n in range(4, 0, -1):
            p = f" {w} "
            known = [g for g in ([c for c in w] if n == 1 else [p[i : i + n] for i in range(len(p) - n + 1)]) if any(grams[x, n, g] for x in "bz")]
            if known:
                return [np.mean([math.log10(grams[x, n, g] / totals[x, n]) if grams[x, n, g] else lack for g in known]) for x in "bz"]
        return [math.nan] * 2

    words = ["abcd", "xyuvq", "q", "efab", "a"]
    assert np.allclose(language_id.word_vectors(model, words), [by_hand(w) for w in words], equal_nan=True)
    got = {r.doc_id: (r.lang_pred, r.score) for r in language_id.predict(clashing(df).drop("lang_pred", "score"), model).collect()}
    assert all(got[i][0] == ("b" if i % 2 else "z") for i in range(40))
    assert got[100] == got[101] == got[104] == ("und", 0.0) and 0 <= got[102][1] <= 1
    nothing = language_id.identify(df.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {(r.lang_pred, r.score) for r in nothing} == {("und", 0.0)}
    assert language_id.identify(empty(spark)).count() == 0


def test_language_id_on_held_out_documents(spark, small):
    got = Q.op10_language_id(spark, small).join(spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "lang"), "doc_id").where("held_out")
    right, n = got.agg(F.sum((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert right / n > 0.97


def test_language_id_ties_and_repeated_rows(spark):
    rows = [(1, "aa bb", "z", "s", 1), (2, "aa cc", "b", "s", 1), (2, "aa cc", "b", "s", 1), (3, "aa", None, "s", 1), (4, "aa " * 30_000 + "cc", None, "s", 1), (5, "cc", None, "s", 1)]
    df = spark.createDataFrame(rows, SCHEMA)
    model = language_id.train(df)
    by_hand = {"b": {"aa": 2 / 4, "cc": 2 / 4}, "z": {"aa": 1 / 2, "bb": 1 / 2}}  # a repeated row counts each time
    got = dict(zip(["aa", "cc"], language_id.word_vectors(model, ["aa", "cc"])))
    assert got["aa"] == pytest.approx([math.log10(by_hand[x]["aa"]) for x in "bz"])
    out = {(r.doc_id, r.lang_pred, round(r.score, 9)) for r in language_id.predict(df, model).collect()}
    assert (3, "b", 0.5) in out  # equal scores: the language that sorts first
    assert len([1 for r in language_id.predict(df, model).collect() if r.doc_id == 2]) == 2
    assert {x[1] for x in out if x[0] in (4, 5)} == {"b"}
