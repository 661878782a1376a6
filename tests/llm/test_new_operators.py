"""Vector codes, periodic runs and byte-level BPE against brute force, and their edge cases."""

import hashlib
import random
import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.test_llm_operators import clashing, corpus
from tidemark.llm import byte_bpe, jaccard_join, periodic_runs, vector_codes
from tidemark.llm import queries as Q

# --- op11


def codes_by_hand(rows, entries, rounds=4, parts=4):
    kept = sorted([(i, x) for i, x, _ in rows], key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    size = len(kept[0][1]) // parts
    cut = lambda x: [x[k * size : (k + 1) * size] for k in range(parts)]
    books = [[list(cut(x)[k]) for _, x in kept[:entries]] for k in range(parts)]

    def nearest(part, book):
        return min((sum((a - b) ** 2 for a, b in zip(part, e)), j) for j, e in enumerate(book))

    for _ in range(rounds):
        for k in range(parts):
            mine = {}
            for _, x in kept:
                mine.setdefault(nearest(cut(x)[k], books[k])[1], []).append(cut(x)[k])
            books[k] = [[sum(c) // len(mine[j]) for c in zip(*mine[j])] if j in mine else e for j, e in enumerate(books[k])]
    out, total = [], {}
    for i, x, label in rows:
        found = [nearest(p, books[k]) for k, p in enumerate(cut(x))]
        error = sum(d for d, _ in found)
        out.append((i, "".join(f"{j:02x}" for _, j in found), error, label))
        total[label] = total.get(label, 0) + error
    sha = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    return sorted([(i, code, e, total[label], sha) for i, code, e, label in out], key=str)


def vectors(seed, n, width=8):
    r = np.random.default_rng(seed)
    rows = [(i, [float(v) for v in r.normal(size=width) / 4], int(r.integers(3)) if i % 5 else None) for i in range(n)]
    return rows + [(n, rows[3][1], 1), (3, rows[4][1], 2), (3, rows[4][1], 2), (None, rows[2][1], None)]


@pytest.mark.parametrize(("n", "entries", "cell_bits", "memo"), [(60, 16, 6, 1 << 15), (60, 16, 3, 4), (5, 256, 9, 1), (40, 7, 12, 2)])
def test_vector_codes_against_brute_force(spark, n, entries, cell_bits, memo):
    rows = vectors(n, n)
    odd = [(900, None, 1), (901, [], 1), (902, [float("nan")] * 8, 1), (903, [1.0] * 7 + [None], 1), (904, [float("inf")] * 8, 1), (905, [0.5] * 12, 1), (906, [1e9] * 8, 1)]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>, label int").repartition(3)
    for name in ("code", "error", "v", "part", "entry", "of"):
        df = df.withColumn(name, F.lit(7))
    got = vector_codes.Codebooks(df, entries=entries, cell_bits=cell_bits, memo_cells=memo)
    ints = [(i, [int(np.floor(1024 * v)) for v in x], label) for i, x, label in rows]
    assert sorted(map(tuple, got.report().collect()), key=str) == codes_by_hand(ints, entries)
    codes = got.codes()
    decoded = {tuple(r) for r in codes.select("vec_id", "error").collect()}
    back = got.decoded(codes.where("vec_id = 0")).first().vector
    assert sum((a - b) ** 2 for a, b in zip(back, ints[0][1])) in {e for i, e in decoded if i == 0}


def test_vector_codes_of_a_hot_label_and_an_empty_table(spark, monkeypatch):
    df = spark.createDataFrame(vectors(2, 50), "vec_id long, embedding array<double>, label int")
    few = sorted(map(tuple, vector_codes.Codebooks(df).report().collect()), key=str)
    monkeypatch.setattr(vector_codes, "SENT_LABELS", 0)
    assert sorted(map(tuple, vector_codes.Codebooks(df).report().collect()), key=str) == few
    assert vector_codes.Codebooks(df.where("false")).report().count() == 0


def test_memoised_cells_are_exact_and_met_again():
    r = np.random.default_rng(5)
    book = r.integers(-300, 300, (64, 4))
    book[9] = book[4]  # a tie
    x = np.concatenate([r.integers(-300, 300, (500, 4)), book])
    for bits in (2, 5, 7, 10):
        grid = vector_codes.Grid(book, bits)
        for _ in range(2):
            entry, distance = grid.nearest(x)
            d = ((x[:, None] - book[None]) ** 2).sum(axis=2)
            assert (entry == d.argmin(axis=1)).all() and (distance == d.min(axis=1)).all()
        assert grid.worked <= len(x) and (bits > 7 or grid.evaluated < grid.asked * 60)


# --- op12


def runs_by_hand(w, length=24, periods=3):
    found = {}
    for p in range(1, len(w)):
        i = 0
        while i + p < len(w):
            start = i
            while i + p < len(w) and w[i] == w[i + p]:
                i += 1
            n = i - start + p
            if i > start and n >= max(length, periods * p):
                found.setdefault((start, n), p)
            i += i == start
    return sorted(((s, n, p) for (s, n), p in found.items()), key=lambda r: (r[0], r[2]))


def test_runs_against_brute_force():
    rng, seen = random.Random(3), 0
    for _ in range(3000):
        w, k = [], rng.choice([1, 2, 3, 4])
        while len(w) < rng.randint(0, 110):
            w += ([rng.randrange(k) for _ in range(rng.randint(1, 9))] * 12)[: rng.randint(1, 60)]
        for length, periods in ((24, 3), (rng.choice([4, 9]), rng.choice([3, 4]))):
            want = runs_by_hand(w, length, periods)
            seen += len(want)
            assert periodic_runs.runs(w, length, periods) == want
        if runs_by_hand(w):
            assert periodic_runs.may_repeat([[b"x"], [str(x).encode() for x in w]], periodic_runs.least_agreement())[1]
    assert seen > 3000
    with pytest.raises(ValueError):
        periodic_runs._documents(None, "", "", "", None, 24, 2)


def test_long_texts_of_one_word_and_of_one_passage():
    assert periodic_runs.runs([7] * 50_000) == [(0, 50_000, 1)]
    passage = list(range(40))
    words = [w for i in range(1500) for w in (*passage, 1000 + i)]
    assert periodic_runs.runs(words) == []


def op12_by_hand(rows):
    out = []
    for doc_id, text in rows:
        words = (text or "").encode().split()
        h = zlib.crc32(b"" if doc_id is None else str(doc_id).encode())
        n, g = len(words), h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        found = runs_by_hand(words)
        top = max(found, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=(None, None, None))
        dropped = {i for s, m, p in found for i in range(s + p, s + m)}
        lines = "".join(f"{s},{m},{p}\n" for s, m, p in found).encode()
        kept = b" ".join(w for i, w in enumerate(words) if i not in dropped)
        milli = None if top[0] is None else 1000 * top[1] // top[2]
        out.append((doc_id, len(found), *top, milli, hashlib.sha256(lines).hexdigest(), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def test_op12_query_against_brute_force(spark, tmp_path):
    rng = random.Random(8)
    rows = [(i, " ".join(rng.choice("ab cd ef gh ij kl".split()) for _ in range(rng.choice([0, 1, 30, 90, 300])))) for i in range(150)]
    rows += [(500, None), (501, ""), (502, " \t\n"), (503, "Word " * 4000), (503, "a b c " * 30), (None, "x y " * 40), (504, "Aa aA " * 15 + " b " * 30)]
    df = clashing(spark.createDataFrame(rows, "doc_id long, text string"))
    df.write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(map(tuple, Q.op12_periodic_runs(spark, str(tmp_path)).collect()), key=str)
    assert got == op12_by_hand(rows) and sum(r[1] > 0 for r in got) > 10
    pieces = periodic_runs.find(df.select("doc_id", "text").where("doc_id = 503")).collect()
    assert sorted((r.start, r.length, r.period) for r in pieces) == [(0, 90, 3), (0, 4000, 1)]
    assert {r.text for r in periodic_runs.collapse(df.where("doc_id = 503")).collect()} == {"Word", "a b c"}
    assert periodic_runs.report(df.where("false")).count() == 0


# --- op13


@pytest.fixture(scope="module")
def tiktoken_encoding():
    from tidemark.llm import token_counts

    with open(byte_bpe.VOCABULARY, "rb") as f:
        raw = f.read()
    return raw, token_counts.encoding(raw)


LETTERS = "aaaabbc eeett  inng'sre ré 12\n\t.,-=é漢 𝔘 "


def test_bpe_equals_the_public_library(tiktoken_encoding):
    raw, theirs = tiktoken_encoding
    mine, rng = byte_bpe.Encoder(raw), random.Random(1)
    texts = ["".join(rng.choice(LETTERS) for _ in range(rng.randint(0, 60))) for _ in range(3000)]
    texts += ["".join(rng.choice("abcdeintrs") for _ in range(rng.randint(100, 1500))) for _ in range(60)]
    texts += [c * k for c in ("a", " ", "=", "-", "ah", "\x00", "—", "\n ") for k in (1, 5, 63, 64, 65, 127, 129, 1000)]
    texts += ["'s don't 'RE we're x'll", "<|endoftext|>", "ab" * 20_000 + "=" * 20_000]
    for text in texts:
        assert mine.ids(text) == theirs.encode_ordinary(text), text
        assert mine.decode(mine.ids(text)).decode() == text
    for c in range(0, 0x3000):
        text = f"a{chr(c)}b {chr(c)}1 {chr(c)}  {chr(c)}!\n{chr(c)} x"
        assert mine.ids(text) == theirs.encode_ordinary(text), hex(c)


def test_each_prefix_ends_with_its_own_encodings_last_token(tiktoken_encoding):
    raw, theirs = tiktoken_encoding
    v, rng = byte_bpe.Vocabulary(byte_bpe.read_ranks(raw)), random.Random(2)
    word = "".join(rng.choice("etaoinshr") for _ in range(200)).encode()
    p = byte_bpe.Prefixes(v, word)
    for n in range(1, 201):
        assert p.last[n - 1] == theirs._encode_single_piece(word[:n])[-1] or word[:n] in v.ranks
    grown = byte_bpe.Prefixes(v)
    for at in range(0, 200, 7):
        grown.append(word[at : at + 7])
    assert grown.last == p.last and grown.ids() == p.ids()


def test_edits_encode_only_what_is_near(tiktoken_encoding):
    raw, theirs = tiktoken_encoding
    mine, rng = byte_bpe.Encoder(raw), random.Random(3)
    for k in range(300):
        text = "".join(rng.choice(LETTERS) for _ in range(rng.randint(0, 120))) + "".join(rng.choice("abcdeintrs") for _ in range(400 if k % 3 == 0 else 0))
        edited = byte_bpe.Edited(mine, text) if k % 2 else byte_bpe.Edited.restored(mine, text, theirs.encode_ordinary(text))
        for _ in range(4):
            a = rng.randint(0, len(text))
            b, new = rng.randint(a, min(len(text), a + 9)), "".join(rng.choice(LETTERS) for _ in range(rng.randint(0, 8)))
            text = text[:a] + new + text[b:]
            edited.replace(a, b, new)
            assert edited.text == text and edited.ids() == theirs.encode_ordinary(text)
    # one long part: the end of it stays as it was
    v = mine.vocabulary
    long_ = byte_bpe.Prefixes(v, ("".join(rng.choice("abcdeintrs") for _ in range(20_000))).encode())
    long_.replace(9_000, 9_003, b"zzzz")
    assert long_.worked < 1000 and long_.ids() == theirs._encode_single_piece(long_.body)


def test_op13_query_and_its_frames(spark, tmp_path, tiktoken_encoding):
    raw, theirs = tiktoken_encoding
    rows = [(i, t) for i, t, *_ in corpus(4)] + [(900, "'re " * 5000), (901, "汉字 é\r\n" * 50)]
    df = clashing(spark.createDataFrame(rows, "doc_id long, text string"))
    df.write.parquet(f"{tmp_path}/documents.parquet")
    want = []
    for i, t in rows:
        ids = theirs.encode_ordinary(t or "")
        want.append((i, len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    assert sorted(map(tuple, Q.op13_byte_bpe(spark, str(tmp_path)).collect()), key=str) == sorted(want, key=str)
    encoded = byte_bpe.encode(df)
    assert encoded.columns == [*df.columns, "ids"]
    back = byte_bpe.decode(encoded).select("text", "bytes", "ids").collect()
    assert all(bytes(r.bytes).decode() == (r.text or "") and r.ids == theirs.encode_ordinary(r.text or "") for r in back)
    more = byte_bpe.append(encoded.withColumn("more", F.when(F.col("doc_id") % 3 > 0, F.lit("'re s  more"))), "more").select("doc_id", "text", "ids").collect()
    assert sorted((r.doc_id, r.text) for r in more if r.doc_id is not None) == sorted((i, (t or "") + ("'re s  more" if i % 3 else "")) for i, t in rows if i is not None)
    assert all(r.ids == theirs.encode_ordinary(r.text) for r in more)
    places = encoded.withColumns({"a": F.lit(3), "b": F.when(F.col("doc_id") % 2 == 0, F.lit(9)), "new": F.lit("X y")})
    for r in byte_bpe.edit(places, "a", "b", "new").select("text", "ids").collect():
        assert r.ids == theirs.encode_ordinary(r.text)
    assert byte_bpe.encode(df.where("false")).count() == 0 and byte_bpe.report(df.where("false")).count() == 0


# --- op8: families that share much and link with none


@pytest.mark.parametrize(("length", "percent"), [(3, 90), (5, 80)])
def test_families_without_links_are_not_searched_and_send_no_hot_key(spark, monkeypatch, length, percent):
    rng = random.Random(percent)
    base = [f"b{rng.randrange(10**6)}" for _ in range(120)]
    rows = []
    for i in range(600):
        words = list(base)
        if percent == 90:
            for at in rng.sample(range(120), 4):
                words[at] = f"u{i}-{at}"
        else:
            words[92:] = [f"u{i}-{k}" for k in range(28)]
        rows.append((i, " ".join(words)))
    rows += [(1000, rows[0][1] + " end"), (1001, rows[1][1])]
    searched, keys = spark.sparkContext.accumulator(0), []
    search, keep = jaccard_join._search, jaccard_join.Scratch.keep

    def watched(length, percent, seen=searched):
        run = search(length, percent)

        def counted(parts):
            def each():
                for batch in parts:
                    seen.add(batch.num_rows)
                    yield batch

            yield from run(each())

        return counted

    def kept(self, df, name, *args, **how):
        out = keep(self, df, name, *args, **how)
        if name in ("sketch", "shared", "met"):
            said = out.where(F.col("kind").isin(jaccard_join.SIGNATURE, jaccard_join.TOKEN, jaccard_join.MANY)).groupBy("a").count().agg(F.max("count")).first()[0]
            keys.append((name, said or 0))
        return out

    monkeypatch.setattr(jaccard_join, "_search", watched)
    monkeypatch.setattr(jaccard_join.Scratch, "keep", kept)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {r.doc_id: r.component_id for r in jaccard_join.near_duplicates(df, length, percent).collect()}
    assert got == {i: {1000: 0, 1001: 1}.get(i, i) for i, _ in rows}
    assert searched.value <= 60 and len(keys) == (2 if percent == 90 else 3)
    assert max(n for _, n in keys) <= 5


# --- op4: the automaton in arrays


def test_compact_automaton_finds_every_window_and_is_small():
    from tidemark.llm.decontaminate import CompactAutomaton, SuffixAutomaton

    rng = random.Random(1)
    for _ in range(400):
        k, window = rng.choice([2, 4, 9]), rng.choice([2, 3, 5])
        items = [(str(i), [b"%d" % rng.randrange(k) for _ in range(rng.randint(1, 14))]) for i in range(rng.randint(1, 6))]
        doc = [b"%d" % rng.randrange(k + 1) for _ in range(rng.randint(0, 40))]
        hit, found = [0] * len(doc), set()
        for name, seq in items:
            m = min(window, len(seq))
            windows = {tuple(seq[i : i + m]) for i in range(len(seq) - m + 1)}
            for i in range(len(doc) - m + 1):
                if tuple(doc[i : i + m]) in windows:
                    found.add(name)
                    hit[i : i + m] = [1] * m
        spans, items_found = CompactAutomaton(SuffixAutomaton(window).fill(items)).scan(doc)
        got = [0] * len(doc)
        for a, b in spans:
            got[a:b] = [1] * (b - a)
        assert got == hit and items_found == found
    words = [(str(i), [b"w%d" % int(rng.paretovariate(0.7)) for _ in range(100)]) for i in range(300)]
    assert CompactAutomaton(SuffixAutomaton(10).fill(words)).size() < 100 * 30_000
