"""The pipeline's stages against brute force, and over tables with nulls, copies and clashing columns."""

from collections import Counter

import corpus_pipeline

from tidemark.llm import language_id

from tests.llm.test_llm_operators import base_by_pattern, clashing, corpus, empty, hits_by_hand, links_by_hand, SCHEMA


def test_stages_of_the_small_corpus(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    columns, kept = docs.columns, docs
    items = [tuple(r) for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()]
    results = {}
    for name, stage in corpus_pipeline.STAGES:
        kept = stage(spark, kept, small).cache()
        pieces = kept.collect()
        results[name] = {r.doc_id: r for r in pieces}
        if name != "source_mix":
            assert kept.columns == columns
    first = {r.doc_id: r for r in docs.collect()}
    predicted = {r.doc_id: r for r in language_id.identify(docs, added=("p", "s")).collect()}
    assert set(results["language_id"]) == {i for i, r in first.items() if any(c.isalpha() for c in r.text or "") and predicted[i].s > 0.5}
    assert all(r.lang == (first[i].lang or predicted[i].p) for i, r in results["language_id"].items())
    groups = links_by_hand([(i, r.text) for i, r in results["language_id"].items()], 5, 80)
    assert set(results["jaccard_join"]) == {c for _, c in groups.values()}
    clean = results["decontamination"]
    for i, r in results["jaccard_join"].items():
        n, hit, _ = hits_by_hand(r.text, items)
        assert (i in clean) == (hit <= 0.5 * n)
        if i in clean:
            assert (clean[i].text == r.text) == (hit == 0)
    for i, r in results["pii"].items():
        assert not base_by_pattern(r.text or "") and r.n_chars == len(r.text)
        if not base_by_pattern(clean[i].text):
            assert r.text == clean[i].text
    assert set(results["pii"]) == set(clean)
    mixed = Counter()
    for r in pieces:
        n = len(r.text.split())
        mixed[r.doc_id] += n
        assert n and r.text.split() == results["pii"][r.doc_id].text.split()[r.first_word : r.first_word + n]
    assert all(n <= 3 * len(results["pii"][i].text.split()) for i, n in mixed.items())
    assert sorted(corpus_pipeline.run(spark, small).columns) == sorted(kept.columns)


def test_stages_take_odd_tables(spark, small):
    for docs in (clashing(spark.createDataFrame(corpus(), SCHEMA)).repartition(2), empty(spark)):
        columns = docs.columns
        for name, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, small).cache()
            docs.count()
            if name != "source_mix":
                assert docs.columns == columns
    assert Counter(dict(corpus_pipeline.STAGES).keys()).total() == 5
