"""Queries of the numbered operators, with production parameters, over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    bitsliced_topk,
    byte_bpe,
    decontaminate,
    jaccard_join,
    language_id,
    license_scan,
    lm_score,
    periodic_runs,
    pii,
    source_mix,
    token_counts,
    toxicity,
    vector_codes,
)
from tidemark.llm.common import fold, table


def op3_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return lm_score.score(docs.withColumn("held_out", fold(F.col("doc_id"), 7) == 2))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


OP4_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
items AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
item_windows AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS k, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS win
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS i FROM items WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT k FROM item_windows),
doc_windows AS (
  SELECT r, i, k, array_to_string(w[i:i + k - 1], ' ') AS win
  FROM (SELECT r, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM docs, sizes WHERE len(w) >= k)),
hits AS (SELECT r, i, d.k, item_id FROM doc_windows d JOIN item_windows t ON d.win = t.win AND d.k = t.k),
hit_words AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + k)) AS p FROM hits) GROUP BY r),
hit_items AS (
  SELECT r, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS names
  FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS s FROM hits) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hit_words USING (r) LEFT JOIN hit_items USING (r)
"""


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang").withColumn("held_out", fold(F.col("doc_id"), 5) == 0)
    model = language_id.train(docs.where(~F.col("held_out")))
    return language_id.predict(docs.select("doc_id", "held_out", "text"), model).select("doc_id", "held_out", "lang_pred", "score")


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents"))


def _op1_sql() -> str:
    lower = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    notice = r"(?m)^[^a-z0-9\x{80}-\x{10FFFF}\n(]*(copyright[ \t]+(\(c\)|©|[0-9]{4})|\(c\)[ \t]*[0-9]{4}|©[ \t]*[0-9]{4})[^\n]*$"
    body = f"list_filter(string_split(regexp_replace(regexp_replace({lower}, '{notice}', '', 'g'), '[^a-z0-9\\x{{80}}-\\x{{10FFFF}}]+', ' ', 'g'), ' '), lambda w: w <> '')"
    cases = " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in license_scan.EQUIVALENT.items())
    known = ", ".join(f"('{d}', '{name}')" for d, name in license_scan.known_digests().items())
    return f"""
WITH digests AS (SELECT doc_id, sha256(array_to_string(list_transform({body}, lambda w: CASE w {cases} ELSE w END), ' ')) AS digest FROM documents)
SELECT doc_id, digests.digest, license_id FROM digests LEFT JOIN (VALUES {known}) AS known(digest, license_id) ON known.digest = digests.digest
"""


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), fold(F.col("doc_id"), 3) != 1)
    scored = toxicity.score(docs, model)
    return scored.select("doc_id", (fold(F.col("doc_id"), 3) == 1).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.limits(token_counts.length_histogram(table(spark, sf_dir, "documents")))


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(table(spark, sf_dir, "documents"))


def op7_bitsliced_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bitsliced_topk.exact_top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


OP7_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v))
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 20
"""


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.near_duplicates(table(spark, sf_dir, "documents"), length=3, percent=90)


OP8_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, shingle FROM (
  SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' ')) END) AS shingle FROM d)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY ALL),
e AS (SELECT x, y FROM p JOIN n i ON i.doc_id = x JOIN n j ON j.doc_id = y WHERE 100 * c >= 90 * (i.n + j.n - c)),
links AS (SELECT x, y FROM e UNION ALL SELECT y, x FROM e),
reach(a, b) AS (SELECT doc_id, doc_id FROM d UNION SELECT a, y FROM reach JOIN links ON b = x)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, component_id
FROM d LEFT JOIN n ON n.doc_id = d.doc_id JOIN (SELECT a, min(b) AS component_id FROM reach GROUP BY a) r ON r.a = d.doc_id
"""


def op9_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_mix.Mix(table(spark, sf_dir, "documents")).report()


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.Codebooks(table(spark, sf_dir, "embeddings")).report()


def _op11_sql(rounds: int = 4) -> str:
    """Every round assigns by a join of distinct parts with their codebook; the nearest of (distance, entry) is a least pair."""
    distance = "list_sum(list_transform(list_zip(p.x, b.x), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""a{r} AS MATERIALIZED (
  SELECT p.part, p.r, min(struct_pack(d := CAST({distance} AS BIGINT), e := b.entry)) AS best
  FROM parts p JOIN b{r} b ON p.part = b.part GROUP BY p.part, p.r)""")
        if r < rounds:
            steps.append(f"""b{r + 1} AS MATERIALIZED (
  SELECT b.part, b.entry, coalesce(m.x, b.x) AS x FROM b{r} b LEFT JOIN (
    SELECT part, entry, list(CAST(floor_mean AS BIGINT) ORDER BY i) AS x FROM (
      SELECT p.part, a.best.e AS entry, i, (sum(p.x[i]) - ((sum(p.x[i]) % count(*)) + count(*)) % count(*)) // count(*) AS floor_mean
      FROM parts p JOIN a{r} a ON a.part = p.part AND a.r = p.r, unnest(range(1, len(p.x) + 1)) AS t(i) GROUP BY p.part, a.best.e, i)
    GROUP BY part, entry) m ON m.part = b.part AND m.entry = b.entry)""")
    return f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id, v) AS r, vec_id, label, v FROM (
    SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0)),
parts AS MATERIALIZED (
  SELECT r, part, v[part * len(v) // 4 + 1:(part + 1) * len(v) // 4] AS x FROM kept, unnest(range(4)) AS t(part)),
b0 AS MATERIALIZED (SELECT part, r - 1 AS entry, x FROM parts WHERE r <= 256),
{", ".join(steps)},
sha AS (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM b{rounds}),
coded AS (
  SELECT k.vec_id, k.label, c.code, c.error FROM kept k JOIN (
    SELECT r, string_agg(printf('%02x', best.e), '' ORDER BY part) AS code, CAST(sum(best.d) AS BIGINT) AS error FROM a{rounds} GROUP BY r) c ON c.r = k.r)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256 FROM coded, sha
"""


def planted_periods(docs: DataFrame) -> DataFrame:
    """doc_id and text; where crc32 of the id is divisible by 10, the text's words from a on repeat the p words at a."""
    h = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    words = F.filter(F.split(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    g, n = F.floor(h / 10).cast("long"), F.size("words")
    marked = docs.select("doc_id", "text", F.when(h % 10 == 0, words).alias("words"), g.alias("g"))
    marked = marked.withColumn("a", F.when(n > 0, F.col("g") % n).cast("int"))
    marked = marked.withColumn("p", (1 + F.floor((n - F.col("a")) / (3 + F.col("g") % 8))).cast("int"))
    times = F.ceil((n - F.col("a")) / F.col("p")).cast("int")
    tail = F.slice(F.flatten(F.array_repeat(F.slice("words", F.col("a") + 1, F.col("p")), times)), F.lit(1), n - F.col("a"))
    planted = F.array_join(F.concat(F.slice("words", F.lit(1), F.col("a")), tail), " ")
    return marked.select("doc_id", F.when(F.col("a").isNotNull(), planted).otherwise(F.col("text")).alias("text"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.report(planted_periods(table(spark, sf_dir, "documents").select("doc_id", "text")))


def op13_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.report(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_license_scan": op1_license_scan,
    "op2_pii": op2_pii,
    "op5_toxicity": op5_toxicity,
    "op6_token_counts": op6_token_counts,
    "op7_bitsliced_topk": op7_bitsliced_topk,
    "op8_jaccard_join": op8_jaccard_join,
    "op9_source_mix": op9_source_mix,
    "op3_lm_score": op3_lm_score,
    "op4_decontamination": op4_decontamination,
    "op10_language_id": op10_language_id,
    "op11_vector_codes": op11_vector_codes,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_byte_bpe": op13_byte_bpe,
}
ORACLES = {
    "op1_license_scan": _op1_sql(),
    "op4_decontamination": OP4_SQL,
    "op7_bitsliced_topk": OP7_SQL,
    "op8_jaccard_join": OP8_SQL,
    "op11_vector_codes": _op11_sql(),
}
