"""A training-data pipeline over ``documents``: each stage works on all that its predecessor kept.

Language ID rejects documents whose predicted language is none or no clearer than a draw; of near duplicates (five-word shingles,
similarity 0.8 or more) the one of the least doc_id stays; runs of benchmark windows are cut out, and documents more than half of
which they make up go; personal data and the terms that give it away are generalised or removed; at last sources are mixed to
their target weights, and the mixed text is written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontaminate, jaccard_join, language_id, pii, source_mix
from tidemark.llm.common import Scratch, table, temporary_tables


def _measured(docs: DataFrame) -> DataFrame:
    """The documents with n_chars of the text as it is now."""
    return docs.withColumn("n_chars", F.length("text").cast("long"))


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str, min_score: float = 0.5) -> DataFrame:
    """Documents of a predicted language that is likelier than all others together; a null ``lang`` becomes the predicted one."""
    found = language_id.identify(docs, added=("__language", "__score"))
    found = found.where((F.col("__language") != "und") & (F.col("__score") > min_score))
    return found.withColumn("lang", F.coalesce("lang", "__language")).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard_join.deduplicated(docs, length=5, percent=80)


def remove_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _measured(decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark")))


def remove_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _measured(pii.sanitise(docs))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: one row per piece of a document in a slot of a shard, with its words."""
    return source_mix.Mix(docs, with_text=True).mixed_texts()


STAGES = [
    ("language_id", identify_language),
    ("jaccard_join", drop_near_duplicates),
    ("decontamination", remove_benchmark),
    ("pii", remove_personal_data),
    ("source_mix", mix_sources),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scratch, last = Scratch(spark), None
    for name, stage in STAGES:
        # a stage's own tables go once its documents are written, and so do the documents before
        with temporary_tables(spark, scratch):
            kept = scratch.keep(stage(spark, docs, sf_dir), name)
        if last:
            scratch.drop(last)
        docs, last = kept, name
    return docs


#: Language ID and the disclosure of terms are not expressible in SQL; tests hold the stages against brute force.
ORACLE_SQL = None
