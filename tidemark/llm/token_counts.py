"""Token counts: an exact histogram of encoded lengths, and what follows from its suffix sums.

Every whole text is encoded by a public byte-level BPE (never trained here; the vocabulary file's path is a parameter, read
once by the driver and sent to the tasks). Documents are counted by length before any shuffle. With the documents and tokens
of all lengths above a limit, the total after truncation to the limit is a sum and a product.

Running sums go by bands of lengths: within a band, and over the totals of the bands, so no task sees the whole histogram.

The histogram is written once and read by both passes over it. Limits that are asked for but are no document's length join it as
lengths of no documents.

Defined cases: null and empty texts have 0 tokens. Repeated rows count each, and documents of equal length share a row. Texts of
any length are encoded whole. Only the text column is read. An empty table gives an empty result.
"""

from __future__ import annotations

import base64
from collections import Counter
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import Scratch, texts

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: the published pattern that parts texts before byte pairs are merged.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
BAND = 64
#: Context limits that the table always has.
LIMITS = tuple(2**k for k in range(7, 18))


def encoding(vocabulary: bytes):
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, vocabulary.splitlines())}
    return tiktoken.Encoding("public", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def length_histogram(docs: DataFrame, text: str = "text", vocabulary: str = VOCABULARY) -> DataFrame:
    """n_tokens, docs: how many rows of ``docs`` have texts of that many tokens."""
    with open(vocabulary, "rb") as f:
        sent = docs.sparkSession.sparkContext.broadcast(f.read())

    def run(parts):
        encode, counts = encoding(sent.value).encode_ordinary, Counter()
        for batch in parts:
            counts.update(len(encode(body)) for body in texts(batch.column(0)))
        keys = np.array(sorted(counts), np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array([counts[k] for k in keys.tolist()], pa.int64())], names=["n_tokens", "docs"])

    return docs.select(F.col(text).cast("string").alias("text")).mapInArrow(run, "n_tokens long, docs long").groupBy("n_tokens").agg(F.sum("docs").alias("docs"))


def limits(histogram: DataFrame, asked: Sequence[int] = LIMITS) -> DataFrame:
    """For each length that occurs and each limit asked for, taken as a context limit: docs of it, docs and tokens at or over it,
    all docs and tokens, the share of documents that fit (its quantile), and the tokens left when every document is truncated
    to it."""
    spark = histogram.sparkSession
    histogram = Scratch(spark).keep(histogram, "histogram")
    if histogram.isEmpty():
        asked = ()
    extra = spark.createDataFrame([(int(x), 0) for x in asked], "n_tokens long, docs long")
    histogram = histogram.unionByName(extra).groupBy("n_tokens").agg(F.sum("docs").alias("docs"))
    banded = histogram.withColumn("band", F.floor(F.col("n_tokens") / BAND)).withColumn("tokens", F.col("n_tokens") * F.col("docs"))
    bands = banded.groupBy("band").agg(F.sum("docs").alias("d"), F.sum("tokens").alias("t"))
    over = Window.orderBy(F.desc("band")).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    bands = bands.select(
        "band",
        F.coalesce(F.sum("d").over(over), F.lit(0)).alias("d_over"),
        F.coalesce(F.sum("t").over(over), F.lit(0)).alias("t_over"),
        F.sum("d").over(whole).alias("total_docs"),
        F.sum("t").over(whole).alias("total_tokens"),
    )
    within = Window.partitionBy("band").orderBy(F.desc("n_tokens")).rowsBetween(Window.unboundedPreceding, 0)
    rows = banded.withColumn("d_here", F.sum("docs").over(within)).withColumn("t_here", F.sum("tokens").over(within)).join(bands, "band")
    docs_from, tokens_from = F.col("d_here") + F.col("d_over"), F.col("t_here") + F.col("t_over")
    return rows.select(
        F.col("n_tokens").alias("context_limit"),
        "docs",
        docs_from.alias("docs_at_least"),
        tokens_from.alias("tokens_at_least"),
        "total_docs",
        "total_tokens",
        ((F.col("total_docs") - docs_from + F.col("docs")) / F.col("total_docs")).alias("share_that_fits"),
        (F.col("total_tokens") - tokens_from + docs_from * F.col("n_tokens")).alias("truncated_total"),
    )


def quantile(table: DataFrame, q: float) -> DataFrame:
    """The least length that at least the share q of the documents does not exceed."""
    return table.where(F.col("share_that_fits") >= q - 1e-12).agg(F.min("context_limit").alias("n_tokens"))


def truncated_total(table: DataFrame, limit: int) -> DataFrame:
    """Tokens left when every document is truncated to any limit, whether or not it occurs as a length."""
    over = F.col("context_limit") >= limit
    nearest = table.where(over).agg(F.min_by("docs_at_least", "context_limit").alias("d"), F.min_by("tokens_at_least", "context_limit").alias("t"))
    whole = table.agg(F.first("total_tokens").alias("all"))
    return whole.join(F.broadcast(nearest)).select((F.coalesce("all", F.lit(0)) - F.coalesce("t", F.lit(0)) + F.coalesce("d", F.lit(0)) * limit).alias("truncated_total"))
