"""Mixing sources to target weights, with DataFrame operations only.

Words are packed into blocks of ``block_words`` along each source. A source's target fixes how many output slots it fills. The
output is written in shards: for every shard the number of slots of each source is drawn, multinomially given the targets, since
each of a source's slots draws its shard alike. These counts are what everything after goes by: the slots of a source are
numbered shard after shard, slot j maps to block perm(j mod B) of the source's B blocks, with a fresh pseudorandom permutation
on every pass, and the blocks are joined by index. A source fills at most ``max_passes`` * B slots, so no block, and so no
document, is taken more often than that.

Packing works in buckets of documents, and slots are numbered in bands of shards, so that running sums never put a whole source
into one task; only the totals of buckets and bands are summed along a source. Rows without an id, and rows that share one, are
dealt over the buckets by their text. All draws follow from ids, sizes and the seed: a rerun gives the same mix.

Defined cases: a null text has size 0; such documents, and sources without words, take 0. A null source is a source, the
last one. Rows that share an id are each packed by itself; rows alike in id, source and text are interchangeable. A long text
spans many blocks and may land in many shards; none of it is cut off. Ids of any type are hashed, not cast. An empty table gives
an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import Scratch

#: A prime below 2^31: products of two residues fit into a long.
PRIME = 2_147_483_647
ROUNDS = 8
BLOCK_WORDS = 32
BUCKET_DOCS = 2_000
#: Shards whose slots are numbered by one running sum.
BAND_SHARDS = 1_024


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(sizes: DataFrame, max_passes: int = 3) -> DataFrame:
    """Per source (source, source_size): its place in code-point order, weight 1, 2, 3 in turn, and target.

    Targets share the sum of all sizes by weight and stop at max_passes times the source's size; what is above goes to the
    others by weight. With sources ordered by cap / weight, those before the first that stays below its share are capped.
    """
    in_order, by_ratio = Window.orderBy(F.asc_nulls_last("source")), Window.orderBy("ratio", "place")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everywhere = Window.partitionBy()
    placed = (
        sizes.withColumn("place", F.row_number().over(in_order) - 1)
        .withColumn("weight", (F.col("place") % 3 + 1).cast("long"))
        .withColumn("cap", F.lit(max_passes) * F.col("source_size"))
        .withColumn("ratio", F.col("cap") / F.col("weight"))
        .withColumn("total", F.sum("source_size").over(everywhere))
    )
    levelled = placed.withColumn(
        "level", (F.col("total") - F.coalesce(F.sum("cap").over(before), F.lit(0))).cast("double") / F.sum("weight").over(onward)
    )
    open_level = F.first(F.when(F.col("ratio") > F.col("level"), F.col("level")), ignorenulls=True).over(
        by_ratio.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    )
    target = F.least(F.col("cap").cast("double"), F.coalesce(open_level * F.col("weight"), F.col("cap").cast("double")))
    return levelled.withColumn("target", target).select("source", "place", "source_size", "weight", "target")


def permuted(df: DataFrame, index: str, size: str, keys: list[str], seed: int, out: str) -> DataFrame:
    """A pseudorandom permutation of 0..size-1 for each value of the keys: rounds that swap x with k - x, or don't, by a bit
    of the larger of the two."""
    key = F.lit(seed % PRIME).cast("long")
    for name in keys:
        key = F.pmod(key * 48_271 + F.col(name).cast("long") + 1, F.lit(PRIME))

    def swap(state: Column, r: Column) -> Column:
        k = F.pmod(state["k"] * 16_807 + r, F.lit(PRIME))
        other = F.pmod(k % F.col(size) - state["x"], F.col(size))
        mixed = F.pmod(F.greatest(state["x"], other) * 69_621 + k, F.lit(PRIME))
        bit = F.pmod(mixed * mixed + k, F.lit(PRIME)) % 2
        return F.struct(F.when(bit == 1, other).otherwise(state["x"]).alias("x"), k.alias("k"))

    start = F.struct(F.col(index).cast("long").alias("x"), F.col("__key").alias("k"))
    rounds = F.sequence(F.lit(1).cast("long"), F.lit(ROUNDS).cast("long"))
    return df.withColumn("__key", key).withColumn(out, F.aggregate(rounds, start, swap)["x"]).drop("__key")


class Mix:
    """The parts of a mix: documents with their place, the blocks' pieces and the slots."""

    def __init__(
        self,
        docs: DataFrame,
        doc_id: str = "doc_id",
        text: str = "text",
        source: str = "source",
        block_words: int = BLOCK_WORDS,
        max_passes: int = 3,
        shard_slots: int = 65_536,
        seed: int = 1,
        bucket_docs: int = BUCKET_DOCS,
        with_text: bool = False,
    ):
        self.docs, self.seed, self.block_words = docs, seed, block_words
        spark = docs.sparkSession
        columns = [F.col(doc_id).alias("doc_id"), F.col(source).cast("string").alias("source"), word_count(F.col(text)).alias("size"), F.xxhash64(F.col(text)).alias("mark")]
        if with_text:  # rows need a name of their own to meet their text again
            columns += [F.col(text).cast("string").alias("text"), F.monotonically_increasing_id().alias("row")]
        sized = docs.select(*columns)
        self.scratch = Scratch(spark)
        staged = self.scratch.keep(sized, "sizes")
        sized, self.texts = (staged.drop("text"), staged.select("row", "text")) if with_text else (staged, None)
        per_source = targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), max_passes)
        n = sized.count()
        buckets = max(1, -(-n // bucket_docs))
        bucket = F.pmod(F.xxhash64("doc_id", "mark"), F.lit(buckets))
        along = Window.partitionBy("place", "bucket").orderBy(F.asc_nulls_first("doc_id"), "size", "mark").rowsBetween(Window.unboundedPreceding, 0)
        #: doc_id, size, source_size, target, place, bucket, start: a document is words start .. start + size of its bucket
        self.placed = (
            sized.join(per_source.withColumnRenamed("source", "__source"), F.col("source").eqNullSafe(F.col("__source")))
            .drop("__source")
            .withColumn("bucket", bucket)
            .withColumn("start", F.sum("size").over(along) - F.col("size"))
        )
        totals = self.placed.groupBy("place", "bucket").agg(F.sum("size").alias("words"), F.first("source_size").alias("source_size"), F.first("target").alias("target"))
        blocks = totals.withColumn("blocks", F.ceil(F.col("words") / block_words))
        chain = Window.partitionBy("place").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
        self.offsets = blocks.withColumn("first_block", F.sum("blocks").over(chain) - F.col("blocks")).select("place", "bucket", "first_block")
        quota = (
            blocks.groupBy("place")
            .agg(F.sum("blocks").alias("blocks"), F.first("source_size").alias("source_size"), F.first("target").alias("target"))
            .where(F.col("blocks") > 0)
            .withColumn("slots", F.least(F.lit(max_passes) * F.col("blocks"), F.floor(F.col("target") * F.col("blocks") / F.col("source_size") + F.lit(0.5))))
        )
        #: One row per source: place, blocks, slots
        self.quota = quota.where(F.col("slots") > 0).select("place", "blocks", F.col("slots").cast("long").alias("slots"))
        self.shard_slots, self.drawn = shard_slots, None

    def shard_counts(self) -> DataFrame:
        """The draw: place, shard, n (slots of the source in the shard), first (its first slot there)."""
        if self.drawn is None:
            self.drawn = self.scratch.keep(self._draw().withColumn("band", F.floor(F.col("shard") / BAND_SHARDS)), "drawn")
        drawn = self.drawn
        before = lambda *keys, by: Window.partitionBy(*keys).orderBy(by).rowsBetween(Window.unboundedPreceding, -1)
        running = lambda x, w: F.coalesce(F.sum(x).over(w), F.lit(0))
        bands = drawn.groupBy("place", "band").agg(F.sum("n").alias("in_band")).withColumn("before", running("in_band", before("place", by="band")))
        within = drawn.withColumn("within", running("n", before("place", "band", by="shard")))
        return within.join(bands.drop("in_band"), ["place", "band"]).select("place", "shard", "n", (F.col("before") + F.col("within")).alias("first"))

    def _draw(self) -> DataFrame:
        """place, shard, n: every slot of a source draws its shard."""
        spark = self.docs.sparkSession
        chunk = 16_384
        starts = self.quota.withColumn("at", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("slots") - 1) / F.lit(chunk)))))
        # a source's slots are made by many tasks, not where its one row lies
        parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
        starts = starts.repartition(parts, "place", "at")
        first = F.col("at") * chunk
        slots = starts.withColumn("slot", F.explode(F.sequence(first, F.least(first + (chunk - 1), F.col("slots") - 1))))
        total = self.quota.agg(F.ceil(F.sum("slots") / F.lit(self.shard_slots)).alias("shards"))
        draw = F.pmod(F.xxhash64("place", "slot", F.lit(self.seed)), F.col("shards"))
        return slots.join(F.broadcast(total)).groupBy("place", draw.alias("shard")).agg(F.count("*").alias("n"))

    def slots(self) -> DataFrame:
        """One row per output slot: place of the source, slot, pass, block, and the shard."""
        spark = self.docs.sparkSession
        chunk = 16_384
        counts = self.shard_counts().join(self.quota.drop("slots"), "place")
        counts = counts.withColumn("at", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / F.lit(chunk)))))
        counts = counts.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "place", "shard", "at")
        begin = F.col("first") + F.col("at") * chunk
        slots = counts.withColumn("slot", F.explode(F.sequence(begin, F.least(begin + chunk, F.col("first") + F.col("n")) - 1)))
        slots = slots.withColumn("pass", F.floor(F.col("slot") / F.col("blocks"))).withColumn("index", F.col("slot") % F.col("blocks"))
        slots = permuted(slots, "index", "blocks", ["place", "pass"], self.seed, "block")
        return slots.select("place", "slot", "pass", "block", "shard")

    def pieces(self) -> DataFrame:
        """One row per document and block: place, block, bucket, start of the document, first word of it and words."""
        n = self.block_words
        end = F.col("start") + F.col("size")
        rows = self.placed.where(F.col("size") > 0).join(self.offsets, ["place", "bucket"])
        rows = rows.withColumn("local", F.explode(F.sequence(F.floor(F.col("start") / n), F.floor((end - 1) / n))))
        first = F.greatest(F.col("start"), F.col("local") * n)
        last = F.least(end, (F.col("local") + 1) * n)
        return rows.select(
            "place", (F.col("first_block") + F.col("local")).alias("block"), "bucket", "start", "doc_id", (first - F.col("start")).alias("first_word"), (last - first).alias("words")
        )

    def output(self) -> DataFrame:
        """The mix itself: shard, place, slot, and the pieces of documents that the slot's block holds."""
        return self.pieces().join(self.slots().hint("merge"), ["place", "block"]).select("shard", "place", "slot", "bucket", "start", "doc_id", "first_word", "words")

    def mixed_texts(self) -> DataFrame:
        """The mix as text (needs ``with_text``): shard, source, slot, doc_id, first_word, text. One row per piece of a document in a
        slot; its words are joined by single spaces."""
        piece = F.struct("shard", "slot", "first_word", "words")
        per_doc = self.output().groupBy("place", "bucket", "start").agg(F.collect_list(piece).alias("taken"))
        named = self.placed.where(F.col("size") > 0).join(per_doc.hint("merge"), ["place", "bucket", "start"]).select("row", "doc_id", "source", "taken")
        split = F.regexp_extract_all("text", F.lit(r"([^\x20\x09-\x0D]+)"), 1)
        rows = named.join(self.texts.hint("merge"), "row").withColumn("word", split)
        cut = F.transform("taken", lambda p: F.struct(p["shard"], p["slot"], p["first_word"], F.array_join(F.slice(F.col("word"), (p["first_word"] + 1).cast("int"), p["words"].cast("int")), " ").alias("text")))
        rows = rows.select("doc_id", "source", F.explode(cut).alias("piece"))
        return rows.select("piece.shard", "source", "piece.slot", "doc_id", "piece.first_word", "piece.text")

    def report(self) -> DataFrame:
        """One row per document: doc_id, size, source_size, target, taken."""
        # every slot of every shard once; a block's shards show how often each takes it
        taken = self.slots().groupBy("place", "block").agg(F.count("shard").alias("times"))
        # the planner can't know how many slots the sources' few rows become: it must not broadcast them
        per_doc = self.pieces().join(taken.hint("merge"), ["place", "block"]).groupBy("place", "bucket", "start").agg(F.sum(F.col("times") * F.col("words")).alias("taken"))
        with_words = self.placed.where(F.col("size") > 0).join(per_doc.hint("merge"), ["place", "bucket", "start"], "left")
        columns = ["doc_id", "size", "source_size", "target"]
        rest = self.placed.where(F.col("size") == 0).select(*columns, F.lit(0).cast("long").alias("taken"))
        return with_words.select(*columns, F.coalesce("taken", F.lit(0)).alias("taken")).unionByName(rest)
