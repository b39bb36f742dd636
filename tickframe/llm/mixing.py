"""Mixing sources to target weights, by blocks of words.

The texts of a source, in order, form one stream of words that is cut into
blocks of a fixed length. Slots of the mix are filled shard by shard: how many
slots of a shard each source gets is drawn by multinomial inverse-CDF draws
over the sources' weights; the slots of a source are counted on over all
shards, mapped through a pseudorandom permutation of its blocks (a new one in
each epoch), and joined to the blocks by index. Nothing else is moved; texts
stay where they are. Only DataFrame expressions are used.

The draw of a shard is stratified: slot i takes a uniform from [i/S, (i+1)/S).
Expected counts are those of independent draws, and each source is off by less
than two slots a shard, so that small sources come near their targets too. The
count of a source is then the difference of two cumulative counts, each known
from one uniform, and no row per undrawn slot is made.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickframe.llm import feistel
from tickframe.llm.common import SPACE, WORD, restore_names, running_totals, set_names
from tickframe.session import shared_dir, stage

BLOCK_WORDS = 64
SHARD_SLOTS = 16384
WEIGHTS = (5, 2, 1)
MOST_EPOCHS = 3
SEED = 77


def words_of(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, most: float = MOST_EPOCHS) -> DataFrame:
    """Adds place, weight and target to rows (source, source_size), one per source.

    The sum of all sizes is shared by weight; a target above ``most`` times its
    source's size stops there and the rest is shared again among the others.
    In closed form: sources in order of cap over weight, the first of them
    capped, the others at a common level times their weight.
    """
    by_name = Window.partitionBy(F.lit(0)).orderBy(F.col("source").asc_nulls_last())
    named = sizes.withColumn("place", F.row_number().over(by_name) - 1)
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (F.col("place") % len(weights) + 1).cast("int"))
    named = named.withColumn("weight", weight).withColumn("_cap", F.col("source_size") * float(most))
    by_ratio = Window.partitionBy(F.lit(0)).orderBy(F.col("_cap") / F.col("weight"), "place")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy(F.lit(0))
    left = F.sum("source_size").over(everything) - F.coalesce(F.sum("_cap").over(before), F.lit(0.0))
    heavy = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    level = named.withColumn("_level", left / heavy)
    capped = F.col("_cap") <= F.col("_level") * F.col("weight")
    # The first source under its cap sets the level of all that follow it.
    common = F.min(F.when(~capped, F.struct(F.col("_cap") / F.col("weight"), "place", "_level"))).over(everything)
    return level.withColumn("_common", common.getField("_level")) \
        .withColumn("target", F.when(capped, F.col("_cap")).otherwise(F.col("_common") * F.col("weight"))) \
        .select("source", "source_size", "place", "weight", "target")


def draws(sources: DataFrame, block: int = BLOCK_WORDS, slots: int = SHARD_SLOTS, most: int = MOST_EPOCHS,
          seed: int = SEED) -> DataFrame:
    """The filled slots of the mix: shard, slot, source, epoch, block.

    ``sources`` comes from ``targets``. ``slot`` is the place in the shard; the
    slots of a shard are shuffled. Sources without words get none.
    """
    spark = sources.sparkSession
    every = Window.partitionBy(F.lit(0))
    upto = every.orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    with_blocks = sources.filter("source_size > 0 AND target > 0") \
        .withColumn("n", F.ceil(F.col("source_size") / block).cast("long")) \
        .withColumn("key", F.xxhash64(F.lit(seed), F.col("source"))) \
        .withColumn("share", F.col("target") * F.col("n") / F.col("source_size"))
    shares = stage(with_blocks.withColumn("low", F.coalesce(F.sum("share").over(upto), F.lit(0.0)))
                   .withColumn("total", F.ceil(F.sum("share").over(every) - 1e-9).cast("long"))
                   .withColumn("sum", F.sum("share").over(every)), "shares")
    shards = shares.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(total - 1) div {slots}"))).alias("shard"))
    size = F.least(F.lit(slots).cast("long"), F.col("total") - F.col("shard") * slots)

    def below(bound: Column) -> Column:
        """How many slots of the shard draw a uniform under ``bound``."""
        at = bound * F.col("size")
        whole = F.least(F.floor(at), F.col("size"))
        uniform = (F.xxhash64(F.lit(seed), F.col("shard"), whole) % F.lit(1 << 30) + (1 << 30)) / float(1 << 31)
        return whole + F.when((whole < F.col("size")) & (uniform < at - whole), 1).otherwise(0)

    # The next source begins exactly where this one ends, so that no slot is drawn twice.
    high = F.coalesce(F.lead("low").over(Window.partitionBy("shard").orderBy("place")), F.col("sum"))
    counted = shards.withColumn("size", size).withColumn("high", high) \
        .withColumn("first", below(F.col("low") / F.col("sum"))) \
        .withColumn("count", below(F.col("high") / F.col("sum")) - F.col("first"))
    so_far = Window.partitionBy("source").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    numbered = counted.withColumn("start", F.coalesce(F.sum("count").over(so_far), F.lit(0)))
    # Few rows, each of which makes up to a shard of slots: about one task per shard.
    total = shares.agg(F.max("total")).first()[0] or 0
    numbered = numbered.repartition(max(1, -(-total // slots)), "shard", "source")
    each = numbered.filter("count > 0").select("*", F.explode(F.expr("sequence(0L, count - 1)")).alias("_i")) \
        .withColumn("_t", F.col("start") + F.col("_i")).filter(F.col("_t") < F.col("n") * most) \
        .withColumn("epoch", F.expr("_t div n"))
    # One permutation per source and epoch, and one per shard for the order of its slots.
    epochs = shares.select("n", "key", F.explode(F.sequence(F.lit(0), F.lit(most - 1))).alias("epoch"))
    order_key = F.xxhash64(F.lit(seed), F.col("shard"))
    domains = epochs.select("n", F.xxhash64("key", F.col("epoch").cast("long")).alias("key")) \
        .union(counted.select(F.col("size").alias("n"), order_key.alias("key")).distinct())
    shared_dir(spark)
    steps = feistel.walks(domains)
    block_of = feistel.permute(F.expr("_t % n"), F.col("n"), F.xxhash64("key", "epoch"), steps)
    slot_of = feistel.permute(F.col("first") + F.col("_i"), F.col("size"), order_key, steps)
    return each.select("shard", slot_of.alias("slot"), "source", "epoch", block_of.alias("block"))


def mix(docs: DataFrame, weights: Sequence[float] = WEIGHTS, block: int = BLOCK_WORDS,
        slots: int = SHARD_SLOTS, most: int = MOST_EPOCHS, seed: int = SEED) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The mix of ``docs`` (doc_id, source, text): documents, spans of blocks, slots.

    * documents: doc_id, source, size, offset in its source's stream, source_size, target
    * spans: one row per document and block it touches: doc_id, source, offset, block,
      first word of the document in it, words, times (how often the mix takes it)
    * slots: see ``draws``

    Null texts have no words and null sources are a source of their own, last
    in order. Rows of equal id are ordered by text hash. Empty tables, and
    tables without words, give empty spans and slots.
    """
    sized = docs.select("doc_id", "source", words_of(F.col("text")).alias("size"),
                        F.xxhash64(F.coalesce(F.col("text"), F.lit(""))).alias("_hash"))
    rows = running_totals(sized, ["source"], ["doc_id", "_hash"], {"offset": F.col("size")}, "source-streams")
    rows = stage(rows, "streams")
    sources = stage(targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), weights, most), "targets")
    documents = rows.withColumnRenamed("source", "_source") \
        .join(sources.select("source", "source_size", "target"), F.col("_source").eqNullSafe(F.col("source"))) \
        .drop("_source")
    filled = draws(sources, block, slots, most, seed)
    # Estimates follow the few rows that slots are made of, so say that this side is not small.
    times = filled.groupBy(F.col("source").alias("_source"), F.col("block").alias("_block")) \
        .agg(F.count("*").alias("times")).hint("merge")
    touched = rows.filter("size > 0").select(
        "doc_id", "_hash", "source", "size", "offset",
        F.explode(F.expr(f"sequence(offset div {block}, (offset + size - 1) div {block})")).alias("block"))
    start = F.greatest(F.col("offset"), F.col("block") * block)
    end = F.least(F.col("offset") + F.col("size"), (F.col("block") + 1) * block)
    spans = touched.withColumn("first_word", start - F.col("offset")).withColumn("words", end - start) \
        .join(times, (F.col("block") == F.col("_block")) & F.col("source").eqNullSafe(F.col("_source")), "left") \
        .select("doc_id", "_hash", "source", "offset", "block", "first_word", "words",
                F.coalesce("times", F.lit(0)).cast("long").alias("times"))
    return documents, spans, filled


def document_shares(docs: DataFrame, **options) -> DataFrame:
    """One row per document: size, source_size, target of its source, taken (its words in the mix)."""
    documents, spans, _ = mix(docs, **options)
    taken = spans.filter("times > 0").groupBy("doc_id", "offset", F.col("source").alias("_source")) \
        .agg(F.sum(F.col("words") * F.col("times")).alias("taken"))
    # Two documents of a source share an offset only if the first has no words, and so is in no span.
    return documents.withColumn("_at", F.when(F.col("size") > 0, F.col("offset"))).join(
        taken.select(F.col("doc_id").alias("_id"), F.col("offset").alias("_offset"), "_source", "taken"),
        F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_at") == F.col("_offset"))
        & F.col("source").eqNullSafe(F.col("_source")), "left") \
        .select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0).cast("long")).alias("taken"))


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mixed texts, with the columns of ``docs``.

    A document comes once per copy: copy k holds, in order, its words of all
    blocks that the mix takes k times or more, with the white space that
    follows them. Copies without words are left out; n_chars, if there, is
    the length of the copy.
    """
    block = options.get("block", BLOCK_WORDS)
    most = options.get("most", MOST_EPOCHS)
    documents, spans, _ = mix(docs, **options)
    # Keys that are never null; rows alike in all of them are told apart by their number among them.
    def keys(id_column: str, source: str) -> list[Column]:
        return [F.coalesce(F.col(id_column).cast("string"), F.lit("")).alias("_id"),
                F.coalesce(F.concat(F.lit("="), F.col(source)), F.lit("")).alias("_source")]

    names = ["_id", "_source", "_hash"]
    # Blocks follow each other, so a list of times in block order is enough. Bounded by the document.
    counts = spans.groupBy("doc_id", "_hash", "source", "offset") \
        .agg(F.array_sort(F.collect_list(F.struct("block", "times"))).alias("_times")) \
        .select(*keys("doc_id", "source"), "_hash", "offset", F.col("_times.times").alias("_times")) \
        .withColumn("_place", F.row_number().over(Window.partitionBy(*names).orderBy("offset")))
    pieces = F.regexp_extract_all(F.coalesce(F.col("text"), F.lit("")), F.lit(f"{WORD}[{SPACE}]*"), F.lit(0))
    plain = set_names(docs, "doc_id", "source", "text")
    hashed = plain.withColumn("_hash", F.xxhash64(F.coalesce(F.col("text"), F.lit("")))).select("*", *keys("doc_id", "source")) \
        .withColumn("_nth", F.row_number().over(Window.partitionBy(*names).orderBy(F.lit(0))))
    # The numbers are compared apart from the join's keys, so that texts are moved once, for the window.
    copies = hashed.join(counts, names).filter(F.abs(F.col("_nth") - F.col("_place")) < 1) \
        .withColumn("_copy", F.explode(F.sequence(F.lit(1), F.lit(most)))) \
        .filter(F.col("_copy") <= F.array_max("_times")).withColumn("_pieces", pieces)
    kept = F.expr(f"filter(_pieces, (w, i) -> _times[cast((offset + i) div {block} - offset div {block} as int)] >= _copy)")
    out = restore_names(copies.withColumn("text", F.array_join(kept, "")), docs, "doc_id", "source", "text")
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return out
