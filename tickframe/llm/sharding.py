"""Sharding by a permutation of global row numbers.

Every row gets its global number (rank of its key, found without sorting in one
task), the number goes through a Feistel permutation of 0 .. rows-1, and shard
and slot are remainder and quotient of the result: shards differ by one row at
most, slots have no gaps, and the shuffle is reproducible from key, seed and
row count alone. Only DataFrame expressions are used.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickframe.llm import feistel
from tickframe.llm.common import running_totals
from tickframe.session import shared_dir

SHARDS = 16
SEED = 20240229


def shard(df: DataFrame, order: list[str], shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """Adds shard (int) and slot (long) to each row of ``df``.

    ``order`` names the columns that number the rows; rows equal in all of them
    are interchangeable, so any numbering among them gives the same result.
    Nulls in them come first. An empty table gives no rows. Columns named
    shard or slot are replaced. Keep ``df`` narrow: its rows are sorted.
    """
    spark = df.sparkSession
    shared_dir(spark)
    rows = df.drop("shard", "slot")
    numbered = running_totals(rows, [], order, {"_number": F.lit(1)}, "row-numbers")
    total = rows.count()
    if not total:
        return rows.select("*", F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot"))
    key = F.xxhash64(F.lit(seed))
    steps = feistel.walks(spark.range(1).select(F.lit(total).cast("long").alias("n"), key.alias("key")))
    place = feistel.permute(F.col("_number"), F.lit(total).cast("long"), key, steps)
    placed = numbered.withColumn("_place", place)
    return placed.select(*rows.columns, (F.col("_place") % shards).cast("int").alias("shard"),
                         F.expr(f"_place div {int(shards)}").alias("slot"))


def document_shards(docs: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """One row per document: where it goes, by law ``rows``.

    Null texts count as empty (size 1). Documents of equal id are ordered by
    size and checksum. Extra columns are ignored.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    narrow = docs.select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"),
                         F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"))
    placed = shard(narrow, ["doc_id", "size", "text_crc32"], shards, seed)
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))
