"""Adapters: stocks, bars and messages derived from the star-schema tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickframe.schemas import PRICE


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{root}/{name}.parquet")


def letters(number: F.Column | str, width: int = 10) -> F.Column:
    """A symbol per number; ten digits hold every integer."""
    padded = F.lpad(F.col(number).cast("string") if isinstance(number, str) else number.cast("string"), width, "0")
    return F.translate(padded, "0123456789", "ABCDEFGHIJ")


def stocks(spark: SparkSession, root: str) -> DataFrame:
    supplier, nation = table(spark, root, "supplier"), table(spark, root, "nation")
    return (supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey"), "left")
            .select((F.col("s_suppkey") + 1).cast("int").alias("stock_id"),
                    letters(F.col("s_suppkey") + 1).alias("symbol"),
                    F.col("s_name").alias("company_name"), F.col("n_name").alias("sector")))


def bars(spark: SparkSession, root: str) -> DataFrame:
    """One bar per supplier and ship date.

    First and last price come from ``min_by``/``max_by``, which reduce rows
    before the exchange, so a key with very many rows on a day is no burden.
    """
    sequence = F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")
    rows = table(spark, root, "lineitem").select(
        (F.col("l_suppkey") + 1).cast("int").alias("stock_id"),
        F.col("l_shipdate").cast("date").alias("date"),
        F.round(F.lit(1000.0) + F.col("l_extendedprice") % 100, 2).cast(PRICE).alias("px"),
        F.col("l_quantity").alias("q"), sequence.alias("seq"))
    out = rows.groupBy("stock_id", "date").agg(
        F.min_by("px", "seq").alias("open_price"), F.max("px").alias("high_price"),
        F.min("px").alias("low_price"), F.max_by("px", "seq").alias("close_price"),
        F.sum("q").cast("bigint").alias("volume"))
    return out.select("stock_id", "date", "open_price", "high_price", "low_price", "close_price",
                      F.col("close_price").alias("adjusted_close_price"), "volume")


def raw_bars(spark: SparkSession, root: str) -> DataFrame:
    """Bars with some closes missing and some volumes zero."""
    spot = F.col("stock_id") * 31 + F.datediff("date", F.lit("1995-01-01").cast("date"))
    return bars(spark, root).withColumns({
        "close_price": F.when(spot % 89 != 0, F.col("close_price")),
        "volume": F.when(spot % 97 == 0, F.lit(0).cast("bigint")).otherwise(F.col("volume")),
    })


def messages(spark: SparkSession, root: str) -> DataFrame:
    """User turns, a third of them led by a stock symbol."""
    told = F.when(F.col("conv_id") % 3 == 0, F.concat(letters(F.col("conv_id") % 100 + 1), F.lit(" "))) \
        .otherwise("")
    return (table(spark, root, "conversations").filter(F.col("role") == "user")
            .select("conv_id", "turn",
                    F.regexp_replace(F.concat(told, "text"), "[^ -~]", "_").alias("message")))
