"""The same tables in a relational database."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from tickframe.sources.tables import TABLES


PARTITIONS = 16


def read_options(url: str, table: str, *, bounds: tuple[int, int], partitions: int = PARTITIONS,
                 column: str = "stock_id") -> Mapping[str, str]:
    """Options of a read in ``partitions`` ranges of an integer column.

    The bounds only set the ranges; rows outside them are read as well.
    """
    return {"url": url, "dbtable": table, "fetchsize": "10000", "partitionColumn": column,
            "lowerBound": str(bounds[0]), "upperBound": str(bounds[1]), "numPartitions": str(partitions)}


def bounds_query(table: str, column: str = "stock_id") -> str:
    return f"select min({column}) as low, max({column}) as high from {table}"


def find_bounds(spark: SparkSession, url: str, table: str, column: str = "stock_id") -> tuple[int, int]:
    """The range of ``column``, asked of the database: one row."""
    row = spark.read.format("jdbc").options(url=url, query=bounds_query(table, column)).load().first()
    return (row[0] or 0, (row[1] or 0) + 1)


def read_table(spark: SparkSession, url: str, name: str, *, bounds: tuple[int, int] | None = None, **options) -> DataFrame:
    """A stored table in ranges of its key; without ``bounds`` the database is asked for them."""
    schema, _ = TABLES[name]
    bounds = bounds or find_bounds(spark, url, name, options.get("column", "stock_id"))
    return spark.read.format("jdbc").options(**read_options(url, name, bounds=bounds, **options)).load().select(*schema.names)


def append_table(df: DataFrame, url: str, name: str, batch_size: int = 10_000) -> None:
    (df.write.format("jdbc").mode("append")
     .options(url=url, dbtable=name, batchsize=str(batch_size)).save())
