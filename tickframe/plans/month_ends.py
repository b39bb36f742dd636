"""The last two feature rows of every key at each month's end, for rankings as of past dates.

A ranking as of a date reads the month before from here and the features of that
date's own month, whatever the history. Only months before the newest are kept. The
feature job takes away those that its new rows change, before it writes the rows, and
adds what lacks afterwards, from the newest one that is left. A month that lacks costs
reading the features since the one before it, never a wrong row. Features that are
written past the feature job need ``forget`` with the first month they change.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickframe import schemas as S
from tickframe.operators import series, store

FOLDER = "month_ends"
STORED = T.StructType([*S.FEATURES.fields, T.StructField(store.MONTH, T.IntegerType())])


def _first_day(month):
    return F.make_date((month / 100).cast("int"), month % 100, F.lit(1))


def ends(rows: DataFrame, through: int) -> DataFrame:
    """The last two rows up to the end of each month, of every key that has any by then, up to the month ``through``.

    ``rows`` are feature rows with their month. Months without rows of a key repeat
    what the key had before, from its own first month on.
    """
    row = F.struct(*S.FEATURES.names[1:])
    by_month = series.last_rows(rows.filter(F.col(store.MONTH) <= through), 2, by=["stock_id", store.MONTH]) \
        .groupBy("stock_id", store.MONTH).agg(F.array_sort(F.collect_list(row)).alias("_own"))
    w = Window.partitionBy("stock_id").orderBy(store.MONTH)
    before = F.lag("_own").over(w)
    both = F.when(before.isNull() | (F.size("_own") > 1), F.col("_own")).otherwise(F.concat(F.slice(before, -1, 1), "_own"))
    following = F.add_months(_first_day(F.lead(store.MONTH).over(w)), -1)
    until = F.coalesce(following, _first_day(F.lit(through)))
    held = by_month.select("stock_id", store.MONTH, both.alias("_two"), until.alias("_until"))
    held = held.select("stock_id", "_two", F.explode(F.sequence(_first_day(F.col(store.MONTH)), "_until", F.expr("interval 1 month"))).alias("_day"))
    return held.select("stock_id", F.inline("_two"), (F.year("_day") * 100 + F.month("_day")).alias(store.MONTH)).select(*STORED.names)


def _before(month: int) -> int:
    return month - 1 if month % 100 > 1 else month - 89


def _at(spark: SparkSession, root: str, month: int) -> DataFrame:
    """What is kept of one month, from its own folder alone."""
    return spark.read.schema(S.FEATURES).parquet(f"{root}/{FOLDER}/{store.MONTH}={month}").withColumn(store.MONTH, F.lit(month))


def _since(spark: SparkSession, root: str, month: int) -> DataFrame:
    """Feature rows with their month up to ``month``: the newest month end before it, which stands for all until then, and the rows after that."""
    rows = store.open_table(spark, f"{root}/features", S.FEATURES).filter(F.col(store.MONTH) <= month).select(*STORED.names)
    kept = [m for m in store.months(spark, f"{root}/{FOLDER}") if m < month]
    if not kept:
        return rows
    return rows.filter(F.col(store.MONTH) > kept[-1]).unionByName(_at(spark, root, kept[-1]))


def rows_until(spark: SparkSession, root: str, as_of: dt.date) -> DataFrame:
    """Feature rows up to ``as_of``, at least the last two of each key."""
    return _since(spark, root, as_of.year * 100 + as_of.month).filter(F.col("date") <= F.lit(as_of)).select(*S.FEATURES.names)


def forget(spark: SparkSession, root: str, month: int) -> None:
    """Takes away what is kept of ``month`` and all after it."""
    store.drop_months(spark, f"{root}/{FOLDER}", month)


def bring_up(spark: SparkSession, root: str) -> None:
    """Adds the months that lack between the newest one kept and the newest one of the features."""
    months = store.months(spark, f"{root}/features")
    if len(months) < 2:
        return
    through = _before(months[-1])
    kept = [m for m in store.months(spark, f"{root}/{FOLDER}") if m <= through]
    if kept and kept[-1] == through:
        return
    made = ends(_since(spark, root, through), through)
    if kept:
        made = made.filter(F.col(store.MONTH) > kept[-1])
    store.overwrite_dates(made, f"{root}/{FOLDER}", S.SERIES_KEY, store.MONTH)
