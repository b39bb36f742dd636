"""Writes that respect keys: insert if absent, upsert, replace by date.

The first three functions are plain plans over DataFrames. The rest apply them
to a Parquet table partitioned by a calendar column, touching only the
partitions that the incoming rows name.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from contextlib import nullcontext
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickframe.operators import quality
from tickframe.session import staged

MONTH = "month"


def one_per_key(batch: DataFrame, keys: Sequence[str], pick, order: str | Column | None) -> DataFrame:
    """One row per key: the first (``F.min_by``) or last (``F.max_by``) by ``order``.

    An aggregate rather than a window: copies of one key are reduced before the
    exchange. Without an order the whole row decides, so the choice is stable.
    """
    rest = [c for c in batch.columns if c not in keys]
    least = pick is F.min_by
    if isinstance(order, str) and order in rest:
        # The order is kept once while rows are reduced, at the head of the row, not beside it too. A row without one comes last.
        rest = [order, *(c for c in rest if c != order)]
        known = F.col(order).isNull() if least else F.col(order).isNotNull()
        row = F.struct(known.alias("_known"), *rest)
        first = F.min(row) if least else F.max(row)
    else:
        row = F.struct(*rest)
        # A row that is its own order is kept once while it is reduced, not twice.
        first = pick(row, order) if order is not None else F.min(row) if least else F.max(row)
    chosen = batch.groupBy(*keys).agg(first.alias("_row"))
    return chosen.select(*(F.col(c) if c in keys else F.col("_row").getField(c).alias(c) for c in batch.columns))


def with_keys(batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``batch``, failing on a row whose key is null: such a row would never be found again."""
    def required(key: str) -> Column:
        kind = batch.schema[key].dataType
        return F.coalesce(F.col(key), F.raise_error(F.lit(f"null {key} in a keyed write")).cast(kind))

    return batch.withColumns({k: required(k) for k in keys if batch.schema[k].nullable})


def absent_rows(stored: DataFrame, batch: DataFrame, keys: Sequence[str], order=None) -> DataFrame:
    """The rows of ``batch`` whose key is not stored, the first of each key. Null keys fail the job."""
    batch = with_keys(batch, keys)
    return one_per_key(batch, keys, F.min_by, order).join(stored.select(*keys), list(keys), "left_anti")


def insert_if_absent(stored: DataFrame, batch: DataFrame, keys: Sequence[str], order=None) -> DataFrame:
    return stored.unionByName(absent_rows(stored, batch, keys, order).select(*stored.columns))


def upsert(stored: DataFrame, batch: DataFrame, keys: Sequence[str], order=None) -> DataFrame:
    """Stored rows with those of ``batch`` put in their place or added."""
    incoming = one_per_key(batch, keys, F.max_by, order).select(*stored.columns)
    return stored.join(incoming.select(*keys), list(keys), "left_anti").unionByName(incoming)


def replace_dates(stored: DataFrame, batch: DataFrame, column: str = "date") -> DataFrame:
    """Every date that occurs in ``batch`` is replaced by its rows there."""
    dates = batch.select(column).distinct()
    return stored.join(dates, column, "left_anti").unionByName(batch.select(*stored.columns))


def with_month(df: DataFrame, column: str = "date") -> DataFrame:
    return df.withColumn(MONTH, F.year(column) * 100 + F.month(column))


# A table whose months are swapped together has a pointer: a file that lists its month folders, one a line, and with
# a minus those that the swap before replaced, which a reader may still be at. Names with a dot are not listed with the table.
POINTER = "_pointer"
GENERATION = ".gen"


def _files(spark: SparkSession, path: str):
    """The file system of ``path`` and a function that makes paths of it."""
    context = spark.sparkContext
    make = context._jvm.org.apache.hadoop.fs.Path
    return make(path).getFileSystem(context._jsc.hadoopConfiguration()), make


def _folders(spark: SparkSession, path: str, prefix: str) -> list[str]:
    system, make = _files(spark, path)
    if not system.exists(make(path)):
        return []
    return sorted(f.getPath().getName() for f in system.listStatus(make(path)) if f.isDirectory() and f.getPath().getName().startswith(prefix))


def _pointer(spark: SparkSession, path: str) -> tuple[list[str], list[str]] | None:
    """The table's month folders and those replaced last, or None if the table has no pointer."""
    system, make = _files(spark, path)
    at = make(f"{path}/{POINTER}")
    if not system.exists(at):
        return None
    stream = system.open(at)
    try:
        text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    lines = text.split()
    return [x for x in lines if x[0] != "-"], [x[1:] for x in lines if x[0] == "-"]


def _point(spark: SparkSession, path: str, generation: str) -> None:
    """Makes the months of ``generation`` those of the table, all at once: the new list takes the old one's place by one rename."""
    before = _pointer(spark, path)
    live = {x.rpartition("/")[2]: x for x in (before[0] if before else _folders(spark, path, f"{MONTH}="))}
    fresh = {x: f"{generation}/{x}" for x in _folders(spark, f"{path}/{generation}", f"{MONTH}=")}
    replaced = [live[x] for x in fresh if x in live]
    text = "\n".join([*sorted({**live, **fresh}.values()), *(f"-{x}" for x in replaced)])
    system, make = _files(spark, path)
    aside, jvm = make(f"{path}/{POINTER}-{generation}"), spark.sparkContext._jvm
    stream = system.create(aside, True)
    stream.write(bytearray(text.encode()))
    stream.close()
    kinds = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    kinds[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(system.getUri(), system.getConf()).rename(aside, make(f"{path}/{POINTER}"), kinds)
    for old in before[1] if before else []:
        system.delete(make(f"{path}/{old}"), True)


def months(spark: SparkSession, path: str) -> list[int]:
    """The months that the table holds, in order, from the names of its folders alone."""
    pointer = _pointer(spark, path)
    names = [x.rpartition("/")[2] for x in pointer[0]] if pointer else _folders(spark, path, f"{MONTH}=")
    return sorted(int(x.split("=")[1]) for x in names)


def drop_months(spark: SparkSession, path: str, first: int) -> None:
    """Deletes the months from ``first`` on of a table whose months are not swapped together; the last ones go first."""
    system, make = _files(spark, path)
    for month in reversed([m for m in months(spark, path) if m >= first]):
        system.delete(make(f"{path}/{MONTH}={month}"), True)


def _write_generation(df: DataFrame, path: str, sort: Sequence[str]) -> None:
    """Writes months beside those of the table and then swaps them in."""
    spark = df.sparkSession
    taken = [int(x.split("=")[1]) for x in _folders(spark, path, f"{GENERATION}=")]
    generation = f"{GENERATION}={max(taken, default=0) + 1:09d}"
    _write(df, f"{path}/{generation}", "append", MONTH, sort)
    _point(spark, path, generation)


def open_table(spark: SparkSession, path: str, schema: T.StructType, partition: str | None = MONTH) -> DataFrame:
    """The table at ``path`` including its partition column, empty if not there yet."""
    if partition == MONTH:
        schema = T.StructType([*schema.fields, T.StructField(MONTH, T.IntegerType())])
        if (pointer := _pointer(spark, path)) is not None:
            swapped = [f"{path}/{x}" for x in pointer[0] if x.startswith(f"{GENERATION}=")]
            plain = [f"{path}/{x}" for x in pointer[0] if not x.startswith(f"{GENERATION}=")]
            parts = [spark.read.schema(schema).option("basePath", path).parquet(*x).select(*schema.names) for x in (swapped, plain) if x]
            return reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], schema)
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return spark.createDataFrame([], schema)


def _write(df: DataFrame, path: str, mode: str, partition: str, sort: Sequence[str]) -> None:
    """Partitions are evened out before the write: large ones are split over
    tasks and small ones joined, and rows are sorted so that files carry tight
    key ranges."""
    (df.hint("rebalance", partition).sortWithinPartitions(partition, *sort)
     .write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(path))


def _touched(batch: DataFrame) -> list[int]:
    """The months of a batch: at most twelve per calendar year."""
    return [r[0] for r in batch.select(MONTH).distinct().collect()]


def append_absent(batch: DataFrame, path: str, schema: T.StructType, keys: Sequence[str], order=None, *,
                  staged_already: bool = False, arrivals: str | None = None) -> None:
    """Appends rows with new keys. Running it again with the same rows adds nothing.

    ``arrivals`` is a folder that notes what was new: per leading key and month,
    the first and last date and the number of rows. It is noted before the rows
    are stored, so a failure between the two leaves a note too many, never one
    too few.

    The batch is written aside once, as its months and its rows are both read
    from it; say ``staged_already`` where the caller has done so.
    """
    with staged(batch, "incoming") if not staged_already else nullcontext(batch) as incoming:
        incoming = with_month(incoming)
        stored = open_table(incoming.sparkSession, path, schema)
        stored = stored.filter(F.col(MONTH).isin(_touched(incoming)))
        fresh = absent_rows(stored, incoming, [*keys, MONTH], order).select(*stored.columns)
        if arrivals is None:
            _write(fresh, path, "append", MONTH, keys)
            return
        with staged(fresh, "fresh") as fresh:
            fresh.groupBy(*keys[:-1], MONTH).agg(F.min(keys[-1]).alias("first"), F.max(keys[-1]).alias("last"),
                                                 F.count("*").alias("n")).write.mode("append").parquet(arrivals)
            _write(fresh, path, "append", MONTH, keys)


def append_checked(batch: DataFrame, path: str, schema: T.StructType, keys: Sequence[str], rules: quality.Rules, rejects: str,
                   order: str | None = None, *, arrivals: str | None = None) -> None:
    """``append_absent`` for the rows that keep ``rules``; the others replace what the folder ``rejects`` holds, with the reason.

    All rules are looked at in the one pass that writes the batch aside. Rejects
    are written first, so a run that fails may be run again. Columns beside the
    schema's reach the rejects only.
    """
    with staged(quality.with_reason(batch, rules), "checked") as marked:
        marked.filter("reason IS NOT NULL").drop(*([order] if order else [])).write.mode("overwrite").parquet(rejects)
        good = marked.filter("reason IS NULL").select(*schema.names, *([order] if order else []))
        append_absent(good, path, schema, keys, order, staged_already=True, arrivals=arrivals)


def merge_rows(batch: DataFrame, path: str, schema: T.StructType, keys: Sequence[str], order=None, *,
               distinct_keys: bool = False, staged_already: bool = False, before: Callable[[int], None] | None = None) -> None:
    """Upserts rows, rewriting only the months they fall in. Null keys fail the job.

    The rows are written aside first, since the months, the keys to leave out
    and the rows to add are all read from them. Say ``distinct_keys`` where the
    rows cannot repeat a key, which saves an exchange, and ``staged_already`` where
    they are read from rows written aside that the table has no part in. Tasks may be retried. New
    months are written beside the old ones and swapped in together, so a job
    that ends before leaves the table as it was, and readers see all months of
    before or all of after. One writer at a time. ``before`` is called with the first
    month they fall in ahead of any change to the table, unless the table is empty.
    """
    keys = [*keys, MONTH]
    batch = with_keys(with_month(batch), keys)
    rows = batch if distinct_keys else one_per_key(batch, keys, F.max_by, order)
    stored = open_table(batch.sparkSession, path, schema)
    if stored.isEmpty() and _pointer(batch.sparkSession, path) is None:
        # Nothing to merge with, so nothing is read twice; if this ends half-way, the next run merges with what there is.
        _write(rows.select(*stored.columns), path, "append", MONTH, keys[:-1])
        return
    with staged(rows, "incoming") if not staged_already else nullcontext(rows) as incoming:
        named = _touched(incoming)
        if not named:
            return
        if before is not None:
            before(min(named))
        stored = stored.filter(F.col(MONTH).isin(named))
        kept = stored.join(incoming.select(*keys), keys, "left_anti")
        _write_generation(kept.unionByName(incoming.select(*stored.columns)), path, keys[:-1])


def overwrite_dates(batch: DataFrame, path: str, sort: Sequence[str], partition: str = "date") -> None:
    """Replaces the dates of ``batch`` in a table partitioned by date."""
    _write(batch, path, "overwrite", partition, sort)


def save_bucketed(df: DataFrame, name: str, path: str, buckets: int, key: str, order: str) -> None:
    """Stores a series table hashed by key into ``buckets``, sorted within them.

    Windows, aggregates and joins by the key then read it without an exchange.
    """
    (df.repartition(buckets, key).write.mode("overwrite").bucketBy(buckets, key).sortBy(key, order)
     .option("path", path).saveAsTable(name))
