"""Pieces that several operators share."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickframe.session import stage

SPACE = r"\x20\x09-\x0D"
WORD = f"[^{SPACE}]+"
SLICE_BYTES = 4 << 20


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{root}/{name}.parquet")


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names starting with ``names`` that ``df`` does not have."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def set_names(df: DataFrame, *kept: str) -> DataFrame:
    """``df`` with numbers for the names of all columns but ``kept``, so that none can clash."""
    return df.toDF(*(c if c in kept else f"_c{k}" for k, c in enumerate(df.columns)))


def restore_names(df: DataFrame, like: DataFrame, *kept: str) -> DataFrame:
    """Undoes ``set_names``, and leaves out columns added since."""
    return df.select(*(F.col(c if c in kept else f"_c{k}").alias(c) for k, c in enumerate(like.columns)))


def per_process(key: str, make: Callable):
    """What ``make`` returns, made once per Python worker and kept for its later tasks."""
    store = sys.modules.setdefault("tickframe_tasks", types.ModuleType("tickframe_tasks")).__dict__
    if key not in store:
        store[key] = make()
    return store[key]


class Numbered(dict):
    """Numbers things in the order of their first look-up; ``new`` lists those not yet taken care of."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, key: str) -> int:
        self[key] = n = len(self)
        self.new.append(key)
        return n


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut so that ``column`` holds about ``limit`` bytes; one longer row stays whole."""
    for batch in batches:
        at, size = 0, 0
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
        for i, n in enumerate(lengths):
            if size and size + n > limit:
                yield batch.slice(at, i - at)
                at, size = i, 0
            size += n
        if at < batch.num_rows:
            yield batch.slice(at)


def space_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Texts cut at spaces: numbers of the words, the bounds of each text's words, the different words."""
    parts = pc.split_pattern(texts, " ")
    coded = parts.flatten().dictionary_encode()
    return coded.indices.to_numpy(), parts.offsets.to_numpy().astype(np.int64), coded.dictionary


def gather(flat: np.ndarray, bounds: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The stretches ``flat[bounds[i]:bounds[i + 1]]`` for each i in ``at``, joined."""
    starts, sizes = bounds[at], bounds[at + 1] - bounds[at]
    ends = np.cumsum(sizes)
    if not len(at) or not ends[-1]:
        return flat[:0]
    kind = np.int32 if max(len(flat), ends[-1]) < 1 << 31 else np.int64
    return flat[np.arange(ends[-1], dtype=kind) + np.repeat((starts - (ends - sizes)).astype(kind), sizes)]


def running_totals(df: DataFrame, by: list[str], order: list[str], values: dict[str, Column],
                   label: str = "totals") -> DataFrame:
    """Adds to each row, per name in ``values``, the sum over the rows before it in its group.

    No group has to fit in a task: rows are dealt by range over (group, order),
    each range is summed by itself, and the sums of earlier ranges of the group
    (a table of about one row per range and group) are added. ``order`` should
    order the rows of a group fully. The dealt rows are staged, so that a retry
    sees the same ranges; keep ``df`` narrow. Null groups and order values come first.
    """
    part, *temps = fresh(df, "_range", *(f"_value_{k}" for k in range(len(values))))
    valued = df.select("*", *(v.cast("long").alias(t) for t, v in zip(temps, values.values())))
    # Range bounds are sampled, which would read what ``df`` is made of twice.
    ranged = stage(stage(valued, label).repartitionByRange(*by, *order).withColumn(part, F.spark_partition_id()), label)
    own = Window.partitionBy(part, *by).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    before = Window.partitionBy(*by or [F.lit(0)]).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    sums = ranged.groupBy(part, *by).agg(*(F.sum(t).alias(t) for t in temps))
    bases = sums.select(F.col(part).alias(f"{part}b"), *(F.col(b).alias(f"{b}_b") for b in by),
                        *(F.coalesce(F.sum(t).over(before), F.lit(0)).alias(f"{t}_b") for t in temps))
    local = ranged.select("*", *(F.coalesce(F.sum(t).over(own), F.lit(0)).alias(f"{t}_own") for t in temps))
    match = local[part] == bases[f"{part}b"]
    for b in by:
        match &= local[b].eqNullSafe(bases[f"{b}_b"])
    out = [(F.col(f"{t}_own") + F.col(f"{t}_b")).alias(name) for name, t in zip(values, temps)]
    return local.join(bases, match).select(*df.columns, *out)
