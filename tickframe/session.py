"""Session set-up and the shared folder for staged tables."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
}


def session(app: str = "tickframe", **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    for name, value in {**SETTINGS, **extra}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    Only a local session may fall back to a folder on this machine.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if named:
        if not context.getCheckpointDir():
            context.setCheckpointDir(named)
        return named.rstrip("/")
    if not re.match(r"local(\[|$)", context.master):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="tickframe-"))
    return context.getCheckpointDir().rstrip("/")


_staged: dict[str, list[str]] = {}
_made: dict[tuple, DataFrame] = {}
_scratch: ContextVar[list[str] | None] = ContextVar("scratch", default=None)


def new_path(spark: SparkSession, label: str) -> str:
    """A folder of its own below the shared one; ``drop_staged`` deletes it."""
    path = f"{shared_dir(spark)}/tickframe/{label}-{uuid.uuid4().hex}"
    _staged.setdefault(spark.sparkContext.applicationId, []).append(path)
    if _scratch.get() is not None:
        _scratch.get().append(path)
    return path


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Deletes at its end what was staged in it: for jobs whose result is stored elsewhere by then."""
    paths: list[str] = []
    token = _scratch.set(paths)
    try:
        yield
    finally:
        _scratch.reset(token)
        known = _staged.get(spark.sparkContext.applicationId, [])
        for path in paths:
            if path in known:
                _delete(spark, path)
                known.remove(path)


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    For a result that several branches read: it is computed once, survives the
    loss of executors, and gives the planner true sizes for its join choices.
    The files stay until ``drop_staged``, since later plans read them.
    """
    spark = df.sparkSession
    path = new_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def staged(df: DataFrame, label: str) -> Iterator[DataFrame]:
    """``stage`` for the length of one job."""
    spark = df.sparkSession
    path = new_path(spark, label)
    df.write.parquet(path)
    try:
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        _delete(spark, path)
        _staged[spark.sparkContext.applicationId].remove(path)


def stage_once(spark: SparkSession, key: tuple, make: Callable[[], DataFrame]) -> DataFrame:
    """``make()`` staged by the first call with ``key``; later calls read what it wrote.

    For small results that several reports of a session share.
    """
    key = (spark.sparkContext.applicationId, *key)
    if key not in _made:
        _made[key] = stage(make(), str(key[-1]))
    return _made[key]


def drop_staged(spark: SparkSession) -> None:
    """Deletes what this application staged; results built on it are then gone."""
    application = spark.sparkContext.applicationId
    for key in [k for k in _made if k[0] == application]:
        del _made[key]
    for path in _staged.pop(application, []):
        _delete(spark, path)


def _delete(spark: SparkSession, path: str) -> None:
    context = spark.sparkContext
    target = context._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(context._jsc.hadoopConfiguration()).delete(target, True)
