"""Incremental ingest of landed bars and vendor files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickframe import schemas as S
from tickframe.operators import quality, store
from tickframe.session import staged
from tickframe.sources import landing

# Rows of one batch with the same key: the oldest file wins, then the place in the file.
ARRIVAL = ("_metadata.file_modification_time", "_metadata.file_path")


def _store_batches(rows: DataFrame, table: str, checkpoint: str, rejects: str | None, arrivals: str | None,
                   typed=None, rules: quality.Rules | None = None) -> None:
    """Stores all that is there in batches. A batch is read once, and one that is
    run again after a failure adds nothing twice: stored keys are skipped, and
    rejects are written to a folder of their batch. New bars are noted for the
    feature job, in the folder ``arrivals`` beside the table unless told otherwise."""
    arrivals = arrivals or f"{table.rstrip('/').rpartition('/')[0]}/arrivals"

    def store_batch(batch: DataFrame, batch_id: int) -> None:
        if rules and rejects:
            store.append_checked(batch, table, S.BARS, S.SERIES_KEY, rules, f"{rejects}/batch={batch_id}", "_arrival", arrivals=arrivals)
            return
        with staged(typed(batch) if typed else batch, "batch") as once:
            if rejects:
                quality.rejects(once.drop("_arrival")).write.mode("overwrite").parquet(f"{rejects}/batch={batch_id}")
            # Typed rows have their file beside them, so only the time is kept in their arrival.
            arrival = F.struct("_arrival", "file") if typed else F.col("_arrival")
            bars = quality.clean_bars(once).select(*S.BARS.names, arrival.alias("_arrival"))
            store.append_absent(bars, table, S.BARS, S.SERIES_KEY, order="_arrival", staged_already=True, arrivals=arrivals)

    (rows.writeStream.foreachBatch(store_batch).option("checkpointLocation", checkpoint)
     .trigger(availableNow=True).start().awaitTermination())


def _reader(spark: SparkSession, schema, files_per_batch: int | None):
    reader = spark.readStream.schema(schema)
    return reader.option("maxFilesPerTrigger", files_per_batch) if files_per_batch else reader


def ingest_available(spark: SparkSession, folder: str, table: str, checkpoint: str,
                     rejects: str | None = None, files_per_batch: int | None = None, arrivals: str | None = None,
                     stocks: DataFrame | None = None) -> None:
    """Takes in all Parquet files of typed bars that have landed since the last run, then stops.

    ``files_per_batch`` bounds a batch, so a large backlog is stored in steps. With
    ``stocks``, bars of a stock that is not among them go to ``rejects``, which must be named.
    """
    if stocks is not None and not rejects:
        raise ValueError("bars of unknown stocks need a folder for rejects")
    landed = _reader(spark, S.BARS, files_per_batch).parquet(folder)
    _store_batches(landed.select("*", F.struct(*ARRIVAL, "_metadata.row_index").alias("_arrival")), table, checkpoint, rejects,
                   arrivals, rules=quality.bar_rules(stocks) if stocks is not None else None)


def ingest_vendor_files(spark: SparkSession, folder: str, table: str, checkpoint: str, stocks: DataFrame,
                        fmt: str = "parquet", rejects: str | None = None, files_per_batch: int | None = None,
                        suffix: str = S.MARKET_SUFFIX, arrivals: str | None = None) -> None:
    """The same for vendor files (Parquet, or text that is typed here): tickers
    become keys, cells are found by name, rows that cannot be bars and lines that
    cannot be read go to the rejects."""
    if fmt in landing.TEXT:
        lines = _reader(spark, "value string", files_per_batch).format("text").load(folder)
        landed = lines.select("value", F.col("_metadata.file_path").alias("_file"), F.col(ARRIVAL[0]).alias("_arrival"))
    else:
        landed = _reader(spark, landing.vendor_schema(text=False), files_per_batch).format(fmt).load(folder) \
            .select("*", F.col("_metadata.file_path").alias("_file"), F.col(ARRIVAL[0]).alias("_arrival"))

    def typed(batch: DataFrame) -> DataFrame:
        rows = landing.from_lines(batch, fmt, keep=["_arrival"]) if fmt in landing.TEXT else batch
        return landing.typed_rows(rows, stocks, suffix, keep=["_arrival"])

    _store_batches(landed, table, checkpoint, rejects, arrivals, typed)
