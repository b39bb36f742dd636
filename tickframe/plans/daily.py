"""The daily jobs over stored tables. Each may be run again at any time."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickframe import schemas as S
from tickframe.operators import model as lem
from tickframe.operators import quality, ranking, store
from tickframe.plans import features as plans
from tickframe.plans import incremental, month_ends
from tickframe.session import staged
from tickframe.sources import landing, tables


def _name_of(rows: DataFrame) -> str:
    """A name for a batch that follows from its rows, in whatever order and however they are cut."""
    row = F.xxhash64(*rows.columns)
    n, *sums = rows.agg(F.count("*"), F.sum(row % 2**31), F.sum(F.shiftright(row, 31) % 2**31)).first()
    return "-".join([str(n), *(f"{(s or 0) % 2**64:016x}" for s in sums)])


def ingest(spark: SparkSession, root: str, landed: DataFrame, suffix: str = S.MARKET_SUFFIX,
           batch: str | None = None) -> None:
    """Vendor rows into the bar table; stored bars are kept as they are.

    Rows that cannot be bars go to the rejects of ``batch`` with the reason, and
    lines that could not be read with their text and file. A batch without a name
    gets one from its rows, so other batches' rejects stay. The landed rows are
    read once; running a batch again changes nothing.
    """
    rows = landing.typed_rows(landed, tables.scan(spark, root, "stocks"), suffix)
    with staged(rows, "landed") as typed:
        # The same rows from other files are the same batch.
        batch = batch or _name_of(typed.drop("file"))
        quality.rejects(typed).write.mode("overwrite").parquet(f"{root}/rejects/batch={batch}")
        store.append_absent(quality.clean_bars(typed).select(*S.BARS.names), f"{root}/bars", S.BARS, S.SERIES_KEY,
                            staged_already=True, arrivals=f"{root}/arrivals")


def ingest_bars(spark: SparkSession, root: str, bars: DataFrame, batch: str | None = None) -> None:
    """Bars that have their keys and types into the bar table. Rows that are incomplete, were
    not traded or are of no stored stock go to the rejects of ``batch`` with the reason."""
    with staged(bars, "landed") as rows:
        store.append_checked(rows, f"{root}/bars", S.BARS, S.SERIES_KEY, quality.bar_rules(tables.scan(spark, root, "stocks")),
                             f"{root}/rejects/batch={batch or _name_of(rows)}", arrivals=f"{root}/arrivals")


def ingest_files(spark: SparkSession, root: str, folder: str, fmt: str = "parquet", suffix: str = S.MARKET_SUFFIX,
                 files_per_batch: int | None = None) -> None:
    """The same for all vendor files that landed in ``folder`` since the last run, as a stream with its place kept in ``root``."""
    from tickframe.streaming import ingest as stream
    stream.ingest_vendor_files(spark, folder, f"{root}/bars", f"{root}/ingested", tables.scan(spark, root, "stocks"), fmt,
                               f"{root}/rejects", files_per_batch, suffix, f"{root}/arrivals")


def build_features(spark: SparkSession, root: str, since=None, anew: bool = False) -> None:
    """Features of new bars into the feature table, from the stored state of each key.

    The first run, or ``anew``, works from the whole history. ``since`` also works
    out and writes all rows from that date on, whether noted as new or not; it
    reads counts of the whole history.
    """
    if since is None or incremental.stored_state(spark, root) is not None:
        incremental.build(spark, root, anew=anew)
    if since is None:
        return
    bars = store.open_table(spark, f"{root}/bars", S.BARS)
    incremental.write_features(spark, root, plans.features(bars, since=since))
    month_ends.bring_up(spark, root)


def _newer(rows: DataFrame, day) -> bool:
    """Whether there are features after ``day``; reads the months from there on."""
    if day is not None:
        rows = rows.filter(F.col(store.MONTH) >= day.year * 100 + day.month).filter(F.col("date") > F.lit(day))
    return not rows.isEmpty()


def rank(spark: SparkSession, root: str, model_path: str | None = None, n: int = S.PORTFOLIO_SIZE,
         as_of=None) -> None:
    """The newest ranking of both models into the recommendation table.

    Every symbol is ranked by its own last date, and the ranking is stored under
    the newest of them; with ``as_of``, by its last date up to then, stored under
    ``as_of``, from the end of the month before and that month's rows. Only that
    ranking date is replaced.
    """
    state = incremental.stored_state(spark, root) if as_of is None else None
    rows = store.open_table(spark, f"{root}/features", S.FEATURES)
    if state is not None and _newer(rows, incremental.newest(state)):
        # Rows came by another way than the state, so the state is not the newest.
        state = None
    if state is not None:
        # Two rows per key, which the feature job keeps aside.
        rows = incremental.last_features(state)
    elif as_of is not None:
        rows = month_ends.rows_until(spark, root, as_of)
    last = ranking.latest_scores(rows.select(*S.FEATURES.names), tables.scan(spark, root, "stocks"))
    scored = lem.score(last, lem.load(model_path) if model_path else None)
    chosen = ranking.recommend(scored, {"SHE": "she_score", "LEM": "lem_score"}, n, as_of=as_of)
    with staged(chosen, "ranking") as ranked:
        store.overwrite_dates(ranked, f"{root}/recommendations", ["model_type", "rank"])


def latest(spark: SparkSession, root: str) -> DataFrame:
    """The newest recommendations, by model and rank."""
    return ranking.latest_recommendations(tables.scan(spark, root, "recommendations"),
                                          tables.scan(spark, root, "stocks")).orderBy("model_type", "rank")
