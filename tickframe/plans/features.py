"""From bars to stored features, signals and the modelling panel."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickframe import schemas as S
from tickframe.functions import scores
from tickframe.operators import series


MACD_SPANS = (S.MACD_FAST, S.MACD_SLOW, S.MACD_SIGNAL)


def features(bars: DataFrame, *, price: str = "close_price", keep: Sequence[str] = (),
             min_rows: int = S.MIN_HISTORY, by: Sequence[str] = series.KEY, order: str = series.ORDER,
             slice_of: Column | None = None, piece_rows: int = series.PIECE_ROWS, since=None) -> DataFrame:
    """The feature table: indicators over each key's full history, at storage
    precision, without the warm-up rows. ``keep`` passes bar columns through.

    ``since`` returns the rows from that date on, and reads of each key only as
    much before it as the indicators look back; the rows are the same.

    Keys of daily bars stay whole. Keys ordered by a timestamp, or for which
    ``slice_of`` is given, are cut into pieces that overlap by what the
    indicators look back; the result is the same.

    A row has a slow mean only after ``SLOW_SMA`` rows, so a shorter required
    history needs no count of its own.
    """
    rows = bars
    if min_rows > S.SLOW_SMA:
        rows = series.min_history(rows, min_rows, by=by)
    if since is not None:
        halo = max(series.block_size(MACD_SPANS), S.SLOW_SMA)
        rows = series.since_with_halo(rows, since, halo, by=by, order=order)
    rows = rows.select(*dict.fromkeys([*by, order, price, *keep]))
    out = series.indicators(rows, price, fast_sma=S.FAST_SMA, slow_sma=S.SLOW_SMA, rsi_length=S.RSI_LENGTH,
                            macd_spans=MACD_SPANS, by=by, order=order, slice_of=slice_of, piece_rows=piece_rows)
    if since is not None:
        out = out.filter(F.col(order) >= F.lit(since))
    return as_stored(out, by=by, order=order, keep=keep)


def stored_columns() -> list[Column]:
    """Indicators at storage precision; null what storage cannot hold."""
    return [F.col("sma_fast").try_cast(S.PRICE).alias("sma_50"), F.col("sma_slow").try_cast(S.PRICE).alias("sma_200"),
            F.col("rsi").try_cast(S.RSI).alias("rsi_14"),
            F.col("macd_value").try_cast(S.PRICE).alias("macd_value"),
            F.col("macd_signal").try_cast(S.PRICE).alias("macd_signal")]


def as_stored(indicators: DataFrame, *, by: Sequence[str] = series.KEY, order: str = series.ORDER,
              keep: Sequence[str] = ()) -> DataFrame:
    """Indicators at storage precision, complete rows only.

    A value that storage cannot hold makes its row incomplete, not the job fail.
    """
    stored = indicators.select(*by, order, *stored_columns(), *keep)
    return stored.dropna(subset=[c for c in S.FEATURES.names if c not in S.SERIES_KEY])


def with_symbol(rows: DataFrame, stocks: DataFrame) -> DataFrame:
    """Adds the symbol. The planner broadcasts ``stocks`` only while its size is
    under the session's threshold, and merges the two sides beyond it."""
    return rows.join(stocks.select("stock_id", "symbol"), "stock_id")


def training_scan(feature_rows: DataFrame, bars: DataFrame, price: str = "close_price") -> DataFrame:
    """Features with their price, for features stored apart from prices: the
    inner join of two tables that are both unique by (key, date).

    Both tables are brought together by key alone and matched there by an
    aggregate, so the shifts of the panel that follow need no further exchange.
    A join on (key, date) would move both sides and then the result.
    """
    names = [c for c in S.FEATURES.names if c not in S.SERIES_KEY]
    prices = bars.select("stock_id", "date", F.col(price).alias("close_price"))
    both = feature_rows.select(*S.FEATURES.names).unionByName(prices, allowMissingColumns=True)
    matched = both.repartition("stock_id").groupBy("stock_id", "date").agg(
        *(F.max(c).alias(c) for c in [*names, "close_price"]))
    return matched.dropna(subset=[*names, "close_price"])


# Without it Spark moves both sides of a join on (key, date), even if they are stored by key.
STORED_BY_KEY = "spark.sql.requireAllClusterKeysForCoPartition"


def training_scan_bucketed(feature_rows: DataFrame, bars: DataFrame, price: str = "close_price") -> DataFrame:
    """``training_scan`` of two tables that ``store.save_bucketed`` stored by key into equally many buckets.

    Nothing is moved, neither here nor by the panel's shifts after it. The session
    has to set ``STORED_BY_KEY`` to false, which lets a join on (key, date) use what
    is stored by key alone; it is not set here, as it holds for all joins of a session.
    """
    if feature_rows.sparkSession.conf.get(STORED_BY_KEY) != "false":
        raise ValueError(f"set {STORED_BY_KEY} to false for a scan without exchange")
    names = [c for c in S.FEATURES.names if c not in S.SERIES_KEY]
    prices = bars.select("stock_id", "date", F.col(price).alias("close_price")).dropna()
    return feature_rows.select(*S.FEATURES.names).dropna(subset=names).join(prices, ["stock_id", "date"])


def panel(scan: DataFrame, *, horizon: int = S.LABEL_HORIZON, threshold: float = S.LABEL_THRESHOLD,
          by: Sequence[str] = series.KEY, order: str = series.ORDER,
          slice_of: Column | None = None, piece_rows: int = series.PIECE_ROWS) -> DataFrame:
    """Signals, label and next-day return per feature row, complete rows only.

    Shifts run over feature rows, so date filters belong after this, and long
    keys are cut anew here, by positions among feature rows. All windows share
    the key and order, hence one exchange and one sort.
    """
    def work(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
        w = series.series_window(keys, order)
        return rows.withColumns({
            **scores.signal_columns(w),
            "future_return": series.forward_return_of("close_price", horizon, w),
            "daily_return": series.forward_return_of("close_price", 1, w),
        })

    out = series.piecewise(scan, work, halo=1, ahead=max(horizon, 1), by=by, order=order, slice_of=slice_of,
                           piece_rows=piece_rows)
    out = out.dropna(subset=[*S.SIGNALS, "future_return", "daily_return"])
    return out.select(
        *by, order, *S.SIGNALS, F.col("close_price").cast("double").alias("close_price"),
        "future_return", (F.col("future_return") > threshold).cast("int").alias("target"), "daily_return")


def panel_from_bars(bars: DataFrame, stocks: DataFrame, **options) -> DataFrame:
    """The panel without a stored feature table.

    Prices ride along with the features, which saves the join on (key, date);
    the symbol comes last, so features and shifts share one exchange.
    """
    return with_symbol(panel(features(bars, keep=["close_price"]), **options), stocks)


def profile(rows: DataFrame, by: str) -> DataFrame:
    """Row count and date range per group."""
    return rows.groupBy(by).agg(F.count("*").alias("row_count"), F.min("date").alias("first_date"),
                                F.max("date").alias("last_date"))


def temporal_split(rows: DataFrame, train_end=S.TRAIN_END, test_start=S.TEST_START) -> tuple[DataFrame, DataFrame]:
    return rows.filter(F.col("date") <= train_end), rows.filter(F.col("date") >= test_start)
