"""Signal and score expressions, and the strategies made of them.

A strategy is a function ``DataFrame -> DataFrame`` for ``df.transform``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F

from tickframe.operators import series
from tickframe.schemas import SHE_WEIGHTS


def trend_of(rose: Column, fell: Column) -> Column:
    return F.when(rose, 1).when(fell, -1).otherwise(0)


def momentum_of(rsi: str | Column) -> Column:
    rsi = F.col(rsi) if isinstance(rsi, str) else rsi
    return (F.lit(100) - rsi).cast("double")


def macd_of(rose: Column) -> Column:
    return F.when(rose, 100).otherwise(0)


def normalised_trend(trend: str = "trend_signal") -> Column:
    return (F.col(trend) + 1) * 50


def she_of(trend: str = "trend_signal", momentum: str = "momentum_score", macd: str = "macd_score",
           weights: Mapping[str, float] = SHE_WEIGHTS) -> Column:
    """The fixed-weight heuristic score."""
    return (normalised_trend(trend) * F.lit(weights["trend"])
            + F.col(momentum) * F.lit(weights["momentum"])
            + F.col(macd) * F.lit(weights["macd"]))


def trend_signal(df: DataFrame, *, by: Sequence[str] = series.KEY, order: str = series.ORDER,
                 slice_of: Column | None = None) -> DataFrame:
    """+1 where the fast mean passes above the slow one, -1 where below, else 0."""
    return _strategy(df, "trend_signal", by, order, slice_of)


def momentum_score(df: DataFrame) -> DataFrame:
    return df.withColumn("momentum_score", momentum_of("rsi_14"))


def macd_score(df: DataFrame, *, by: Sequence[str] = series.KEY, order: str = series.ORDER,
               slice_of: Column | None = None) -> DataFrame:
    """100 where the MACD line passes above its signal line, else 0."""
    return _strategy(df, "macd_score", by, order, slice_of)


def signal_columns(window: WindowSpec) -> dict[str, Column]:
    """The three signals, for rows of one key in order."""
    up, down = series.cross_conditions("sma_50", "sma_200", window)
    macd_up, _ = series.cross_conditions("macd_value", "macd_signal", window)
    return {
        "trend_signal": trend_of(up, down),
        "momentum_score": momentum_of("rsi_14"),
        "macd_score": macd_of(macd_up),
    }


def _strategy(df: DataFrame, name: str, by, order, slice_of) -> DataFrame:
    def work(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
        return rows.withColumn(name, signal_columns(series.series_window(keys, order))[name])

    return series.piecewise(df, work, halo=1, by=by, order=order, slice_of=slice_of)


def with_signals(df: DataFrame, *, by: Sequence[str] = series.KEY, order: str = series.ORDER,
                 slice_of: Column | None = None) -> DataFrame:
    """The three signals as columns of the same rows; one window pass."""
    def work(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
        return rows.withColumns(signal_columns(series.series_window(keys, order)))

    return series.piecewise(df, work, halo=1, by=by, order=order, slice_of=slice_of)


def she_score(df: DataFrame, weights: Mapping[str, float] = SHE_WEIGHTS) -> DataFrame:
    return df.withColumn("she_score", she_of(weights=weights))


def algorithm_scores() -> Column:
    """The three component scores as one record of doubles."""
    return F.struct(*(F.col(c).cast("double").alias(c)
                      for c in ("trend_signal", "momentum_score", "macd_score")))
