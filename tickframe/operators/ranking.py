"""Top rows per group, rankings and the recommendation table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickframe import schemas as S
from tickframe.functions import scores
from tickframe.operators import series


def top_n(df: DataFrame, n: int, by: Sequence[str], score: str, tie: str = "symbol",
          out: str = "rank") -> DataFrame:
    """The ``n`` highest rows of each group, ties in the order of ``tie``.

    The limit on ``row_number`` is applied per input partition before the
    exchange, so a group that holds a large part of the table costs one task
    only ``n`` rows per input partition.
    """
    w = Window.partitionBy(*by).orderBy(F.col(score).desc_nulls_last(), F.col(tie))
    return df.withColumn(out, F.row_number().over(w)).filter(F.col(out) <= n)


def by_score(df: DataFrame, score_columns: Mapping[str, str], ids: Sequence[str], name: str) -> DataFrame:
    """One row per input row and score: ``ids``, the score's name, ``score``."""
    wide = df.select(*ids, *(F.col(c).cast("double").alias(label) for label, c in score_columns.items()))
    return wide.unpivot(list(ids), list(score_columns), name, "score")


def latest_scores(feature_rows: DataFrame, stocks: DataFrame, *, as_of=None) -> DataFrame:
    """Signals and SHE score of each key's last feature row, with symbol.

    Each key is ranked by its own last date; ``as_of`` keeps one date only. A
    cross needs the row before the last, so two rows per key are moved.
    """
    signals = scores.with_signals(series.last_rows(feature_rows, 2))
    last = series.latest_per_key(signals.select("stock_id", "date", *S.SIGNALS))
    if as_of is not None:
        last = last.filter(F.col("date") == F.lit(as_of))
    return scores.she_score(last).join(stocks.select("stock_id", "symbol"), "stock_id")


def recommend(scored: DataFrame, models: Mapping[str, str], n: int = S.PORTFOLIO_SIZE, *, as_of=None) -> DataFrame:
    """The top ``n`` of each model as recommendation rows of one ranking date.

    That date is ``as_of`` or the newest among the rows; the symbol's own date
    stands beside it. All models are ranked in one pass over an unpivoted table.
    """
    day = F.lit(as_of).cast("date") if as_of is not None else scored.agg(F.max("date")).scalar()
    ids = ["date", "stock_id", "symbol", "algorithm_scores"]
    rows = scored.withColumn("algorithm_scores", scores.algorithm_scores())
    ranked = top_n(by_score(rows, models, ids, "model_type"), n, ["model_type"], "score")
    return ranked.select(day.alias("date"), F.col("rank").cast("int").alias("rank"), "stock_id", "score",
                         "model_type", "algorithm_scores", F.col("date").alias("data_date"))


def newest(recommendations: DataFrame) -> DataFrame:
    """Rows of the newest date; the date is a scalar subquery, run once."""
    last = recommendations.agg(F.max("date").alias("last")).scalar()
    return recommendations.filter(F.col("date") == last)


def latest_recommendations(recommendations: DataFrame, stocks: DataFrame) -> DataFrame:
    return (newest(recommendations).join(stocks.select("stock_id", "symbol", "company_name"), "stock_id")
            .select("date", "rank", "symbol", "company_name", "score", "algorithm_scores", "model_type", "data_date"))


def recommendation_response(latest: DataFrame, models: Sequence[str] = ("SHE", "LEM")) -> DataFrame:
    """One row per date with an array of records per model, in rank order.

    The arrays hold only ranked rows, so their size is the ranking's ``n``.
    """
    record = F.struct("rank", "symbol", "company_name", "score", "algorithm_scores")
    return latest.groupBy("date").agg(*(
        F.array_sort(F.collect_list(F.when(F.col("model_type") == m, record)))
        .alias(f"{m.lower()}_recommendations") for m in models))


def score_lookup(recommendations: DataFrame, stocks: DataFrame, symbol: str | Column, date) -> DataFrame:
    """The component scores of one symbol on one date, at most one row."""
    wanted = stocks.filter(F.col("symbol") == F.upper(F.lit(symbol))).select("stock_id", "symbol")
    return (recommendations.filter(F.col("date") == F.lit(date)).join(wanted, "stock_id")
            .orderBy("model_type", "rank").limit(1).select("date", "symbol", "algorithm_scores"))
